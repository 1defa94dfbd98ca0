"""Pattern packing and section token counts against plain re-computation."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from occuspark.llm import packing, tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, source string, length long, sequence_id string"
ROWS = [(1, "The quick brown fox, it's here.", "a", 1, "x"), (2, None, None, None, None), (3, "", "b", 2, ""),
        (4, "word " * 700, "a", 3, "y"), (5, "same text", "a", 1, ""), (5, "same text", "a", 1, ""),
        (None, "no id", "c", 0, ""), (7, "Ünïcode — 中文 àb \x1c<|endoftext|> 1 455", "c", 0, "")]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(WORDS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"abXYZ .,!'s09éÉßΣσςİ中\u0300\x1c\x85\n\t<|>", "<|endoftext|>", "<|ENDOFTEXT|>"]),
                max_size=60).map("".join))
def test_word_ids_are_the_tokenizers(text):
    enc = test_word_ids_are_the_tokenizers.__dict__.setdefault("enc", packing.WordEncoder(WORDS))
    assert enc.encode(text) == np.asarray(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abXY .,!'s09éÉßİ中\u0300\x1c\x85\n\t<|>", "<|endoftext|>", "The ", "word "]),
                         max_size=20).map("".join), max_size=6))
def test_texts_encoded_together_are_the_tokenizers(texts):
    enc = test_word_ids_are_the_tokenizers.__dict__.setdefault("enc", packing.WordEncoder(WORDS))
    got = [ids.tolist() for ids in enc.encode_many(pa.array(texts, pa.string()))]
    assert got == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts] or not texts


def test_table_of_words_may_fill_up(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    enc = packing.WordEncoder(WORDS)
    for k in range(60):
        text = f"Alpha beta{k} gamma, delta. w{k}"
        assert enc.encode(text) == np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(enc.known) <= 5


def test_texts_are_encoded_in_small_slices(spark, tokenizer, monkeypatch):
    """A worker holds the words of a small slice at a time; slices change no id."""
    assert packing.SLICE_CHARS <= 500_000 and packing.CACHE_WORDS <= 200_000
    docs = spark.createDataFrame([(i, f"Word {i} of some, text. " * (i % 7)) for i in range(50)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = sorted(map(tuple, packing.token_pieces(docs, path).collect()))
    monkeypatch.setattr(packing, "SLICE_CHARS", 40)
    assert sorted(map(tuple, packing.token_pieces(docs, path).collect())) == whole


def test_pack_against_direct_encoding(spark, tokenizer):
    out = packing.pack(spark.createDataFrame(ROWS, SCHEMA), WORDS, max_tokens=256).toPandas()
    assert out.columns.tolist() == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = Counter()
    for doc, text, *_ in ROWS:
        ids = np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at:at + 256]
            want[(doc, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
                  for r in out.itertuples())
    assert got == want
    for _, rows in out.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]]
        assert rows.length.sum() <= 256
    assert out.sequence_id.nunique() == -(-out.length.sum() // 256)


def test_pack_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_plan_uses_every_piece_and_few_sequences():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(512, rng.gamma(2.0, 90.0, 20_000).astype(int) + 1), minlength=513)
    plan = packing.pack_plan(counts, 512)
    used = np.zeros_like(counts)
    for pattern, n in plan:
        assert sum(pattern) <= 512
        for length in pattern:
            used[length] += n
    assert (used == counts).all()
    assert sum(n for _, n in plan) <= 1.01 * (counts * np.arange(513)).sum() / 512 + 1


def test_least_squares_finds_exact_repeats():
    patterns = [(10,), (6, 4), (5, 5), (4, 3, 3)]
    counts = np.zeros(11)
    for p, n in zip(patterns, (7, 20, 11, 5), strict=True):
        for length in p:
            counts[length] += n
    assert np.allclose(packing.fit_repeats(patterns, counts, 4000), (7, 20, 11, 5), atol=1e-3)


def test_hot_length_is_numbered_without_gaps(spark):
    pieces = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "CASE WHEN id % 3 = 0 THEN 9L ELSE 5L END AS length", "0L AS ids_crc32")
    got = packing.numbered_by_length(pieces, 5000, per_block=100).toPandas()
    for _, rows in got.groupby("length"):
        assert sorted(rows.number) == list(range(len(rows)))


def test_sections_add_up_and_follow_the_rule(spark):
    rows = [(1, "first line\nsecond\n\n\n  third"), (2, None), (3, ""), (4, "日本語\nтекст\n"), (None, "x\ny"),
            (1, "first line\nsecond\n\n\n  third")]
    out = tokens.section_token_counts(spark.createDataFrame([(i, t, "n", 0) for i, t in rows], "doc_id long, text string, section string, start int"), RANKS).toPandas()
    enc, sizes = tokens.load_encoder(RANKS)
    assert len(out) == sum((t or "").count("\n") + 1 for _, t in rows)
    for i, t in {(i, t or "") for i, t in rows if i not in (None,)}:
        ids = enc.encode_ordinary(t)
        mine = out[out.doc_id == i].sort_values("section").drop_duplicates("section")
        assert mine.n_tokens.sum() == len(ids) == mine.doc_tokens.iloc[0]
        byte_of = [len(t[:c].encode()) for c in mine.end]
        at, want = 0, [0] * len(mine)
        for k in ids:  # most bytes, ties to the earlier section
            stop = at + int(sizes[k])
            share = [min(stop, e) - max(at, b) for b, e in zip([0, *byte_of[:-1]], byte_of, strict=True)]
            want[int(np.argmax(share))] += 1
            at = stop
        assert mine.n_tokens.tolist() == want


def test_named_fields_are_sections(spark):
    docs = spark.createDataFrame([(1, "A title", None, "Body text here")], "doc_id long, title string, note string, text string")
    out = tokens.section_token_counts(docs, RANKS, ["title", "note", "text"]).toPandas().sort_values("section")
    assert out.start.tolist() == [0, 8, 9] and out.end.tolist() == [8, 9, 23]
    assert out.n_tokens.sum() == out.doc_tokens.iloc[0]


def test_sections_empty_table(spark):
    assert tokens.section_token_counts(spark.createDataFrame([], "doc_id long, text string"), RANKS).count() == 0


def test_token_over_several_sections_goes_to_the_largest():
    own, crossing = tokens.attribute(np.array([2, 6, 1]), np.array([3, 4, 9]))
    assert own.tolist() == [1, 0, 2] and crossing.tolist() == [0, 0, 1]
    own, _ = tokens.attribute(np.array([4]), np.array([2, 4]))
    assert own.tolist() == [1, 0]
