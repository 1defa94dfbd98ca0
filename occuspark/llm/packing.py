"""Sequence packing by length patterns fitted with non-negative least squares.

1. Tokenise each text once, cut only what exceeds ``max_tokens``.
2. Count pieces by length (at most ``max_tokens`` rows reach the driver).
3. Enumerate patterns of one to three lengths that fill a sequence exactly, fit
   how often each repeats by non-negative least squares against the histogram,
   round down to what is there.
4. Pack the residual histogram largest-fit first; equal sequences share one plan row.
5. Number the pieces of each length (salted, so a hot length is spread) and look
   the number up in the plan: that gives sequence and offset.

The plan's size depends on ``max_tokens`` alone, not on the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, documents_of, sub_blocks, trim

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Words kept with their ids in a worker process.
CACHE_WORDS = 150_000
#: Characters of texts that are encoded together.
SLICE_CHARS = 400_000
LONGEST_CACHED = 48
#: Latin letters, and the mark that may follow them; none of these turns into another by the tokenizer's folding.
LATIN = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u01ba\u01bc-\u01bf\u01c4-\u024f]+[.,]?$"
#: A word that stands between words encoded together; words that hold it are encoded alone.
BETWEEN = "~"


class WordEncoder:
    """Ids of texts as unsigned 32-bit numbers.

    The tokenizer never lets a token span white space, so a text's ids are those of its
    words one after another.  The distinct words of many texts are looked up together, in
    lower case and without the full stop or comma after their letters, which is a token
    of its own; only what is then unknown is encoded.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.recent: list[dict[str, bytes]] = [{}, {}]
        self.marks = {c: int(np.frombuffer(self._ids([c])[0], "<u4")[0]) for c in ".,"}
        self.between = int(np.frombuffer(self._ids([BETWEEN])[0], "<u4")[0])

    @classmethod
    def of_process(cls, path: str) -> WordEncoder:
        """The worker process's encoder of this file, kept from task to task."""
        import tokenizers
        kept = tokenizers.__dict__.setdefault("_word_encoders", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word; encoded as one text, with a word of its own between them."""
        if any(BETWEEN in w or "<|" in w for w in words):
            return self._ids(words)
        ids = np.asarray(self.tokenizer.encode_batch_fast([f" {BETWEEN} ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == self.between)
        if len(cuts) != len(words) - 1:
            return self._ids(words)
        flat = ids.tobytes()
        return [flat[4 * a:4 * b] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_many(pa.array([text], pa.string()))[0].tobytes()

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (a string array without nulls); every distinct word of the texts is looked up once."""
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]")
        words = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
        coded = words.flatten().cast(pa.string()).dictionary_encode()  # with empty ones before and after white space
        key, tail, begin, size, flat = self._looked_up(coded.dictionary)
        at = coded.indices.to_numpy()
        of, mark = key[at], tail[at]
        n = size[of]
        after = np.cumsum(n + (mark >= 0))
        start = after - n - (mark >= 0)
        out = np.empty(int(after[-1]) if len(after) else 0, "<u4")
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(start, n) + within] = flat[np.repeat(begin[of], n) + within]
        marked = np.flatnonzero(mark >= 0)
        out[after[marked] - 1] = mark[marked]
        parts = np.split(out, np.r_[0, after][ends][:-1])
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False).astype(bool)).tolist():
            parts[i] = np.frombuffer(self._ids([texts[i].as_py()])[0], "<u4")
        return parts

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, ...]:
        """For distinct words: the number of each one's key, the id of the mark after it (-1: none); for keys: where
        their ids begin, how many they are, and all of them in a row."""
        latin = pc.match_substring_regex(words, LATIN)
        bare = pc.if_else(latin, pc.utf8_rtrim(words, ".,"), words)
        tail = np.full(len(words), -1, np.int64)
        for c, k in self.marks.items():
            tail[pc.and_(latin, pc.ends_with(words, c)).to_numpy(zero_copy_only=False).astype(bool)] = k
        small = pc.and_(pc.string_is_ascii(bare), pc.invert(pc.match_substring(bare, "<|")))
        keys = pc.if_else(small, pc.ascii_lower(bare), bare).dictionary_encode()
        distinct = keys.dictionary.to_numpy(zero_copy_only=False).tolist()  # many times faster than to_pylist
        ids = list(map(self.known.get, distinct))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if gaps:
            for i, x in zip(gaps, self._found([distinct[i] for i in gaps]), strict=True):
                ids[i] = x
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return keys.indices.to_numpy(), tail, np.cumsum(size) - size, size, np.frombuffer(b"".join(ids), "<u4")

    def _found(self, words: list[str]) -> list[bytes]:
        """Ids of words outside the table.  A word enters it when it is met again soon after the first time, so that
        the many words that occur once never fill it; full, it starts again."""
        recent, older = self.recent
        ids = [recent.get(w) or older.get(w) for w in words]
        self.known.update((w, x) for w, x in zip(words, ids, strict=True) if x is not None and len(w) <= LONGEST_CACHED)
        if len(self.known) > CACHE_WORDS:
            self.known = {"": b""}
        gaps = [i for i, x in enumerate(ids) if x is None]
        new = [words[i] for i in gaps]
        if len(recent) > CACHE_WORDS // 6:
            self.recent = [{}, recent]
        for i, w, x in zip(gaps, new, self._word_ids(new) if new else [], strict=True):
            ids[i] = x
            if len(w) <= LONGEST_CACHED:
                self.recent[0][w] = x
        return ids


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0,
                 keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked).

    A null or empty text is the end id alone, one piece of length 1.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()
    step = 4 * max_tokens

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of_process(tokenizer_path)
        for batch in batches:
            docs_of, texts = batch.column(0).to_pylist(), batch.column(1)
            chars = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False)) // SLICE_CHARS
            ends = [*(np.flatnonzero(np.diff(chars)) + 1).tolist(), len(texts)]
            for a, b in zip([0, *ends], ends, strict=False):
                rows = []
                for doc, got in zip(docs_of[a:b], encoder.encode_many(texts.slice(a, b - a)), strict=True):
                    ids = got.tobytes() + end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if keep_ids else row)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                     names=names)
        trim()

    return documents_of(docs).mapInArrow(cut, PIECES + ", ids binary" * keep_ids)


def candidate_patterns(counts: np.ndarray, size: int, pivots: int = 48) -> list[tuple[int, ...]]:
    """Patterns of one to three lengths present in ``counts`` that sum to ``size``, longest length first."""
    present = np.flatnonzero(counts)
    present = present[present > 0]
    found: list[tuple[int, ...]] = [(size,)] if size < len(counts) and counts[size] else []
    found += [(int(a), int(size - a)) for a in present if size > a >= size - a and counts[size - a]]
    if len(present):
        middle = present[np.unique(np.linspace(0, len(present) - 1, pivots).astype(int))]
        for b in middle.tolist():
            a = present[(present >= b) & (present < size - b)]
            c = size - b - a
            ok = (c <= b) & (c > 0)
            a, c = a[ok], c[ok]
            ok = counts[c] > 0
            found += [(int(x), b, int(y)) for x, y in zip(a[ok], c[ok], strict=True)]
    return found


def fit_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats ``x`` with ``sum x_p * multiplicity(p, l)`` near ``counts[l]``.

    Accelerated projected gradient on the sparse pattern matrix; residuals are
    weighted by length, since a long piece left over costs most.
    """
    if not patterns:
        return np.zeros(0)
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.concatenate([np.asarray(p) for p in patterns])
    weight = np.sqrt(np.arange(len(counts)) / max(1, len(counts) - 1))
    target = weight * counts

    def forward(x: np.ndarray) -> np.ndarray:
        return weight * np.bincount(row, x[col], minlength=len(counts))

    def back(y: np.ndarray) -> np.ndarray:
        return np.bincount(col, (weight * y)[row], minlength=len(patterns))

    v = np.ones(len(patterns))
    for _ in range(30):
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1.0 / (1.05 * norm)
    x = z = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0.0, z - step * back(forward(z) - target))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def pack_plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """``(pattern, repeats)`` that use up ``counts`` (index: length) in sequences of at most ``size``."""
    left = counts.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], most: int | None = None) -> None:
        lengths, times = np.unique(pattern, return_counts=True)
        n = int((left[lengths] // times).min())
        n = n if most is None else min(n, most)
        if n > 0:
            left[lengths] -= n * times
            plan.append((pattern, n))

    patterns = candidate_patterns(counts, size)
    repeats = fit_repeats(patterns, counts.astype(float))
    for k in np.argsort(-repeats, kind="stable"):
        if repeats[k] < 1:
            break
        take(patterns[k], int(repeats[k]))
    while left.any():
        room, pattern, used = size, [], np.zeros_like(left)
        while True:
            fit = np.flatnonzero(left[:room + 1] > used[:room + 1])
            if not len(fit):
                break
            best = int(fit[-1])
            pattern.append(best)
            used[best] += 1
            room -= best
        take(tuple(pattern))
    return plan


def plan_table(plan: list[tuple[tuple[int, ...], int]], size: int) -> dict[str, np.ndarray]:
    """The plan by (length, first number): which numbers of a length go to which sequences and offsets."""
    taken = np.zeros(size + 1, dtype=np.int64)
    rows, sequence = [], 0
    for pattern, n in plan:
        at = 0
        lengths, times = np.unique(pattern, return_counts=True)
        for length, m in sorted(zip(lengths.tolist(), times.tolist(), strict=True), reverse=True):
            rows.append((length, taken[length], sequence, m, at))
            taken[length] += n * m
            at += length * m
        sequence += n
    rows.sort()
    names = ("length", "first", "sequence", "times", "offset")
    return {k: np.asarray([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def numbered_by_length(pieces: DataFrame, rows: int, per_block: int = 1000) -> DataFrame:
    """Number the pieces of each length from 0, without a window over a whole length.

    Pieces are numbered within (length, hash bucket); a bucket's first number
    comes from the counts.  The number of buckets grows with the rows.
    """
    blocks = sub_blocks(rows, per_block)
    put = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(17)), F.lit(blocks)))
    first = (put.groupBy("length", "block").agg(F.count("*").alias("n"))
             .select("length", "block", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n"))
                     .alias("base")))
    inner = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    return (put.withColumn("inner", F.row_number().over(inner) - 1).join(first, ["length", "block"])
            .withColumn("number", F.col("base") + F.col("inner")).drop("block", "inner", "base"))


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0,
         keep_ids: bool = False) -> DataFrame:
    """Pack all documents; one row per piece with ``sequence_id`` and ``offset`` (gapless from 0).

    Nulls and empty texts become a piece of the end id alone; repeated rows are
    packed each by itself; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, tokenizer_path, max_tokens, end_id, keep_ids))
    counts = np.zeros(max_tokens + 1, dtype=np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # max_tokens rows at most
        counts[r["length"]] = r["n"]
    table = spark.sparkContext.broadcast(plan_table(pack_plan(counts, max_tokens), max_tokens))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = table.value
        key = t["length"].astype(np.float64) * 2.0 ** 40 + t["first"]
        for b in batches:
            length, number = b["length"].to_numpy(np.int64), b["number"].to_numpy(np.int64)
            # equal length bounds the search; within it the last row that starts at or before the number
            k = np.searchsorted(key, length * 2.0 ** 40 + number, side="right") - 1 if len(key) else np.zeros(0, int)
            i = number - t["first"][k]
            out = b.drop(columns=["number"])
            out["sequence_id"] = t["sequence"][k] + i // t["times"][k]
            out["offset"] = t["offset"][k] + (i % t["times"][k]) * length
            yield out

    schema = PIECES + ", ids binary" * keep_ids + ", sequence_id long, offset long"
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    return numbered_by_length(pieces, int(counts.sum())).select(*cols, "number").mapInPandas(place, schema)
