"""Hidden Markov language model: Baum-Welch counts over all partitions, exact scaled forward scores.

A text is a chain of states; each state writes one word, and from any state (or at once)
the text may end.  Texts are encoded once into chunks of some two million words with a
dictionary of their own; the corpus's vocabulary lies in shards by word hash.  A round of
Baum-Welch hands every chunk the parameters of its words (chunk and shard meet by key, in
blocks of numbers), runs the scaled forward and backward recursions there, and sums the
expected counts by shard; the next parameters are those counts, smoothed.  No vocabulary is
held in one place: only the transition table (states squared) and one total per state reach
the driver.

The rounds start from parameters that a bounded sample of texts gives (many rounds in one
task); they only choose which maximum the rounds over the whole corpus climb.

The recursions advance all texts of a chunk one word at a time.  Long texts are cut into
segments; the exact state vectors at the cuts come from the segments' transfer matrices, so
the likelihood is that of the uncut text.

Words that training texts do not hold get the unigram base's probability in every state, so
the two scores differ by what the states know and by nothing else.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, release
from .phrases import LocalWords, packed, unpacked

#: ASCII white space becomes a space, capitals small letters.
TABLE = bytes(32 if c in (9, 10, 11, 12, 13) else c + 32 if 65 <= c <= 90 else c for c in range(256))
STOP = b"\n"
CHUNK_WORDS = 2_000_000
SLICE_BYTES = 4 << 20
SEGMENT = 2048
NO_ID, HELD_OUT = 1, 2

#: Entries (a word of a chunk) that one shard of the vocabulary gets on average.
SHARD_ENTRIES = 500_000

CHUNK = "chunk long, docs int, n int, ids binary, flags binary, lens binary, tokens binary"
WORDS = "chunk long, shard int, size int, locals binary, words binary, counts binary"
#: A shard's words (``chunk`` null): training counts and state counts; or where a chunk's words stand in the shard.
SHARD = "chunk long, shard int, size int, locals binary, places binary, c binary, e binary, sums array<double>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# ---------------------------------------------------------------- recursions (numpy, in tasks)

class Model:
    """Start (states and end), transitions (states x states and end) and word probabilities."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, words: np.ndarray):
        self.start, self.moves, self.words = start, moves, words
        self.k = len(moves)


class Texts:
    """Texts of one or more words as segments, the longest first.

    ``offset`` and ``length`` are those of a segment's words after its text's first word;
    ``text`` says whose it is and ``part`` which one.
    """

    def __init__(self, tokens: np.ndarray, lens: np.ndarray, segment: int = SEGMENT):
        self.tokens = tokens
        self.first = np.cumsum(lens) - lens
        parts = np.maximum(1, -(-(lens - 1) // segment)).astype(np.int64)
        text = np.repeat(np.arange(len(lens)), parts)
        part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        length = np.minimum(segment, lens[text] - 1 - part * segment)
        order = np.argsort(-length, kind="stable")
        self.parts, self.text, self.part, self.length = parts, text[order], part[order], length[order]
        self.offset = (self.first[text] + 1 + part * segment)[order]
        # segments that are still going at each step: a prefix, as the longest come first
        self.active = len(order) - np.searchsorted(self.length[::-1], np.arange(int(length.max(initial=0))), side="right")
        self.row = np.empty(len(order), np.int64)
        self.row[order] = np.arange(len(order))  # of the segments text by text
        self.begin = np.cumsum(parts) - parts


def transfer(texts: Texts, model: Model, rows: np.ndarray) -> np.ndarray:
    """Scaled product of ``moves x diag(word probability)`` over each of the given segments (longest first)."""
    k, moves = model.k, model.moves[:, :model.k]
    out = np.tile(np.eye(k), (len(rows), 1, 1))
    length, offset = texts.length[rows], texts.offset[rows]
    for t in range(int(length.max(initial=0))):
        m = int(np.searchsorted(-length, -t, side="left"))
        now = (out[:m].reshape(m * k, k) @ moves).reshape(m, k, k) * model.words[texts.tokens[offset[:m] + t]][:, None, :]
        out[:m] = now / now.sum(axis=(1, 2), keepdims=True)
    return out


def borders(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log of the first words' sums by text, state vectors before each segment and (up to scale) after it."""
    k = model.k
    before = model.start[:k] * model.words[texts.tokens[texts.first]]
    total = before.sum(axis=1)
    before = (before / total[:, None])[texts.text]
    after = np.tile(model.moves[:, k], (len(texts.text), 1))
    many = np.flatnonzero(texts.parts > 1)
    if len(many):
        rows = np.sort(texts.row[np.concatenate([np.arange(texts.begin[i], texts.begin[i] + texts.parts[i]) for i in many])])
        matrix = dict(zip(rows.tolist(), transfer(texts, model, rows), strict=True))
        for i in many.tolist():
            own = texts.row[texts.begin[i]:texts.begin[i] + texts.parts[i]].tolist()
            for a, b in zip(own, own[1:], strict=False):
                v = before[a] @ matrix[a]
                before[b] = v / v.sum()
            for a, b in zip(own[-2::-1], own[:0:-1], strict=True):
                v = matrix[b] @ after[b]
                after[a] = v / v.sum()
    return np.log(total), before, after


def forward(texts: Texts, model: Model, dtype=np.float64, keep: bool = False):
    """Natural log likelihood by text, its end included; with ``keep``, what the backward recursion needs."""
    k = model.k
    logs, before, after = borders(texts, model)
    moves, words = model.moves[:, :k].astype(dtype), model.words.astype(dtype, copy=False)
    ones, a = np.ones(k, dtype), before.astype(dtype)
    last, added, kept = a.copy(), np.zeros(len(a)), []
    for t, m in enumerate(texts.active.tolist()):
        if m < len(a):
            last[m:len(a)] = a[m:]
        a = (a[:m] @ moves) * words[texts.tokens[texts.offset[:m] + t]]
        s = a @ ones
        a /= s[:, None]
        added[:m] += np.log(s)
        if keep:
            kept.append((a, s))
    last[:len(a)] = a
    logs = logs + np.bincount(texts.text, added, minlength=len(logs))
    end = last @ model.moves[:, k]
    final = texts.part == texts.parts[texts.text] - 1
    logs[texts.text[final]] += np.log(end[final])
    return (logs, before, after, last, kept) if keep else logs


def expected(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts: starts (states), moves (states x states and end), words, and the log likelihood."""
    k = model.k
    logs, before, after, last, kept = forward(texts, model, np.float32, keep=True)
    moves, words = model.moves[:, :k].astype(np.float32), model.words.astype(np.float32, copy=False)
    beta = after.astype(np.float32)
    beta /= (last * beta).sum(axis=1, keepdims=True)
    pairs, where, weight = np.zeros((k, k)), [], []
    final = texts.part == texts.parts[texts.text] - 1
    ends = (last * beta)[final].sum(axis=0, dtype=np.float64)
    for t in range(len(kept) - 1, -1, -1):
        a, s = kept[t]
        m = len(a)
        tok = texts.tokens[texts.offset[:m] + t]
        where.append(tok)
        weight.append(a * beta[:m])
        onward = beta[:m] * words[tok] / s[:, None]
        prior = kept[t - 1][0][:m] if t else before[:m].astype(np.float32)
        pairs += prior.T @ onward
        beta[:m] = onward @ moves.T
        kept[t] = None
    first = texts.row[texts.begin]
    starts = before[first] * beta[first]
    starts /= starts.sum(axis=1, keepdims=True)
    where.append(texts.tokens[texts.first])
    weight.append(starts.astype(np.float32))
    where, weight = np.concatenate(where), np.concatenate(weight)
    by_word = np.stack([np.bincount(where, weight[:, i], minlength=len(words)) for i in range(k)], axis=1)
    return starts.sum(axis=0), np.column_stack([pairs * model.moves[:, :k], ends]), by_word, float(logs.sum())


def smoothed(starts: np.ndarray, empty: float, moves: np.ndarray, share: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Start and move probabilities of the expected counts, ``share`` added to each."""
    start = np.append(starts, empty) + share
    moves = moves + share
    return start / start.sum(), moves / moves.sum(axis=1, keepdims=True)


def word_rows(by_word: np.ndarray, totals: np.ndarray, c: np.ndarray, n_words: float, unknown: float, prior: float) -> np.ndarray:
    """Word probabilities by state, an unknown word last: counts with ``prior`` words of the unigram distribution.

    Rows without counts yet (not a number) follow the unigram distribution in every state.
    """
    q = (c / n_words if n_words else c.astype(float))[:, None]
    counts = np.where(np.isnan(by_word), totals * q, by_word)
    return np.vstack([(1 - unknown) * (counts + prior * q) / (totals + prior), np.full((1, len(totals)), unknown)])


# ---------------------------------------------------------------- Spark

def blob(words: list[bytes]) -> bytes:
    """Words as one compressed value with its plain size in front; words hold no line feed."""
    plain = STOP.join(words)
    return len(plain).to_bytes(8, "little") + (pa.Codec("zstd").compress(plain, asbytes=True) if plain else b"")


def unblob(data: bytes, size: int) -> list[bytes]:
    n = int.from_bytes(data[:8], "little")
    return pa.Codec("zstd").decompress(data[8:], n, asbytes=True).split(STOP) if n else [b""] * size


def squeezed(counts: np.ndarray) -> bytes:
    """State counts of words, compressed; what is under a millionth of an occurrence is zero."""
    return pa.Codec("zstd").compress(np.where(counts < 1e-6, 0, counts).astype("<f4").tobytes(), asbytes=True)


def unsqueezed(data: bytes, rows: int, states: int) -> np.ndarray:
    plain = pa.Codec("zstd").decompress(data, 4 * rows * states, asbytes=True) if rows else b""
    return np.frombuffer(plain, "<f4").reshape(rows, states)


def rounded(counts: np.ndarray) -> bytes:
    """State counts to three digits (the upper half of 32-bit floats), compressed: enough for a round's expectations."""
    bits = np.ascontiguousarray(np.where(counts < 1e-6, 0, counts), "<f4").view("<u4")
    half = ((bits + np.uint32(0x8000)) >> np.uint32(16)).astype("<u2")
    return pa.Codec("zstd").compress(half.view(np.uint8).reshape(-1, 2).T.tobytes(), asbytes=True)


def unrounded(data: bytes, rows: int, states: int) -> np.ndarray:
    plain = pa.Codec("zstd").decompress(data, 2 * rows * states, asbytes=True) if rows else b""
    half = np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(2, -1).T).view("<u2").astype("<u4")
    return (half << np.uint32(16)).view("<f4").reshape(rows, states)


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def framed(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Rows with whole numbers that may be missing."""
    kinds = {c.split()[0]: {"long": "Int64", "int": "Int32"}[c.split()[1]] for c in schema.split(", ")
             if c.split()[1] in ("long", "int")}
    return pd.DataFrame(rows, columns=names_of(schema)).astype(kinds)


def chunks(docs: DataFrame, held_out: Column, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Whole texts encoded by chunks, with each chunk's words and how often its training texts hold them."""
    schema = CHUNK + ", size int, words binary, counts binary"

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        words, ids, flags, lens, tokens, n = LocalWords(b"", STOP), [], [], [], [], 0

        def row():
            known = list(words.ids)[2:]
            flat, size = np.concatenate(tokens), np.concatenate(lens)
            flag = np.concatenate(flags)
            train = np.repeat(flag & HELD_OUT == 0, size)
            return framed([(number, len(size), len(flat), np.concatenate(ids).tobytes(), flag.astype(np.uint8).tobytes(),
                            packed(size), packed(flat), len(known), blob(known),
                            packed(np.bincount(flat[train], minlength=len(known))))], schema)

        for batch in batches:
            texts = batch["text"].tolist()
            ends = np.cumsum([len(t) for t in texts])
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1):
                if not len(part):
                    continue
                got = words.encode((b" " + STOP + b" ").join(texts[i].translate(TABLE) for i in part).split(b" "))
                got = got[got != 0]
                at = np.flatnonzero(got == 1)
                lens.append(np.diff(np.r_[-1, at, len(got)]) - 1)
                tokens.append(got[got != 1] - 2)
                ids.append(batch["doc_id"].to_numpy(np.int64)[part])
                flags.append(batch["flag"].to_numpy(np.int64)[part])
                n += len(tokens[-1])
                if n >= chunk_words:
                    yield row()
                    words, ids, flags, lens, tokens, n, number = LocalWords(b"", STOP), [], [], [], [], 0, number + 1
        if ids:
            yield row()

    given = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                        (F.when(F.col("doc_id").isNull(), NO_ID).otherwise(0)
                         + F.when(held_out, HELD_OUT).otherwise(0)).alias("flag"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return given.mapInPandas(gather, schema)


def read_chunk(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, flags, lengths and words of a chunk's texts."""
    return (np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["flags"], np.uint8),
            unpacked(row["lens"], row["docs"]).astype(np.int64), unpacked(row["tokens"], row["n"]))


def chosen(tokens: np.ndarray, lens: np.ndarray, keep: np.ndarray) -> Texts:
    return Texts(tokens[np.repeat(keep, lens)], lens[keep])


def shard_of(word: bytes, shards: int) -> int:
    return zlib.crc32(word) % shards


def by_shard(made: DataFrame, shards: int) -> DataFrame:
    """Each chunk's words and training counts, dealt to the shards."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                words, counts = unblob(row.words, row.size), unpacked(row.counts, row.size)
                shard = np.fromiter((shard_of(w, shards) for w in words), np.int64, row.size)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
                yield framed([(row.chunk, int(shard[order[a]]), b - a, packed(order[a:b]),
                               blob([words[i] for i in order[a:b].tolist()]), packed(counts[order[a:b]]))
                              for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], WORDS)

    return made.where("size > 0").select("chunk", F.col("size").alias("size"), "words", "counts").mapInPandas(deal, WORDS)


def vocabulary(words: DataFrame, begun: DataFrame, shards: int, states: int) -> DataFrame:
    """``SHARD`` rows: every shard's known words with their first state counts, and the chunks' places there.

    A shard's task gets some ``SHARD_ENTRIES`` (chunk, word) entries, as the number of shards
    follows them.  Words without first counts have none (not a number).
    """
    def unite(frame: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
        if frame.empty:
            return pd.DataFrame(columns=names_of(SHARD))
        sizes = frame["size"].tolist()
        coded = pa.array([w for d, m in zip(frame["words"], sizes, strict=True) for w in unblob(d, m)],
                         pa.binary()).dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        n = np.concatenate([unpacked(d, m) for d, m in zip(frame["counts"], sizes, strict=True)])
        c = np.bincount(index, n, minlength=len(coded.dictionary)).astype(np.int64)
        place = np.where(c > 0, np.cumsum(c > 0) - 1, -1)
        known = int((c > 0).sum())
        e = np.full((known, states), np.nan)
        at = pc.index_in(pa.array(first["word"].tolist(), pa.binary()), coded.dictionary)
        at = pc.fill_null(at, -1).to_numpy()
        at = np.where(at >= 0, place[at], -1)
        e[at[at >= 0]] = first[[f"e{j}" for j in range(states)]].to_numpy(float)[at >= 0]
        shard, rows, a = int(frame["shard"].iloc[0]), [], 0
        for chunk, m, local in zip(frame["chunk"], sizes, frame["locals"], strict=True):
            mine = place[index[a:a + m]]
            a += m
            hit = np.flatnonzero(mine >= 0)
            if len(hit):
                rows.append((int(chunk), shard, len(hit), packed(unpacked(local, m)[hit]), packed(mine[hit]), None, None, None))
        if known:
            rows.append((None, shard, known, None, None, packed(c[c > 0], "<i8"), squeezed(e), [0.0] * states))
        return framed(rows, SHARD)

    deal = F.pmod(F.crc32("word"), F.lit(shards)).cast("int")
    return (words.groupBy("shard").cogroup(begun.withColumn("of_shard", deal).groupBy("of_shard"))
            .applyInPandas(unite, SHARD))


def first_parameters(docs: DataFrame, held_out: Column, states: int, rows: int, words: int, rounds: int, seed: int,
                     prior: float) -> DataFrame:
    """Word counts by state from a bounded sample: ``word`` and ``e0 ..``; rows without a word have the model's edges.

    The first ``rows`` training texts by id hash, of at most 20,000 bytes each, up to
    ``words`` words; one task.
    """
    columns = [f"e{i}" for i in range(states)]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local, tokens, lens = LocalWords(b""), [], []
        for batch in batches:
            for text in batch["text"]:
                got = local.encode(text.translate(TABLE).split(b" "))
                got = got[got != 0] - 1
                if len(got) and sum(lens) < words:
                    tokens.append(got)
                    lens.append(len(got))
        if not lens:
            return
        known = list(local.ids)[1:]
        texts = Texts(np.concatenate(tokens), np.asarray(lens, np.int64))
        c = np.bincount(texts.tokens, minlength=len(known)).astype(float)
        rng = np.random.default_rng(seed)
        # each text leans to some state at random, so that words which keep company start together
        lean = np.repeat(rng.dirichlet(np.full(states, 0.3), len(lens)), lens, axis=0)
        by_word = np.stack([np.bincount(texts.tokens, lean[:, i], minlength=len(known)) for i in range(states)], axis=1)
        start, moves = smoothed(np.ones(states), 0.0, 1.0 + 8.0 * states * np.eye(states, states + 1))
        for _ in range(rounds):
            b = word_rows(by_word, by_word.sum(axis=0), c, c.sum(), 0.0, prior * c.sum())[:-1]
            starts, pairs, by_word, _ = expected(texts, Model(start, moves, b))
            start, moves = smoothed(starts, 0.0, pairs)
        out = pd.DataFrame(by_word, columns=columns)
        out.insert(0, "word", known)
        edges = pd.DataFrame(np.vstack([starts, pairs[:, :states], pairs[:, states]]), columns=columns)
        edges.insert(0, "word", None)
        edges.insert(1, "edge", np.arange(len(edges)))
        yield pd.concat([out.assign(edge=-1), edges])[["word", "edge", *columns]]

    given = (docs.where(~held_out).where("octet_length(text) BETWEEN 1 AND 20000")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).coalesce(1))
    return given.mapInPandas(fit, "word binary, edge int, " + ", ".join(f"{c} double" for c in columns))


class Facts:
    """Corpus counts of the training texts: words, texts and distinct tokens."""

    def __init__(self, words: int, texts: int, distinct: int):
        self.words, self.tokens = words, words + texts
        self.texts, self.distinct = texts, distinct + (1 if texts else 0)

    def base(self, c: np.ndarray) -> np.ndarray:
        return (c + 0.1) / (self.tokens + 0.1 * (self.distinct + 1))

    def unknown(self) -> float:
        return float(self.base(np.zeros(1))[0])


class Trained:
    """Chunks, their words' places, the shards after the last round, and the rest of the model."""

    def __init__(self, made, places, shards, states, totals, start, moves, facts, prior, likelihoods):
        self.chunks, self.places, self.shards, self.states = made, places, shards, states
        self.totals, self.start, self.moves, self.facts = totals, start, moves, facts
        self.prior, self.likelihoods = prior * facts.words / states, likelihoods

    def handed(self, whole: bool) -> DataFrame:
        """``of_chunk, shard, size, locals, places, c, e``: to every chunk the counts of its words, by shard (rounded
        for training, whole for scores)."""
        schema = "of_chunk long, shard int, size int, locals binary, places binary, c binary, e binary"
        states, made = self.states, squeezed if whole else rounded

        def answer(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if asked.empty or own.empty:
                return pd.DataFrame(columns=names_of(schema))
            row = own.iloc[0]
            c, e = unpacked(row["own_c"], row["n"], "<i8"), unsqueezed(row["own_e"], row["n"], states)
            out = []
            for r in asked.itertuples():
                at = unpacked(r.places, r.size)
                out.append((r.chunk, r.shard, r.size, r.locals, r.places, packed(c[at], "<i8"), made(e[at])))
            return framed(out, schema)

        # other names: shards and places may be parts of one table
        own = self.shards.select(F.col("shard").alias("of_shard"), F.col("size").alias("n"), F.col("c").alias("own_c"),
                                 F.col("e").alias("own_e"))
        return self.places.groupBy("shard").cogroup(own.groupBy("of_shard")).applyInPandas(answer, schema)

    def assembled(self, whole: bool):
        """Function of the shards' answers and a chunk's words: the words as rows of the word probabilities (words without
        any: the last row), their training counts, and the probabilities."""
        states, totals, facts, prior, read = self.states, self.totals, self.facts, self.prior, unsqueezed if whole else unrounded

        def assemble(known: pd.DataFrame, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            sizes = known["size"].tolist()
            local = np.concatenate([np.zeros(0, np.int32), *[unpacked(d, m) for d, m in zip(known["locals"], sizes, strict=True)]])
            c = np.concatenate([np.zeros(0, np.int64), *[unpacked(d, m, "<i8") for d, m in zip(known["c"], sizes, strict=True)]])
            e = np.concatenate([np.zeros((0, states), "<f4"), *[read(d, m, states) for d, m in zip(known["e"], sizes, strict=True)]])
            b = word_rows(e.astype(float), totals, c, facts.words, facts.unknown(), prior)
            table = np.full(int(max(tokens.max(initial=0), local.max(initial=0))) + 1, len(local), np.int64)
            table[local] = np.arange(len(local))
            return table[tokens], np.append(c, 0), b

        return assemble


def train(docs: DataFrame, held_out: Column, states: int = 8, rounds: int = 3, prior: float = 0.01, seed: int = 7,
          sample_rows: int = 2000, sample_words: int = 200_000, sample_rounds: int = 25,
          chunk_words: int = CHUNK_WORDS, shard_entries: int = SHARD_ENTRIES) -> Trained:
    """Fit the model on all texts that are not held out.

    ``prior`` is the weight of the unigram distribution in a state's words, as a share of
    the state's mean number of words.  The sample bounds only concern the first parameters.
    """
    spark, columns = docs.sparkSession, [f"e{i}" for i in range(states)]
    made = cut_lineage(chunks(docs, held_out, chunk_words))
    entries = made.agg(F.sum("size")).head()[0] or 0
    begun = cut_lineage(first_parameters(docs, held_out, states, sample_rows, sample_words, sample_rounds, seed, 0.02))
    edges = {r["edge"]: np.array([r[c] for c in columns]) for r in begun.where("edge >= 0").collect()}
    first = begun.where("edge < 0").select("word", *columns)
    sampled = np.array([x or 0.0 for x in first.agg(*[F.sum(c) for c in columns]).head()])
    shards = 1 + entries // shard_entries
    words = by_shard(made.select("chunk", "size", "words", "counts"), shards)
    # first counts as the sample has them: their scale is set by the totals of the first round
    laid = cut_lineage(vocabulary(words, first, shards, states))
    release(spark)
    made = made.select(*names_of(CHUNK))
    places = laid.where(F.col("chunk").isNotNull()).select("chunk", "shard", "size", "locals", "places")
    own = laid.where(F.col("chunk").isNull()).select("shard", "size", "c", "e", "sums")
    facts = counted(made, own)
    if edges:
        start, moves = smoothed(edges[0], 0.0, np.column_stack([[edges[1 + i] for i in range(states)], edges[states + 1]]))
        totals = sampled
    else:
        start, moves = smoothed(np.ones(states), 0.0, np.ones((states, states + 1)))
        totals = np.full(states, facts.words / states)
    model = Trained(made, places, own, states, totals, start, moves, facts, prior, [])
    for k in range(rounds if facts.texts else 0):
        if k == 0 and edges:
            model.prior = prior * sampled.sum() / states
        counts = cut_lineage(expected_counts(model))
        rest = np.sum([np.frombuffer(r["e"], "<f8") for r in counts.where("shard < 0").select("e").collect()], axis=0)
        rest = rest.reshape(states + 3, states)
        start, moves = smoothed(rest[0], rest[states + 2, 0], np.column_stack([rest[1:states + 1], rest[states + 1]]))
        own = counts.where("shard >= 0").select("shard", "size", "c", "e", "sums")
        totals = np.array([x or 0.0 for x in own.agg(*[F.sum(F.col("sums")[i]) for i in range(states)]).head()])
        model = Trained(made, places, own, states, totals, start, moves, facts, prior,
                        [*model.likelihoods, float(rest[states + 2, 1])])
        release(spark)
    return model


def counted(made: DataFrame, own: DataFrame) -> Facts:
    """Training words, texts and distinct words of the corpus."""
    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [int((np.frombuffer(f, np.uint8) & HELD_OUT == 0).sum()) for f in batch["flags"]]})

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [int(unpacked(c, m, "<i8").sum()) for c, m in zip(batch["c"], batch["size"], strict=True)],
                                "m": batch["size"].astype(np.int64)})

    t = made.select("flags").mapInPandas(texts, "n long").agg(F.sum("n")).head()[0]
    w = own.select("c", "size").mapInPandas(words, "n long, m long").agg(F.sum("n"), F.sum("m")).head()
    return Facts(w[0] or 0, t or 0, w[1] or 0)


def expected_counts(model: Trained) -> DataFrame:
    """Baum-Welch counts over all chunks: ``shard, size, c, e, sums``, the shards of the next round.

    Rows of negative shards hold sums of starts, moves from each state, ends, and in the last
    line the empty texts and the log likelihood.
    """
    states, start, moves, assemble = model.states, model.start, model.moves, model.assembled(False)
    schema = "of_shard int, size int, places binary, e binary"

    def expect(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return pd.DataFrame(columns=names_of(schema))
        row = mine.iloc[0]
        _, flags, lens, tokens = read_chunk(row)
        training = flags & HELD_OUT == 0
        edge, out = np.zeros((states + 3, states)), []
        edge[states + 2, 0] = (training & (lens == 0)).sum()
        keep = training & (lens > 0)
        if keep.any():
            rows, _, b = assemble(known, tokens)
            starts, pairs, by_word, log = expected(chosen(rows, lens, keep), Model(start, moves, b))
            edge[0], edge[1:states + 1], edge[states + 1] = starts, pairs[:, :states], pairs[:, states]
            edge[states + 2, 1] = log
            at = 0
            for r in known.itertuples():
                out.append((r.shard, r.size, r.places, squeezed(by_word[at:at + r.size])))
                at += r.size
        # sixty-four sums of edges, so that no task gets those of all chunks
        out.append((-1 - int(row["chunk"] % 61 + row["chunk"] // 2 ** 32) % 64, 0, b"", edge.tobytes()))
        return framed(out, schema)

    each = cut_lineage(model.chunks.groupBy("chunk").cogroup(model.handed(False).groupBy("of_chunk"))
                       .applyInPandas(expect, schema))
    release(model.chunks.sparkSession)

    def add(counts: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        names = ["shard", "size", "c", "e", "sums"]
        if own.empty:
            total = np.sum([np.frombuffer(e, "<f8") for e in counts["e"]], axis=0)
            return pd.DataFrame([(int(counts["of_shard"].iloc[0]), 0, b"", total.tobytes(), [])], columns=names)
        row = own.iloc[0]
        total = np.zeros((int(row["size"]), states))
        for r in counts.itertuples():
            total[unpacked(r.places, r.size)] += unsqueezed(r.e, r.size, states)
        return pd.DataFrame([(int(row["shard"]), int(row["size"]), row["c"], squeezed(total),
                              total.sum(axis=0).tolist())], columns=names)

    return (each.groupBy("of_shard").cogroup(model.shards.groupBy("shard"))
            .applyInPandas(add, "shard int, size int, c binary, e binary, sums array<double>"))


def score(model: Trained) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text of the chunks."""
    states, start, moves, facts, assemble = model.states, model.start, model.moves, model.facts, model.assembled(True)

    def forward_all(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return pd.DataFrame(columns=names_of(SCORES))
        ids, flags, lens, tokens = read_chunk(mine.iloc[0])
        rows, c, b = assemble(known, tokens)
        of = np.repeat(np.arange(len(lens)), lens)
        base = np.bincount(of, np.log10(facts.base(c))[rows], minlength=len(lens))
        known_words = np.bincount(of, (c > 0)[rows], minlength=len(lens)).astype(np.int64) + int(facts.texts > 0)
        logs = np.full(len(lens), np.log(start[states]))
        if (lens > 0).any():
            logs[lens > 0] = forward(chosen(rows, lens, lens > 0), Model(start, moves, b))
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids.copy(), flags & NO_ID > 0), "held_out": flags & HELD_OUT > 0,
                             "n_tokens": lens + 1, "n_known": known_words, "train_tokens": facts.tokens,
                             "base_score": base + np.log10(facts.base(np.array([float(facts.texts)])))[0],
                             "score": logs / np.log(10)})

    return (model.chunks.groupBy("chunk").cogroup(model.handed(True).groupBy("of_chunk"))
            .applyInPandas(forward_all, SCORES))


def score_texts(docs: DataFrame, held_out: Column, **options) -> DataFrame:
    """Train on the texts that are not held out and score all of them, each whole.

    Null texts are empty; an empty text is its end alone; repeated rows are scored each (and
    counted each in training); null ids stay null.  Without training texts every state is
    alike and words are unknown.  An empty table gives an empty result; extra columns are
    ignored.
    """
    return score(train(docs, held_out, **options))
