"""Phrase collocations by relational mining of sorted occurrence relations (SETM).

Relation ``R1`` holds every word occurrence ``(piece, position, word)`` in order, stored
chunk by chunk: a chunk has whole texts of one language, some million words, with the
places as steps (the end of a piece takes a place of its own, so neighbours in a piece are
one apart) and the words as ids of the chunk's dictionary.  Then, for each length:

1. groups are counted over all chunks, and those under ``least`` go;
2. the relation is semi-joined to the frequent groups, which every chunk is handed by key;
3. it is merge-joined with itself by piece and adjacent position, which gives the next
   relation: sorted, and without any shuffle of occurrences, since a chunk holds whole pieces.

Only a chunk's distinct groups are shuffled, with their counts, in blocks by key hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, release, trim

#: Bytes that end a piece become a line feed; capitals and tabs become small letters and spaces.
END = b"\n"
TABLE = bytes(ord(END) if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
              for c in range(256))
CHUNK_WORDS = 1_000_000
SLICE_BYTES = 2 << 20

RELATION = "chunk long, lang string, n long, steps binary, groups binary"
BLOCKS = RELATION + ", shard int, first long, size int, lefts binary, rights binary, counts binary"
COUNTED = ("chunk long, locals array<int>, gids array<long>, lefts array<long>, rights array<long>, "
           "counts array<long>")


def packed(values: np.ndarray, kind: str = "<i4") -> bytes:
    """Little-endian integers, compressed."""
    return pa.Codec("zstd").compress(np.ascontiguousarray(values, kind).tobytes(), asbytes=True)


def unpacked(data: bytes, n: int, kind: str = "<i4") -> np.ndarray:
    size = np.dtype(kind).itemsize * int(n)
    return np.frombuffer(pa.Codec("zstd").decompress(data, size, asbytes=True), kind) if n else np.zeros(0, kind)


class LocalWords:
    """Ids of a chunk's words, in the order in which they are first met."""

    def __init__(self, *known: bytes):
        self.ids = {w: i for i, w in enumerate(known)}

    def encode(self, words: list[bytes]) -> np.ndarray:
        coded = pa.array(words, pa.binary()).dictionary_encode()
        ids = self.ids
        here = np.fromiter((ids.setdefault(w, len(ids)) for w in coded.dictionary.to_numpy(zero_copy_only=False)), np.int32,
                           len(coded.dictionary))
        return here[coded.indices.to_numpy()] if len(here) else np.zeros(0, np.int32)


class Chunk:
    """Occurrences of whole texts of one language, gathered until there are enough."""

    def __init__(self):
        self.words, self.at, self.groups = LocalWords(b"", END), [], []
        self.place = self.n = 0

    def add(self, texts: list[bytes]) -> None:
        ids = self.words.encode(END.join(texts).translate(TABLE).replace(END, b" \n ").split(b" "))
        ids = ids[ids != 0]
        keep = np.flatnonzero(ids != 1)
        self.at.append(keep.astype(np.int64) + self.place)
        self.groups.append(ids[keep] - 2)
        self.place += len(ids) + 1
        self.n += len(keep)

    def row(self, chunk: int, lang: str) -> tuple:
        at, groups = np.concatenate(self.at), np.concatenate(self.groups)
        words = list(self.words.ids)[2:]
        return (chunk, lang, self.n, packed(np.diff(at, prepend=0)), packed(groups), words,
                np.bincount(groups, minlength=len(words)).tolist())


def occurrences(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Relation ``R1`` by chunks, with each chunk's words and their counts there."""
    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*[c.split()[0] for c in RELATION.split(", ")], "words", "counts"]
        open_: dict[str, Chunk] = {}
        number = (TaskContext.get().partitionId()) << 32
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                texts = texts.tolist()
                ends = np.cumsum([len(t) for t in texts])
                for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1):
                    chunk = open_.setdefault(lang, Chunk())
                    chunk.add([texts[i] for i in part])
                    if chunk.n >= chunk_words:
                        yield pd.DataFrame([open_.pop(lang).row(number, lang)], columns=columns)
                        number += 1
        for lang, chunk in open_.items():
            if chunk.n:
                yield pd.DataFrame([chunk.row(number, lang)], columns=columns)
                number += 1
        trim()

    given = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").cast("binary").alias("text")).where("length(text) > 0")
    return given.mapInPandas(gather, RELATION + ", words array<binary>, counts array<int>")


def shard_of(left: np.ndarray, right: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each pair of ids, by a 64-bit mix."""
    x = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ right.astype(np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(shards)).astype(np.int64)


def extended(relation: DataFrame, frequent: DataFrame, shards: int) -> DataFrame:
    """Semi-join each chunk to its frequent groups, then merge-join it with itself one place on.

    ``frequent`` has ``chunk, local, gid`` rows, the last two as arrays or as numbers.  The
    result holds the longer relation (``shard`` null) and, for each shard of keys, the
    chunk's distinct groups ``(left gid, right gid)`` with their counts.
    """
    columns = [c.split()[0] for c in BLOCKS.split(", ")]

    def join(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or known.empty:
            return pd.DataFrame(columns=columns)
        row = mine.iloc[0]
        local, gid = (np.concatenate([np.atleast_1d(x) for x in known[c]]).astype(np.int64) if known[c].dtype == object
                      else known[c].to_numpy(np.int64) for c in ("local", "gid"))
        order = np.argsort(gid)  # so that a shard's keys ascend, and pack well
        local, gid = local[order], gid[order]
        at, groups = np.cumsum(unpacked(row["steps"], row["n"]), dtype=np.int64), unpacked(row["groups"], row["n"])
        table = np.full(max(int(groups.max()), int(local.max())) + 1, -1, np.int64)
        table[local] = np.arange(len(local))
        mark = table[groups]
        keep = np.flatnonzero(mark >= 0)
        at, mark = at[keep], mark[keep]
        hit = np.flatnonzero(at[1:] == at[:-1] + 1)
        if not len(hit):
            return pd.DataFrame(columns=columns)
        key, where, counts = np.unique(mark[hit] * len(local) + mark[hit + 1], return_inverse=True, return_counts=True)
        left, right = gid[key // len(local)], gid[key % len(local)]
        shard = shard_of(left, right, shards)
        order = np.argsort(shard, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        base = (row["chunk"], row["lang"])
        out = [(*base, len(hit), packed(np.diff(at[hit], prepend=0)), packed(rank[where]), *[None] * 6)]
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = order[a:b]
            out.append((*base, None, None, None, int(shard[part[0]]), a, b - a, packed(np.diff(left[part], prepend=0), "<i8"),
                        packed(right[part], "<i8"), packed(counts[part])))
        del local, gid, at, groups, table, mark, key, where, counts, left, right, rank
        trim()
        return pd.DataFrame(out, columns=columns).astype({"n": "Int64", "shard": "Int32", "first": "Int64", "size": "Int32"})

    frequent = frequent.withColumnRenamed("chunk", "of_chunk")
    return relation.groupBy("chunk").cogroup(frequent.groupBy("of_chunk")).applyInPandas(join, BLOCKS)


def counted(blocks: DataFrame, least: int) -> DataFrame:
    """Groups of at least ``least`` occurrences over all chunks, and each chunk's share of them.

    A shard of keys is one task: its size is that of some million distinct (chunk, group)
    entries, as the number of shards follows the words.  Rows without ``chunk`` hold
    the shard's frequent groups, the others hand a chunk its own.
    """
    names = [c.split()[0] for c in COUNTED.split(", ")]

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        size = frame["size"].tolist()
        left = np.concatenate([np.cumsum(unpacked(d, m, "<i8")) for d, m in zip(frame["lefts"], size, strict=True)])
        right = np.concatenate([unpacked(d, m, "<i8") for d, m in zip(frame["rights"], size, strict=True)])
        n = np.concatenate([unpacked(d, m) for d, m in zip(frame["counts"], size, strict=True)]).astype(np.int64)
        order = np.lexsort((right, left))
        left, right, n = left[order], right[order], n[order]
        first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
        total = np.add.reduceat(n, first)
        often = total >= least
        if not often.any():
            return pd.DataFrame(columns=names)
        gid = np.where(often, (int(frame["shard"].iloc[0]) << 32) + np.cumsum(often) - 1, -1)
        of = np.empty(len(order), np.int64)
        of[order] = np.repeat(gid, np.diff(np.r_[first, len(order)]))
        empty = np.zeros(0, np.int64)
        rows = [(None, empty, gid[often], left[first][often], right[first][often], total[often])]
        at = 0
        for chunk, begin, m in zip(frame["chunk"], frame["first"], size, strict=True):
            mine = of[at:at + m]
            at += len(mine)
            hit = np.flatnonzero(mine >= 0)
            if len(hit):
                rows.append((int(chunk), (hit + int(begin)).astype(np.int32), mine[hit], empty, empty, empty))
        del left, right, n, order, of
        trim()
        return pd.DataFrame(rows, columns=names).astype({"chunk": "Int64"})

    return (blocks.where(F.col("shard").isNotNull()).select("chunk", "shard", "first", "size", "lefts", "rights", "counts")
            .groupBy("shard").applyInPandas(count, COUNTED))


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, chunk_words: int = CHUNK_WORDS,
                     shard_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, f`` of all phrases up to ``longest`` words met ``least`` times or more, and
    ``lang, n``, the words of each language.

    Texts are lower-cased A-Z and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``, those into words
    at spaces and tabs; occurrences may overlap.  Null texts are empty, a null lang is ``und``;
    repeated rows count again; an empty table gives empty results.
    """
    relation = cut_lineage(occurrences(docs, chunk_words))
    n = cut_lineage(relation.groupBy("lang").agg(F.sum("n").alias("n")))
    words = relation.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "chunk", "lang", F.col("pos").alias("local"), F.col("col.words").cast("string").alias("phrase"),
        F.col("col.counts").alias("c"))
    singles = (words.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
               .withColumn("gid", F.monotonically_increasing_id()))
    level = cut_lineage(singles.select("lang", "phrase", F.lit(1).alias("k"), "f", "gid"))
    known = words.join(level.select("lang", "phrase", "gid"), ["lang", "phrase"]).select("chunk", "local", "gid")
    release(docs.sparkSession)
    shards = 1 + (n.agg(F.sum("n")).head()[0] or 0) // shard_words
    found, relation = level.drop("gid"), relation.select("chunk", "lang", "n", "steps", "groups")
    for k in range(2, longest + 1):
        blocks = cut_lineage(extended(relation, known, shards))
        release(docs.sparkSession)
        groups = cut_lineage(counted(blocks, least))
        relation = blocks.where(F.col("shard").isNull()).select("chunk", "lang", "n", "steps", "groups")
        known = groups.where(F.col("chunk").isNotNull()).select("chunk", F.col("locals").alias("local"),
                                                                 F.col("gids").alias("gid"))
        pairs = groups.where(F.col("chunk").isNull()).select(F.explode(F.arrays_zip("gids", "lefts", "rights", "counts")))
        pairs = pairs.select("col.*")
        side = level.select("gid", "lang", "phrase")
        level = cut_lineage(
            pairs.join(side.withColumnsRenamed({"gid": "lefts", "phrase": "a"}), "lefts")
            .join(side.select(F.col("gid").alias("rights"), F.substring_index("phrase", " ", -1).alias("b")), "rights")
            .select("lang", F.concat_ws(" ", "a", "b").alias("phrase"), F.lit(k).alias("k"),
                    F.col("counts").alias("f"), F.col("gids").alias("gid")))
        found = found.unionByName(level.drop("gid"))
        release(docs.sparkSession)
    return found, n


def part(phrase: str, k: int, first: int, length: int):
    """Column: ``length`` words of a phrase of ``k`` words from the word ``first`` (from 0)."""
    return F.substring_index(F.substring_index(phrase, " ", first + length), " ", -length)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, most: int = 2000, inside_percent: int = 50,
                 **options) -> DataFrame:
    """Each language's first ``most`` phrases of 2 to ``longest`` words by score, exact in integers.

    The score is ``floor(1000000 a a / (l r))`` of the phrase's lowest-scoring cut.  A phrase
    goes if it lies inside a longer frequent one that makes up ``inside_percent`` of it.
    """
    found, n = frequent_phrases(docs, longest, least, **options)
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    cuts, inside = [], []
    for k in range(2, longest + 1):
        of_k = found.where(F.col("k") == k)
        cuts.append(of_k.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.array(*[
            F.struct(F.lit(j).alias("cut"), part("phrase", k, 0, j).alias("head"), part("phrase", k, j, k - j).alias("tail"))
            for j in range(1, k)])).alias("c")).select("lang", "phrase", "a", "c.*"))
        subs = [part("phrase", k, i, m) for m in range(2, k) for i in range(k - m + 1)]
        if subs:
            inside.append(of_k.select("lang", "f", F.explode(F.array(*subs)).alias("phrase")))
    known = found.select("lang", "phrase", "f")
    all_cuts = cuts[0]
    for c in cuts[1:]:
        all_cuts = all_cuts.unionByName(c)
    scored = (all_cuts.join(known.withColumnsRenamed({"phrase": "head", "f": "l"}), ["lang", "head"])
              .join(known.withColumnsRenamed({"phrase": "tail", "f": "r"}), ["lang", "tail"])
              .withColumn("up", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")))
              .withColumn("down", wide("l") * wide("r"))
              .withColumn("score", F.expr("up div down"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
              .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))
    if inside:
        longer = inside[0]
        for x in inside[1:]:
            longer = longer.unionByName(x)
        longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
        scored = (scored.join(longer, ["lang", "phrase"], "left")
                  .where(~F.coalesce(100 * F.col("_longer") >= inside_percent * F.col("a"), F.lit(False))).drop("_longer"))
    first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)
    return top.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
