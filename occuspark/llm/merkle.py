"""Merkle manifest of a dataset with incremental witnesses.

Leaves are hashed in the JVM and numbered inside their group by a range sort (counts per
range, then prefix sums; no window holds a group).  Positions cut a group into aligned
blocks.  A block is one streaming append: a stack of open subtrees, each with the partial
witnesses of its leaves; whenever a later sibling of the same height completes, both
subtrees become one and every witness under them gets one more step.  The roots of the
blocks are themselves appended in the next round, until each group has one root, and their
witnesses extend those of the leaves under them.  The groups' roots form a last tree in the
same way.

A witness is an array of steps ``(side, digest)`` from leaf to root: side 0 has the sibling
on the left, 1 on the right, 2 has none (the node alone becomes its own hash).
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

STEPS = "array<struct<side:int,digest:string>>"
#: Leaves of one append stream: a block's subtree is 12 levels high.
BLOCK_BITS = 12


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(start: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    def step(node, s):
        side, digest = s.getField("side"), s.getField("digest")
        both = F.when(side == 0, F.concat(digest, node)).when(side == 1, F.concat(node, digest)).otherwise(node)
        return F.sha2(both, 256)
    return F.aggregate(witness, start, step)


def proof_digest(witness: Column) -> Column:
    """Hash of all siblings, level by level."""
    siblings = F.transform(F.filter(witness, lambda s: s.getField("side") != 2), lambda s: s.getField("digest"))
    return F.sha2(F.concat_ws("", siblings), 256)


class AppendStream:
    """Nodes appended in order; open subtrees carry the partial witnesses of their nodes.

    A subtree is ``(height, hash, first, last)``.  A merge only notes the new step for the
    two runs of nodes below it, so an append costs O(1) hashes and notes on average;
    ``steps`` hands the notes out.
    """

    def __init__(self):
        self.open: list[tuple[int, str, int, int]] = []
        self.notes: list[tuple[int, int, int, str]] = []  # first, last, side, digest; heights ascend
        self.n = 0

    def append(self, digest: str) -> None:
        self.open.append((0, digest, self.n, self.n))
        self.n += 1
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge()

    def _merge(self) -> None:
        height, right, c, d = self.open.pop()
        _, left, a, b = self.open.pop()
        self.notes += [(a, b, 1, right), (c, d, 0, left)]
        self.open.append((height + 1, sha256(left + right), a, d))

    def _alone(self) -> None:
        height, digest, a, b = self.open.pop()
        self.notes.append((a, b, 2, ""))
        self.open.append((height + 1, sha256(digest), a, b))

    def close(self, height: int | None = None) -> str:
        """Finish to one root; with ``height``, lone nodes go on hashing up to that level."""
        while len(self.open) > 1:
            if self.open[-1][0] == self.open[-2][0]:
                self._merge()
            else:
                self._alone()
        while height is not None and self.open[0][0] < height:
            self._alone()
        return self.open[0][1]

    def steps(self) -> list[list[dict]]:
        """Each node's witness so far, lowest level first."""
        out: list[list[dict]] = [[] for _ in range(self.n)]
        for a, b, side, digest in self.notes:
            step = {"side": side, "digest": digest}
            for i in range(a, b + 1):
                out[i].append(step)
        return out


def laid_out(rows: DataFrame, group: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows in order inside ranges, and for each range how its rows' places follow from ``_at``.

    One range shuffle; equal rows stand in any order.  The second frame has at most one row
    for each range and group: ``_g, _r, _shift, size`` (``_at + _shift`` is the position in
    the group, from 0; ``size`` is the group's).
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = [F.col(group).asc_nulls_first(), *order]
    laid = cut_lineage(rows.repartitionByRange(parts, *key).sortWithinPartitions(*key)
                       .withColumn("_at", F.monotonically_increasing_id()))
    laid = laid.withColumn("_range", F.shiftright("_at", 33))
    ranges = laid.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    w = Window.partitionBy(group).orderBy("_range")
    return laid, ranges.select(F.col(group).alias("_g"), F.col("_range").alias("_r"),
                               (F.sum("_n").over(w) - F.col("_n") - F.col("_first")).alias("_shift"),
                               F.sum("_n").over(Window.partitionBy(group)).alias("size"))


def numbered(laid: DataFrame, ranges: DataFrame, group: str) -> DataFrame:
    """``laid_out`` rows with ``pos`` and what else ``ranges`` says of their group."""
    return (laid.join(ranges, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_g", "_r", "_shift"))


def streamed(frame: pd.DataFrame, column: str, block_bits: int) -> tuple[pd.DataFrame, AppendStream, str]:
    """A block's rows in order, their stream, and its root: raised to full height if its group has more blocks."""
    frame = frame.sort_values("pos")
    tree = AppendStream()
    for digest in frame[column]:
        tree.append(digest)
    return frame, tree, tree.close(block_bits if frame["size"].iloc[0] > 1 << block_bits else None)


def block_roots(nodes: DataFrame, column: str, block_bits: int) -> DataFrame:
    """The root of every block of ``g, pos, size`` nodes, as nodes of the next round with ``digest``."""
    def top(frame: pd.DataFrame) -> pd.DataFrame:
        frame, _, root = streamed(frame, column, block_bits)
        g, pos, size = (int(frame[c].iloc[0]) for c in ("g", "pos", "size"))
        return pd.DataFrame([(g, pos >> block_bits, (size - 1 >> block_bits) + 1, root)],
                            columns=["g", "pos", "size", "digest"])

    return (nodes.select("g", "pos", "size", column).groupBy("g", F.shiftright("pos", block_bits))
            .applyInPandas(top, "g long, pos long, size long, digest string"))


def witnessed(nodes: DataFrame, column: str, above: DataFrame, block_bits: int) -> DataFrame:
    """Every node with ``steps``: its witness in its block's stream, extended by that of the block root.

    ``above`` has a block's ``g, block``, its root's witness ``more`` and any other columns,
    which the nodes get too.
    """
    fields = [*nodes.drop("size").schema.fields, *above.drop("g", "block", "more").schema.fields]
    given = [f.name for f in above.schema.fields if f.name not in ("g", "block", "more")]

    def extend(frame: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        frame, tree, _ = streamed(frame, column, block_bits)
        more = [s if isinstance(s, dict) else s.asDict() for s in block["more"].iloc[0]]
        return frame.drop(columns="size").assign(steps=[own + more for own in tree.steps()],
                                                 **{c: block[c].iloc[0] for c in given})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return (nodes.groupBy("g", F.shiftright("pos", block_bits).alias("_block"))
            .cogroup(above.groupBy("g", "block")).applyInPandas(extend, f"{schema}, steps {STEPS}"))


def grow(nodes: DataFrame, block_bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Witnesses and roots of every group of ``g, pos, size, digest`` nodes: ``g, pos, steps`` and ``g, root``.

    Block roots are appended in the next round, until each group has one; the number of
    rounds is the height of the largest tree over ``block_bits``.
    """
    rounds = [nodes]
    while (rounds[-1].agg(F.max("size")).head()[0] or 0) > 1:
        rounds.append(cut_lineage(block_roots(rounds[-1], "digest", block_bits)))
    top = rounds.pop()
    steps = top.select("g", "pos", F.array().cast(STEPS).alias("steps"))
    while rounds:
        above = steps.select("g", F.col("pos").alias("block"), F.col("steps").alias("more"))
        steps = cut_lineage(witnessed(rounds.pop(), "digest", above, block_bits).select("g", "pos", "steps"))
    return steps, top.select("g", F.col("digest").alias("root"))


def manifest(docs: DataFrame, tampered: Column | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``doc_id, lang, pos, leaf, changed, steps, subroot, root``: each row's leaf, place and whole witness.

    A leaf hashes ``doc_id, source, lang, n_chars, text`` (nulls as ``-``).  Leaves of a
    lang (null is a group of its own) ascend by ``doc_id``, null first, equal ids by leaf;
    repeated rows are leaves of their own.  A lang of one leaf has that leaf as its root;
    an empty table gives an empty result.  Extra columns are ignored.  ``changed`` is the
    leaf with 1 added to ``n_chars`` where ``tampered`` holds (it plays no part in the tree).

    Texts are read once, by the leaf hash; from then on rows have some 200 bytes.  A block's
    leaves are streamed twice: for its root, and for the witnesses once its root has its own.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.lit(False) if tampered is None else tampered
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       leaf_hash(*[F.col(c) for c in names]).alias("leaf"),
                       F.when(tampered, leaf_hash(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in names]))
                       .alias("changed"))
    laid, ranges = laid_out(base, "lang", [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    laid = laid.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no null among whole numbers
    ranges = cut_lineage(ranges)
    # the groups in order: one row a lang, numbered like the leaves
    langs = numbered(*laid_out(ranges.select(F.col("_g").alias("lang"), F.lit(0).cast("long").alias("_all")).distinct(),
                               "_all", [F.col("lang").asc_nulls_first()]), "_all")
    langs = cut_lineage(langs.select(F.col("lang").alias("_l"), F.col("pos").alias("g"), F.col("size").alias("_langs")))
    places = ranges.join(langs.select("_l", "g"), F.col("_g").eqNullSafe(F.col("_l"))).drop("_l")
    placed = cut_lineage(numbered(laid, places, "lang"))
    blocks, subroots = grow(cut_lineage(block_roots(placed, "leaf", block_bits)), block_bits)
    subroots = cut_lineage(subroots)
    top = subroots.join(langs.select("g", "_langs"), "g").select(
        F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.col("_langs").alias("size"),
        F.col("root").alias("digest"))
    top_steps, root = grow(cut_lineage(top), block_bits)
    top_steps = top_steps.join(root, "g").select(F.col("pos").alias("g"), F.col("steps").alias("_top"), "root")
    above = (blocks.join(subroots.withColumnRenamed("root", "subroot").join(top_steps, "g"), "g")
             .select("g", F.col("pos").alias("block"), F.concat("steps", "_top").alias("more"), "subroot", "root"))
    return (witnessed(placed, "leaf", cut_lineage(above), block_bits)
            .select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "pos", "leaf", "changed", "steps", "subroot",
                    "root"))


def verify(made: DataFrame) -> DataFrame:
    """Recompute each root from the changed leaf (if any, else the leaf) and the original witness."""
    return (made.withColumn("proof_sha256", proof_digest(F.col("steps")))
            .withColumn("folded_root", fold(F.coalesce(F.col("changed"), F.col("leaf")), F.col("steps")))
            .withColumn("verified", F.col("folded_root") == F.col("root"))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


def id_hit(modulus: int) -> Column:
    """True where ``modulus`` divides the unsigned crc32 of the decimal ``doc_id`` (null: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0, F.lit(False))
