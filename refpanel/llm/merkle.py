"""Merkle manifest of a data set with incrementally kept witnesses.

Rows are leaves of one tree per group, the groups' roots are leaves of the tree of the whole. A
tree is built by appending leaves in order: every leaf holds the witness it has so far, and as soon
as a sibling of one of its ancestors is complete that sibling extends it. Aligned blocks of leaves
are separate tasks; a block's root is an append to the tree of blocks above it, and the witness
that it gains there extends those of all its leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import shuffles_removed, store

ARITY = 3
#: Levels that a block of leaves spans: ``ARITY ** BLOCK_LEVELS`` leaves at most.
BLOCK_LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def parent(digests: list[bytes]) -> bytes:
    """Digest of the concatenated hexadecimal digests."""
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


def fold(leaf: bytes, witness: bytes, sides: bytes) -> bytes:
    """The root that a leaf and its witness give; ``sides`` has a byte for each level: siblings to
    the left times ``ARITY``, and siblings to the right."""
    at = 0
    for side in sides:
        left, right = divmod(side, ARITY)
        run = [witness[at + 32 * k : at + 32 * k + 32] for k in range(left + right)]
        leaf = parent([*run[:left], leaf, *run[left:]])
        at += 32 * (left + right)
    return leaf


class OpenTree:
    """Subtrees that still wait for siblings, and the partial witness of every leaf below them."""

    def __init__(self):
        self.runs: list[list[tuple[bytes, int, int]]] = [[]]
        self.witness: list[bytearray] = []
        self.sides: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        self.witness.append(bytearray())
        self.sides.append(bytearray())
        node, level = (leaf, len(self.witness) - 1, len(self.witness)), 0
        self._complete(node, level)
        while len(self.runs[level]) == ARITY:
            node = self._closed(level)
            level += 1
            self._complete(node, level)

    def _complete(self, node: tuple[bytes, int, int], level: int) -> None:
        """A subtree is complete: it and its elder siblings extend each other's witnesses."""
        while len(self.runs) <= level:
            self.runs.append([])
        digest, lo, hi = node
        for elder, a, b in self.runs[level]:
            for k in range(a, b):
                self.witness[k] += digest
                self.sides[k][level] += 1
            for k in range(lo, hi):
                self.witness[k] += elder
        for k in range(lo, hi):
            self.sides[k].append(ARITY * len(self.runs[level]))
        self.runs[level].append(node)

    def _closed(self, level: int) -> tuple[bytes, int, int]:
        run, self.runs[level] = self.runs[level], []
        return parent([d for d, _, _ in run]), run[0][1], run[-1][2]

    def close(self, height: int) -> bytes:
        """No leaf follows: open runs become nodes up to ``height``; returns the root."""
        for level in range(height):
            if level < len(self.runs) and self.runs[level]:
                self._complete(self._closed(level), level + 1)
        return self.runs[height][0][0]


def numbered(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (from 0, in ``order`` within the group) and ``size`` of the group.

    Rows are ranged over all tasks by group and order, so a group that holds most of them is
    shared out; each task counts its rows of a group and starts after those of the tasks before."""
    keys = ([group] if group else []) + order
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_pos", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = object(), 0  # equal to no name
        for batch in batches:
            names = batch.column(schema.names.index(group)).to_pylist() if group else [0] * batch.num_rows
            pos = []
            for name in names:
                n = n + 1 if name == last else 0
                last = name
                pos.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos, pa.int64())], schema.names)

    placed = store(ranged.mapInArrow(count, schema), "placed")
    name = F.col(group) if group else F.lit(0)
    parts = placed.groupBy(name.alias("_of"), F.col("_part").alias("_p")).agg((F.max("_pos") + 1).alias("n"))
    by_group = Window.partitionBy("_of")
    before = F.coalesce(F.sum("n").over(by_group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = store(parts.select("_of", "_p", before.alias("_before"), F.sum("n").over(by_group).alias("size")), "parts")
    same = (F.col("_part") == F.col("_p")) & name.eqNullSafe(F.col("_of"))
    return placed.join(parts, same).withColumn("idx", F.col("_pos") + F.col("_before")).drop("_of", "_p", "_part", "_pos", "_before")


def _tier(nodes: DataFrame, group: T.DataType) -> DataFrame:
    """``g, idx, witness, sides, block, root`` of nodes (g, idx, size, digest), block by block."""
    span = ARITY**BLOCK_LEVELS
    schema = T.StructType([T.StructField("g", group), *T.StructType.fromDDL("idx long, size long, witness binary, sides binary, block long, root binary").fields])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, rows, key = OpenTree(), [], None

        def closed() -> pa.RecordBatch:
            size, height = rows[0][2], 0
            while height < BLOCK_LEVELS and (size > span or ARITY**height < size):
                height += 1
            root = tree.close(height)
            sides = [bytes(s[:height]) for s in tree.sides]
            full = [(g, i, n, bytes(w), s, i // span, root) for (g, i, n), w, s in zip(rows, tree.witness, sides)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*full), arrow)], schema.names)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            arrow = [batch.schema.field("g"), *(pa.field("", t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()))]
            for g, idx, size, digest in zip(*columns):
                if rows and key != (g, idx // span):
                    yield closed()
                    tree, rows = OpenTree(), []
                key = g, idx // span
                tree.append(digest)
                rows.append((g, idx, size))
        if rows:
            yield closed()

    rows = nodes.select("g", "idx", "size", "digest").withColumn("_b", F.floor(F.col("idx") / span))
    return rows.repartition("g", "_b").sortWithinPartitions("g", "_b", "idx").drop("_b").mapInArrow(grow, schema)


def witnesses(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees of nodes ``(g, idx, size, digest)``: ``(g, idx, witness, sides)`` and ``(g, root)``.

    One pass over the blocks and one over the roots of blocks above each level of them; a thousand
    million leaves in a group take four."""
    group = nodes.schema["g"].dataType
    grown = store(_tier(nodes, group), "tier")
    span = ARITY**BLOCK_LEVELS
    tops = grown.filter(F.col("idx") % span == 0)
    single = tops.filter(F.col("size") <= span).select("g", "root")
    above = tops.filter(F.col("size") > span).select("g", F.col("block").alias("idx"), F.ceil(F.col("size") / span).alias("size"), F.col("root").alias("digest"))
    mine = grown.select("g", "idx", "block", "witness", "sides")
    if above.isEmpty():
        return mine.drop("block"), single
    upper, roots = witnesses(above)
    upper = store(upper.select(F.col("g").alias("_g"), F.col("idx").alias("_block"), F.col("witness").alias("_w"), F.col("sides").alias("_s")), "upper")
    none = F.lit(b"")
    more = mine.join(upper, F.col("g").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_block")), "left")
    full = more.select("g", "idx", F.concat("witness", F.coalesce("_w", none)).alias("witness"), F.concat("sides", F.coalesce("_s", none)).alias("sides"))
    return full, single.unionByName(roots)


def leaf_digest(columns: list[Column]) -> Column:
    """Hexadecimal digest of values: each ``-`` if null, else its length in bytes, ``:``, itself."""
    value = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(value, columns)), 256)


def manifest(leaves: DataFrame, group_col: str, order_cols: list[str], leaf_col: str = "leaf") -> DataFrame:
    """``leaves`` with ``subroot``, ``root``, ``witness`` and ``sides``.

    Leaves of a group ascend by ``order_cols``; three at a time become a node, the last run may be
    shorter, until one is left: the group's ``subroot``. Subroots, by group (null first, bytewise),
    give ``root`` likewise. A witness is the digests of the siblings from the leaf up to the root,
    left to right. Rows that are equal in all of these columns may change places, which gives the
    same manifest."""
    rows = leaves.withColumns({"_g": F.col(group_col).cast("string"), "_d": F.unhex(leaf_col)})
    placed = store(numbered(rows, "_g", [*order_cols, "_d"]), "leaves")
    grown, subroots = witnesses(placed.select(F.col("_g").alias("g"), "idx", "size", F.col("_d").alias("digest")))
    subroots = numbered(subroots.select(F.col("g").alias("_name"), F.col("root").alias("digest")), None, ["_name"])
    subroots = store(subroots.withColumn("g", F.lit(0)), "subroots")
    upper, roots = witnesses(subroots)
    tops = subroots.join(upper.select("idx", "witness", "sides"), "idx").join(roots, "g")
    tops = store(tops.select("_name", F.col("digest").alias("subroot"), "root", F.col("witness").alias("_w"), F.col("sides").alias("_s")), "tops")
    grown = grown.select(F.col("g").alias("_h"), F.col("idx").alias("_i"), "witness", "sides")
    joined = placed.join(grown, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("idx") == F.col("_i"))).join(tops, F.col("_g").eqNullSafe(F.col("_name")))
    both = {"witness": F.concat("witness", "_w"), "sides": F.concat("sides", "_s"), "subroot": F.lower(F.hex("subroot")), "root": F.lower(F.hex("root"))}
    return joined.withColumns(both).drop("_g", "_d", "_h", "_i", "_w", "_s", "_name", "idx", "size")


def folded(rows: DataFrame, leaf_col: str, name: str = "folded_root") -> DataFrame:
    """``rows`` with the root that ``leaf_col`` (hexadecimal) gives with the row's witness."""
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])
    at = [rows.columns.index(c) for c in (leaf_col, "witness", "sides")]

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fold(bytes.fromhex(leaf), w, s).hex() for leaf, w, s in zip(*(batch.column(k).to_pylist() for k in at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], schema.names)

    return rows.mapInArrow(roots, schema)


def audit(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", tampered: Column | None = None) -> DataFrame:
    """One row per input row: ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    Rows for which ``tampered`` holds (null: does not) are checked with their text without line
    feeds against the manifest of the original rows. Nulls in any column are values of their own;
    rows without an id come first in their group; repeated rows are leaves of their own; further
    columns are ignored; no rows give no rows.
    """
    columns = lambda text: [text if c == text_col else F.col(c) for c in fields]
    original, spoilt = F.col(text_col), F.replace(F.col(text_col).cast("string"), F.lit("\n"), F.lit(""))
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaf = leaf_digest(columns(original))
    with shuffles_removed(docs.sparkSession):
        leaves = docs.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_group"), leaf.alias("leaf"), F.when(tampered, leaf_digest(columns(spoilt))).alias("_checked"))
        found = manifest(store(leaves, "digests"), "_group", ["_id"])
    found = folded(found.withColumn("_checked", F.coalesce("_checked", "leaf")), "_checked")
    proof = F.sha2(F.lower(F.hex("witness")), 256).alias("proof_sha256")
    return found.select(F.col("_id").alias(id_col), "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
