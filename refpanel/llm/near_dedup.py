"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
a signature takes half the hash evaluations of plain min-hashing; both estimate the similarity
without bias and together with less variance. Bands of signature values propose candidates, every
link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import LOWER, hash_cache, store, texts_of
from refpanel.llm.components import components

#: 100 permutations give 200 values: 40 bands of 5. A pair at similarity 0.8 shares no band with
#: probability (1 - 0.8**5)**40, about 1e-7.
PERMUTATIONS = 100
BAND_ROWS = 5
#: Documents of a block, and shingles of two blocks that are counted together.
BLOCK = 256
COLUMNS = 8192
_ODD = np.random.default_rng(20240229).integers(0, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(20240301).integers(0, 2**64, PERMUTATIONS, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(words: list[bytes], numbers: dict, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``width``-word shingles; fewer words make one shingle."""
    w = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    n = max(len(w) - width + 1, min(len(w), 1))
    h = np.zeros(n, np.uint64)
    for k in range(min(width, len(w))):
        h = _mixed(h * _MIX + w[k : k + n])
    return np.unique(h)


def bands(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of the min-max signature."""
    low = np.full(PERMUTATIONS, 2**64 - 1, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for k in range(0, len(shingles), 512):
        p = shingles[k : k + 512, None] * _ODD + _ADD
        np.minimum(low, p.min(axis=0), out=low)
        np.maximum(high, p.max(axis=0), out=high)
    rows = np.concatenate([low, high]).reshape(-1, BAND_ROWS)
    key = np.arange(len(rows), dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = _mixed(key * _MIX + rows[:, k])
    return key


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text"))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, node`` (digest of the shingle set) and ``bands`` of every row; null node
    and bands where there are no words."""
    fields = ["n_shingles long", "node binary", "bands array<long>"]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL(", ".join(fields)).fields])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = hash_cache()
        for batch in batches:
            out = []
            for text in texts_of(batch, "_text"):
                found = shingle_set(text.translate(LOWER).split(), numbers, width)
                out.append((len(found), _digest(found), bands(found).astype(np.int64)) if len(found) else (0, None, None))
                numbers.trim()
            sizes, nodes, keys = zip(*out) if out else ((), (), ())
            columns = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return _rows(docs, id_col, text_col).mapInArrow(signed, schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles`` for the rows named in ``wanted`` (id, node), one for each node."""
    schema = T.StructType.fromDDL("node binary, shingles array<long>")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = hash_cache()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [(shingle_set(t.translate(LOWER).split(), numbers, width), node) for t, node in zip(texts_of(part, "_text"), part.column("node").to_pylist())]
                found = [(node, x.astype(np.int64)) for x, node in found if len(x) and _digest(x) == node]  # ids may repeat
                numbers.trim()
                nodes, arrays = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(arrays, pa.list_(pa.int64()))], schema.names)

    rows = _rows(docs, id_col, text_col).join(wanted.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id"))).select("_text", "node")
    return rows.mapInArrow(sets, schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: the similarity of the full sets is ``percent`` % or more."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", (100 * both >= percent * (F.size("sa") + F.size("sb") - both)).alias("linked"))


def _compare(percent: int):
    """Links between the documents of two blocks, or of one, that are not yet one component."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf.side == 0].reset_index(drop=True)
        right = pdf[pdf.side == 1].reset_index(drop=True) if (pdf.side == 1).any() else left
        n = [np.array([len(x) for x in side.shingles]) for side in (left, right)]
        flat = np.concatenate([*left.shingles, *right.shingles])
        row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(n))
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[column] > 1
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        both = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(column, kind="stable")
        for lo in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
            mine = order[np.searchsorted(column[order], lo) : np.searchsorted(column[order], lo + COLUMNS)]
            cells = np.zeros((len(left) + len(right), COLUMNS), np.float32)
            cells[row[mine], column[mine] - lo] = 1
            both += cells[: len(left)] @ cells[len(left) :].T
        linked = 100 * both >= percent * (n[0][:, None] + n[1] - both)
        linked &= left.comp.to_numpy()[:, None] != right.comp.to_numpy()
        top, out = {}, []

        def find(x):
            while top.get(x, x) != x:
                x = top[x]
            return x

        for i, j in np.argwhere(linked):  # a spanning set of the links is enough
            u, v = find(left.comp[i]), find(right.comp[j])
            if u != v:
                top[max(u, v)] = min(u, v)
                out.append((left.node[i], right.node[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return compare


def _remaining(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members (key, node, comp) of a bucket that are of different components.

    Members are put into blocks of about ``BLOCK``, those of one large bucket together; every two
    blocks with a common bucket meet once, whole, so every proposed pair is compared while pairs
    are neither rows of a table nor repeated for each bucket.
    """
    sizes = store(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    home = rows.join(sizes, "key").groupBy("node").agg(F.max(F.struct("n", "key")).alias("m"), F.first("comp").alias("comp"))
    home = store(home.select("node", "comp", F.col("m.key").alias("label")), "home")
    parts = home.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    block = F.struct("label", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"))
    home = store(home.join(store(parts, "parts"), "label").select("node", "comp", F.xxhash64(block).alias("block")), "blocks")
    held = store(rows.select("key", "node").join(home.select("node", "block"), "node").select("key", "block").distinct(), "held")
    pairs = held.toDF("key", "one").join(held.toDF("key", "two"), "key").filter("one <= two").select("one", "two").distinct()
    pairs = store(pairs, "block-pairs")
    full = home.join(sets, "node")
    sides = [(0, "one", pairs), (1, "two", pairs.filter("one <> two"))]
    dealt = [p.join(full.withColumnRenamed("block", c), c).select("one", "two", F.lit(k).alias("side"), "node", "comp", "shingles") for k, c, p in sides]
    return dealt[0].unionByName(dealt[1]).groupBy("one", "two").applyInPandas(_compare(percent), "a binary, b binary")


def links(docs: DataFrame, signed: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, root): components of the nodes (distinct shingle sets) that some link touches.

    First every bucket names a hub and all its members are compared with that, which takes about
    as many comparisons as members and makes one component of an ordinary group of copies. Buckets
    that still hold several components are then compared exhaustively, in blocks.
    """
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = store(nodes, "nodes")
    rows = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = store(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"), "buckets")
    members = store(rows.join(shared, "key"), "members")
    wanted = nodes.join(store(members.select("node").distinct(), "wanted"), "node").select("id", "node")
    sets = store(shingle_sets(docs, wanted, width, id_col, text_col), "sets")
    hubs = members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("h"))
    hubs = store(hubs.select("key", F.col("h.node").alias("hub"), F.col("h.n").alias("hn")), "hubs")
    alike = (100 * F.least("n", "hn") >= percent * F.greatest("n", "hn")) & (F.col("node") != F.col("hub"))
    pairs = store(members.join(hubs, "key").filter(alike).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    stars = components(_confirmed(pairs, sets, percent).filter("linked"))
    rows = members.select("key", "node").join(stars.withColumnRenamed("root", "comp"), "node", "left")
    rows = store(rows.withColumn("comp", F.coalesce("comp", "node")), "members")
    mixed = store(rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key"), "mixed")
    if mixed.isEmpty():
        return stars
    rest = store(_remaining(store(rows.join(mixed, "key"), "mixed"), sets, percent), "links")
    return components(rest.unionByName(stars.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``n_shingles``, ``component_id`` (smallest id that links reach) and
    ``kept`` (it is that id).

    Null and empty texts, and texts without words, have no shingles, are linked with nothing and
    are kept. Equal shingle sets are one node from the start. Rows that repeat an id are one
    document if their texts link, and each is judged by its text otherwise.
    """
    signed = store(signatures(docs, width, id_col, text_col), "signatures")
    roots = links(docs, signed, width, percent, id_col, text_col)
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first"))
    nodes = store(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "roots")
    smallest = store(nodes.groupBy("root").agg(F.min("first").alias("component")), "smallest")
    named = store(nodes.join(smallest, "root").select("node", "component"), "named")
    rows = signed.select("id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
