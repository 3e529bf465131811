"""Near-duplicate documents by SimHash fingerprints and deletion-variant signatures.

Fingerprints of 64 bits link at a few differing bits. A plain index cuts them into more segments
than bits may differ, so that one is equal; here they are cut into fewer, so that one differs by at
most one bit. Each segment is indexed with one of its bits left out in turn: two values that differ
in one bit agree where that bit is left out. Candidates come from an equality join on these
variants and every link is verified on the whole fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import LOWER, shuffles_removed, store, texts_of
from refpanel.llm.components import components

BITS = 64
#: Seed of the shingle hash.
SEED = 42
#: Shingles hashed together, which bounds what one very long text takes.
HASHED = 65_536
#: Members of a bucket that one task compares; larger buckets are dealt into blocks of half as many.
BUCKET = 16_384
#: Members whose distances are in memory at once, squared.
TILE = 2_048


def fingerprint(text: bytes, width: int) -> int:
    """Signed 64-bit SimHash of a lower-cased text: a bit is 1 if it is in over half of the hashes
    of its shingles, repeats included. Fewer words than ``width`` make one shingle, none give 0."""
    words = text.split()
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(len(words) - width + 1, 1)
    last = ends[len(words) - n :]
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, HASHED):
        spans = zip(starts[k : min(k + HASHED, n)].tolist(), last[k : k + HASHED].tolist())
        hashed = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        ones += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp`` of every row; a null text has no words."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.translate(LOWER), width) for t in texts_of(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(signed, schema)


def segments(distance: int) -> list[range]:
    """Bits of each segment: the fewest segments of which one surely differs by at most one bit."""
    count = distance // 2 + 1
    cut = [BITS * k // count for k in range(count + 1)]
    return [range(a, b) for a, b in zip(cut, cut[1:])]


def variants(fp: Column, distance: int) -> Column:
    """One key for each bit: the bits of its segment without that bit, and which bit is left out.

    The key is a hash; keys only propose pairs, so equal hashes of different ones lose nothing."""
    keys = []
    for bits in segments(distance):
        mask = sum(1 << b for b in bits)
        for b in bits:
            kept = mask & ~(1 << b)
            kept -= (kept >> 63) << 64  # as a signed number
            keys.append(F.xxhash64(fp.bitwiseAND(F.lit(kept)), F.lit(b)))
    return F.array(*keys)


def _spread(left: np.ndarray, right: np.ndarray, llabel: np.ndarray, rlabel: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest label that each member reaches over the links between ``left`` and ``right``."""
    # Unsigned, as the bits of signed numbers are counted in their absolute values.
    near = np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= distance
    top = np.iinfo(np.int64).max
    while True:
        new_r = np.minimum(rlabel, np.where(near, llabel[:, None], top).min(axis=0))
        new_l = np.minimum(llabel, np.where(near, new_r[None, :], top).min(axis=1))
        if (new_l == llabel).all() and (new_r == rlabel).all():
            return llabel, rlabel
        llabel, rlabel = new_l, new_r


def bucket_labels(fps: np.ndarray, distance: int) -> np.ndarray:
    """For each member of a bucket the first member that links within the bucket reach, from
    comparing all with all, tile by tile; tiles of one component are not compared again."""
    label = np.arange(len(fps))
    top = label.copy()

    def find(x: int) -> int:
        while top[x] != x:
            x = top[x]
        return x

    for i in range(0, len(fps), TILE):
        for j in range(i, len(fps), TILE):
            one, two = slice(i, i + TILE), slice(j, j + TILE)
            old = np.concatenate([label[one], label[two]])
            if (old == old[0]).all():
                continue
            new = np.concatenate(_spread(fps[one], fps[two], label[one], label[two], distance))
            for a, b in np.unique(np.stack([old, new])[:, old != new], axis=1).T.tolist():
                a, b = find(a), find(b)
                top[max(a, b)] = min(a, b)
            while (top[top] != top).any():
                top = top[top]
            label = top[label]
    return label


def _compared(distance: int):
    """Streams rows (key, one, two, fp) sorted by bucket; yields links (a, b) that join the members
    of each bucket as all its links do, at most one for each member."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), np.int64)

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((np.diff(rows[:3], axis=1) != 0).any(axis=0)) + 1
            starts = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([starts, [rows.shape[1]]]))
            pairs = starts[sizes == 2]
            near = np.bitwise_count((rows[3][pairs] ^ rows[3][pairs + 1]).view(np.uint64)) <= distance
            a, b = [rows[3][pairs[near] + 1]], [rows[3][pairs[near]]]
            for k in np.flatnonzero(sizes > 2):
                fps = rows[3][starts[k] : starts[k] + sizes[k]]
                label = bucket_labels(fps, distance)
                moved = np.flatnonzero(label != np.arange(len(fps)))
                a.append(fps[moved])
                b.append(fps[label[moved]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(k).to_numpy() for k in range(4)])], axis=1)
            if not rows.shape[1]:
                continue
            last = int(np.flatnonzero((rows[:3] != rows[:3, -1:]).any(axis=0)).max(initial=-1)) + 1
            whole, held = rows[:, :last], rows[:, last:]  # the last bucket may go on
            if last:
                yield linked(whole)
        if held.shape[1]:
            yield linked(held)

    return compare


def links(fps: DataFrame, distance: int) -> DataFrame:
    """(node, root): components of the distinct fingerprints (fp) that some link touches.

    The rows of a bucket meet in one task, which compares them where they lie: neither candidates
    nor pairs become rows of a table. A bucket of more than ``BUCKET`` members is dealt into
    blocks, of which every two meet in one task."""
    rows = fps.select("fp", F.explode(variants(F.col("fp"), distance)).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUCKET)
    hot = store(sizes.select("key", F.ceil(2 * F.col("n") / BUCKET).alias("parts")), "hot")
    zero = F.lit(0).cast("long")
    ordinary = rows.join(hot, "key", "left_anti").select("key", zero.alias("one"), zero.alias("two"), "fp")
    dealt = rows.join(hot, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("parts")))
    others = F.filter(F.sequence(zero, F.col("parts") - 1), lambda k: k != F.col("block"))
    dealt = dealt.select("key", "block", "fp", F.explode(others).alias("other"))
    dealt = dealt.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "fp")
    met = ordinary.unionByName(dealt).repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    return components(store(met.mapInArrow(_compared(distance), "a long, b long"), "links"))


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the
    smallest id that links of at most ``distance`` differing bits reach.

    Lower-cases A-Z; shingles are ``width`` words between white space, joined by spaces. Null,
    empty and blank texts have the fingerprint 0 and link like any other. Rows with equal
    fingerprints are linked; a repeated id is one document for each of its fingerprints. Null ids
    are never the smallest: a component of null ids alone has a null id. No rows give no rows.
    """
    with shuffles_removed(docs.sparkSession):
        found = store(fingerprints(docs, width, id_col, text_col), "fingerprints")
        nodes = store(found.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
        roots = links(nodes.select("fp"), distance)
        nodes = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        nodes = store(nodes, "roots")
        smallest = store(nodes.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
        named = store(nodes.join(smallest, "root").select("fp", "component_id"), "named")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.join(named, "fp").select(F.col("id").alias(id_col), shown, "component_id")
