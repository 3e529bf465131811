"""Benchmark decontamination over a distributed positional inverted index.

The index is document-partitioned: each segment holds the postings (term, positions) of some
hundred thousand words of whole documents, built where the documents are read, so no posting is
ever shuffled and no word, however frequent, meets in one task. Test windows are searched in
blocks of bounded size; each segment intersects offset-adjusted posting lists, rarest term first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import ALNUM, hash_cache, store, texts_of

#: Words of documents in a segment (a longer document has a segment of its own).
SEGMENT_WORDS = 400_000
#: Words of test items sent to the tasks at a time.
BLOCK_WORDS = 1_000_000
#: Candidate positions tested together.
CHUNK = 1_000_000


def words(text: bytes) -> list[bytes]:
    """Lower-case A-Z; runs of digits, letters and non-ASCII characters."""
    return text.translate(ALNUM).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional index of all words of all rows, stored in the shared folder.

    One row per segment: ``segment``, per document ``ids``, ``starts`` and ``n_words``, and the
    postings as little-endian arrays: ``terms`` (sorted 64-bit hashes), ``offsets`` into
    ``positions`` and ``positions`` (stored as differences). Null or empty texts are documents
    without words; repeated rows and ids stay separate documents; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("starts", T.BinaryType()),
            T.StructField("n_words", T.ArrayType(T.LongType())),
            T.StructField("terms", T.BinaryType()),
            T.StructField("offsets", T.BinaryType()),
            T.StructField("positions", T.BinaryType()),
        ]
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, number = hash_cache(), TaskContext.get().partitionId() << 32
        ids, hashes, total = [], [], 0

        def emit():
            sizes = np.array([len(h) for h in hashes], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)  # a gap after each document
            found = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            at = np.arange(len(found)) + np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(found, kind="stable")
            terms, first = np.unique(found[order], return_index=True)
            positions = np.diff(at[order].astype(np.int32), prepend=np.int32(0))
            offsets = np.append(first, len(found)).astype(np.int32)
            row = [[number], [ids], [starts.tobytes()], [sizes.tolist()], [terms.tobytes()], [offsets.tobytes()], [positions.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, arrow)], schema.names)

        for batch in batches:
            arrow = [pa.int64(), pa.list_(batch.schema.field(0).type), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch, "_text")):
                found = words(text)
                if ids and total + len(found) > SEGMENT_WORDS:
                    yield emit()
                    ids, hashes, total, number = [], [], 0, number + 1
                    cache.trim()
                ids.append(key)
                hashes.append(np.fromiter(map(cache.__getitem__, found), np.uint64, len(found)))
                total += len(found)
        if ids:
            yield emit()

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return store(rows.mapInArrow(segments, schema), "index")


class Windows:
    """Windows of one block of test items as term numbers, grouped by length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        cache, rows = hash_cache(), {}
        self.items = sorted({i for i, _ in items})
        number = {item: k for k, item in enumerate(self.items)}
        for item, text in items:
            found = words(text)
            hashes = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
            if len(found):
                length = min(size, len(found))
                view = np.lib.stride_tricks.sliding_window_view(hashes, length)
                rows.setdefault(length, []).append((view, np.full(len(view), number[item])))
        self.terms = np.unique(np.concatenate([v.ravel() for g in rows.values() for v, _ in g])) if rows else np.empty(0, np.uint64)
        self.groups = []
        for group in rows.values():
            grams = np.searchsorted(self.terms, np.concatenate([v for v, _ in group]))
            self.groups.append((grams, np.concatenate([n for _, n in group])))


def _search(terms, offsets, positions, block: Windows, slop: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(item number, first position, last position, exact) of all matches in one segment.

    A match holds the window's words in order with at most ``slop`` further words between them;
    with ``slop`` 0 it is the exact phrase.
    """
    if not len(terms) or not len(block.terms):
        return
    local = np.minimum(np.searchsorted(terms, block.terms), len(terms) - 1)
    counts = np.where(terms[local] == block.terms, np.diff(offsets)[local], 0)
    keys = (np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(offsets)) << 32) | positions  # sorted
    for grams, item in block.groups:
        sizes = counts[grams]
        alive = np.flatnonzero(sizes.min(axis=1) > 0)
        if not len(alive):
            continue
        sizes, length = sizes[alive], grams.shape[1]
        order = np.argsort(sizes, axis=1, kind="stable")
        rarest = sizes.min(axis=1)
        cuts = np.flatnonzero(np.diff(np.cumsum(rarest) // CHUNK, prepend=0))
        for part in np.split(np.arange(len(alive)), cuts):
            if not len(part):
                continue
            gram, n, by = local[grams[alive[part]]], rarest[part], order[part]
            w = np.repeat(np.arange(len(part)), n)
            nth = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
            anchor = by[:, 0]
            at = positions[offsets[gram[np.arange(len(part)), anchor]][w] + nth].astype(np.int64)
            start = at - anchor[w]
            for step in range(1, length):  # offset-adjusted intersection, next rarest term each time
                j = by[w, step]
                base = gram[w, j].astype(np.int64) << 32
                low = np.maximum(start + j - slop, 0)
                nxt = np.searchsorted(keys, base + low)
                ok = (nxt < len(keys)) & (keys[np.minimum(nxt, len(keys) - 1)] <= base + np.maximum(start + j + slop, -1))
                w, start, at = w[ok], start[ok], at[ok]
                if not len(w):
                    break
            first, last, ok = at.copy(), at.copy(), np.ones(len(w), bool)
            if slop and len(w):
                for step in range(1, length):  # nearest in-order chain around the rarest word
                    j = anchor[w] + step
                    on = ok & (j < length)
                    base = gram[w, np.minimum(j, length - 1)].astype(np.int64) << 32
                    nxt = np.searchsorted(keys, base + last + 1)
                    value = keys[np.minimum(nxt, len(keys) - 1)]
                    good = (nxt < len(keys)) & (value >> 32 == base >> 32)
                    last = np.where(on & good, value & 0xFFFFFFFF, last)
                    ok &= ~on | good
                    j = anchor[w] - step
                    on = ok & (j >= 0)
                    base = gram[w, np.maximum(j, 0)].astype(np.int64) << 32
                    prev = np.searchsorted(keys, base + first) - 1
                    value = keys[np.maximum(prev, 0)]
                    good = (prev >= 0) & (value >> 32 == base >> 32)
                    first = np.where(on & good, value & 0xFFFFFFFF, first)
                    ok &= ~on | good
                ok &= last - first < length + slop
            else:
                first, last = start, start + length - 1
            yield item[alive[part]][w[ok]], first[ok], last[ok], last[ok] - first[ok] + 1 == length


def find(index: DataFrame, items: DataFrame, size: int = 13, slop: int = 0, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents in which a window of a test item occurs.

    A window is ``size`` consecutive words of an item, an item of fewer (but not no) words is one
    window. Returns ``segment, doc`` (number in the segment), ``spans`` (array of first and last
    word, exact matches only), ``items`` (with exact matches) and ``near_items`` (with matches of
    at most ``slop`` additional words that are not exact), item ids as strings, a null id as an
    empty string. Items go to the tasks in blocks of about ``block_words`` words, all of them.
    """
    text = F.col(text_col).cast("string")
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(text, F.lit("")).alias("text"))
    total = rows.select(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\u0080-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = -(-total // block_words)
    schema = "segment long, doc int, spans array<struct<first: long, last: long>>, items array<string>, near_items array<string>"
    found = None
    for number in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        block = index.sparkSession.sparkContext.broadcast(Windows([(r.item, r.text.encode()) for r in mine.collect()], size))

        def matches(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    starts = np.frombuffer(r["starts"], np.int64)
                    positions = np.cumsum(np.frombuffer(r["positions"], np.int32), dtype=np.int64)
                    arrays = np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["offsets"], np.int32), positions
                    got = list(_search(*arrays, block.value, slop))
                    if not got:
                        continue
                    item, first, last, exact = map(np.concatenate, zip(*got))
                    doc = np.searchsorted(starts, first, side="right") - 1
                    inside = np.flatnonzero(last < starts[doc + 1])
                    inside = inside[np.argsort(doc[inside], kind="stable")]
                    for on in np.split(inside, np.flatnonzero(np.diff(doc[inside])) + 1) if len(inside) else []:
                        d, full = doc[on[0]], on[exact[on]]
                        hit = set(item[full].tolist())
                        near = set(item[on].tolist()) - hit
                        spans = sorted(set(zip((first[full] - starts[d]).tolist(), (last[full] - starts[d]).tolist())))
                        names = block.value.items
                        out.append((r["segment"], int(d), [{"first": x, "last": y} for x, y in spans], [names[i] for i in sorted(hit)], [names[i] for i in sorted(near)]))
                arrow = [pa.int64(), pa.int32(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string()), pa.list_(pa.string())]
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, arrow)], ["segment", "doc", "spans", "items", "near_items"])

        part = index.select("segment", "starts", "terms", "offsets", "positions").mapInArrow(matches, schema)
        found = part if found is None else found.unionByName(part)
    return index.sparkSession.createDataFrame([], schema) if found is None else found


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, slop: int = 2, percent: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``n_items``, ``items`` (ids with occurring windows, sorted as strings), ``near_items`` (found
    only with up to ``slop`` words in between) and ``contaminated`` (at least ``percent`` % hit).

    A null text has no words; repeated rows are judged one by one; without items nothing is hit.
    """
    index = build_index(docs, id_col, text_col)
    found = find(index, items, size, slop, item_col, item_text_col, block_words)
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, acc["end"]))).alias("n"), F.greatest(acc["end"], s["last"]).alias("end")),
        lambda acc: acc["n"],
    )
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    hits = found.groupBy("segment", "doc").agg(spans.alias("spans"), union("items").alias("items"), union("near_items").alias("near"))
    hits = hits.select("segment", "doc", covered.alias("n_hit"), "items", F.array_except("near", "items").alias("near"))
    each = index.select("segment", F.posexplode(F.arrays_zip("ids", "n_words")).alias("doc", "d"))
    each = each.select("segment", "doc", F.col("d.ids").alias(id_col), F.col("d.n_words").alias("n_words"))
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return each.join(hits, ["segment", "doc"], "left").select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("near", none).alias("near_items"),
        ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
    )
