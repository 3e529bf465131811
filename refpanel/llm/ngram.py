"""Interpolated modified Kneser-Ney language model, counted in Spark, stored as sorted arrays.

Words are numbered, and n-grams are arrays of numbers: a task adds up what it has read, deals it to
shards and hands each shard one packed row, so a shuffle moves a few bytes for an n-gram. A shard adds
up its rows and writes contexts with their followers, as numbers too, with values of one byte (larger
ones stand beside them); it hands partial continuation counts to the next lower order. Workers map
the files into memory to score texts, so neither driver nor worker ever loads the model, which grows
with the corpus.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from refpanel.llm.common import LOWER, discard, shared_folder, shuffles_removed, store, texts_of

#: Tokens looked up or scored together.
BLOCK_TOKENS = 500_000
#: Rows added up in a task before they are shuffled.
SUM_ROWS = 4_000_000
#: Tokens for which there is a shard, at least.
SHARD_TOKENS = 4_000_000
#: Cannot be a word: words hold no white space.
END = b"\n"
#: What precedes a text; words are numbered from 1, and one number more stands for all unknown ones.
BEGIN_ID = 0
#: Contexts that share one place of a first follower.
RUN = 256
#: Counts of the n-gram; as a context: total count, followers seen once, twice, more often.
VALUES = ("a", "s", "n1", "n2", "n3")
#: A packed part of the n-grams of a shard.
_PACKED = "shard int, size long, data binary"

def hash_ids(columns: list[np.ndarray]) -> np.ndarray:
    """Spark's ``xxhash64`` of columns of longs (fixed values of that hash)."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = np.full(len(columns[0]), 42, np.uint64)
    for c in columns:
        h = h + p5 + np.uint64(8)
        h ^= turn(c.astype(np.int64).view(np.uint64) * p2, 31) * p1
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def mounted(folder: str) -> str:
    """The folder as a path that workers can map; it has to be mounted on all machines."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"the model needs a mounted shared folder, not {folder}")
    return url.path


def _replace(path: str, data: bytes) -> None:
    """Whole files only: a task may run twice."""
    mark = f"{path}.{uuid.uuid4().hex}"
    with open(mark, "wb") as f:
        f.write(data)
    os.replace(mark, path)


def _put(path: str, values: np.ndarray, kind=np.uint8) -> None:
    """A column of one byte (or ``kind``), and the places and values of those that need more."""
    most = np.iinfo(kind).max
    large = np.flatnonzero(values >= most)
    _replace(path, np.minimum(values, most).astype(kind).tobytes())
    _replace(f"{path}.large", np.concatenate([large, values[large]]).astype(np.int64).tobytes())


def _mapped(path: str, kind) -> np.ndarray:
    return np.asarray(np.memmap(path, kind, "r"))


class Column:
    """What ``_put`` wrote, mapped into memory."""

    def __init__(self, path: str, kind=np.uint8):
        self.small, self.most = _mapped(path, kind), np.iinfo(kind).max
        self.at, self.large = np.fromfile(f"{path}.large", np.int64).reshape(2, -1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        values = self.small[at].astype(np.int64)
        large = np.flatnonzero(values == self.most) if len(self.at) else self.at
        values[large] = self.large[np.searchsorted(self.at, at[large])]
        return values


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Every shard that is asked for, and the places that ask."""
    order = np.argsort(shard.astype(np.uint16) if shards < 65_536 else shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        yield int(k), order[bounds[k] : bounds[k + 1]]


class Words:
    """Sorted hashes of words in files by remainder, with their counts."""

    def __init__(self, folder: str):
        self.folder = folder
        with open(f"{folder}/words.json") as f:
            self.rows = json.load(f)
        self.offsets = np.concatenate([[0], np.cumsum(self.rows)])
        self.maps: dict[int, tuple[np.ndarray, Column]] = {}

    def _map(self, shard: int) -> tuple[np.ndarray, Column]:
        if shard not in self.maps:
            path = f"{self.folder}/words-{shard}"
            self.maps[shard] = _mapped(f"{path}.bin", np.int64), Column(f"{path}.a")
        return self.maps[shard]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (one more than there are words: unknown) and count of each hash."""
        unique, back = np.unique(keys, return_inverse=True)
        number, count = np.full(len(unique), self.offsets[-1] + 1), np.zeros(len(unique), np.int64)
        for k, mine in _by_shard(unique % len(self.rows), len(self.rows)):
            if not self.rows[k]:
                continue
            stored, counts = self._map(k)
            at = np.searchsorted(stored, unique[mine])
            hit = np.flatnonzero(stored[np.minimum(at, len(stored) - 1)] == unique[mine])
            number[mine[hit]] = self.offsets[k] + at[hit] + 1
            count[mine[hit]] = counts[at[hit]]
        return number[back], count[back]


@lru_cache(maxsize=4)
def open_words(folder: str) -> Words:
    return Words(folder)


def _key(ids: list[np.ndarray], bits: int) -> np.ndarray:
    """One number for parallel numbers of ``bits`` bits, exact as long as they fit."""
    if bits * len(ids) > 63:
        return hash_ids(ids)
    key = ids[0]
    for x in ids[1:]:
        key = (key << bits) | x
    return key


def _sorted(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of n-grams by the key of their context and then their word, and which differ from the one before."""
    parts = [_key(ids, bits)] if bits * len(ids) <= 63 else [*([_key(ids[:-1], bits)] if len(ids) > 1 else []), ids[-1]]
    order = np.argsort(parts[0]) if len(parts) == 1 else np.lexsort(parts[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in parts:
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
    return order, new


def _summed(ids: list[np.ndarray], sums: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Equal n-grams added up, in the order of their keys; without ``sums`` they are counted."""
    if not sums and bits * len(ids) <= 63:
        key, counts = np.unique(_key(ids, bits), return_counts=True)
        mask = (1 << bits) - 1
        return [(key >> (bits * k)) & mask for k in range(len(ids) - 1, -1, -1)], [counts]
    order, new = _sorted(ids, bits)
    starts = np.flatnonzero(new)
    at = order[starts]
    sums = [np.add.reduceat(x[order], starts) for x in sums] if sums else [np.diff(np.append(starts, len(order)))]
    return [x[at] for x in ids], sums


def _shard(ids: list[np.ndarray], bits: int, shards: int) -> np.ndarray:
    """Shard of n-grams. Longer ones go by their context, so that it is whole. A few words begin a large part of
    all pairs, so pairs go by both words; what they add to their contexts goes to the shards of single words."""
    if len(ids) == 1:
        return ids[0] % shards
    key = _key(ids if len(ids) == 2 else ids[:-1], bits).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((key >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _packed(ids: list[np.ndarray], sums: list[np.ndarray], bits: int, shards: int) -> Iterator[pa.RecordBatch]:
    """One row for each shard: columns of as few bytes as they need, first bytes first, compressed."""
    codec = pa.Codec("zstd")
    for k, mine in _by_shard(_shard(ids, bits, shards), shards):
        columns = [x[mine] for x in (*ids, *sums)]
        columns[0] = np.diff(columns[0], prepend=0).view(np.uint64)  # mostly ascending
        widths = [max(1, (int(x.max()).bit_length() + 7) // 8) for x in columns]
        planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for x, w in zip(columns, widths)]
        raw = b"".join([np.array([len(mine), len(ids), *widths], "<i8").tobytes(), *planes])
        row = [pa.array([k], pa.int32()), pa.array([len(raw)], pa.int64()), pa.array([codec.compress(raw, asbytes=True)], pa.binary())]
        yield pa.RecordBatch.from_arrays(row, ["shard", "size", "data"])


def _unpacked(data: bytes, size: int, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, size), np.uint8)
    rows, _, *widths = raw[: 8 * (n + 2)].view("<i8").tolist()
    at, columns = 8 * (n + 2), []
    for w in widths:
        wide = np.zeros((rows, 8), np.uint8)
        wide[:, :w] = raw[at : at + rows * w].reshape(w, rows).T
        columns.append(wide.view("<i8")[:, 0])
        at += rows * w
    columns[0] = np.cumsum(columns[0])
    return columns


def _merged(batches: Iterator[pa.RecordBatch], order: int, n: int, bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """All packed rows of a shard added up; ``n`` columns, of which ``order`` are numbers of words."""
    parts = [_unpacked(data, size, n) for b in batches for data, size in zip(b.column("data").to_pylist(), b.column("size").to_pylist())]
    if not parts:
        return [np.empty(0, np.int64)] * order, [np.empty(0, np.int64)] * (n - order)
    columns = [np.concatenate(x) for x in zip(*parts)]
    del parts
    return _summed(columns[:order], columns[order:], bits)


def _note(path: str, a: np.ndarray) -> None:
    """How many n-grams of the shard are seen once to five times or more."""
    _replace(f"{path}.json", json.dumps(np.bincount(np.minimum(a, 5), minlength=6)[1:6].tolist()).encode())


def _grams(packed: DataFrame, folder: str, order: int, bits: int, shards: int) -> DataFrame:
    """Writes n-grams of two words or more, shard by shard; returns what they add to the next lower order."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/order{order}-{TaskContext.get().partitionId()}"
        ids, (c,) = _merged(batches, order, order + 1, bits)
        if not len(c):
            return
        _note(path, c)
        key = _key(ids[:-1], bits)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts, len(c))  # where each context's followers start, and the last ones end
        _replace(f"{path}.context", key[starts].astype(np.int64 if order > 2 else np.uint32).tobytes())
        _replace(f"{path}.run", ends[::RUN].tobytes())
        _put(f"{path}.start", ends - np.repeat(ends[::RUN], RUN)[: len(ends)], np.uint16)
        _replace(f"{path}.word", ids[-1].astype(np.uint32).tobytes())
        _put(f"{path}.a", c)
        sums = [np.add.reduceat(x, starts) for x in (c, *((c == n).astype(np.int64) for n in (1, 2)))]
        sums.append(np.diff(ends) - sums[1] - sums[2])
        if order > 2:
            for name, x in zip(VALUES[1:], sums[:-1]):
                _put(f"{path}.{name}", x)
        # Without the first word: one more continuation, or the count itself after the start.
        first = np.where(ids[1] == BEGIN_ID, c, 1) if order > 2 else np.ones(len(c), np.int64)
        contexts = ids[0][starts]
        below, a = _summed(ids[1:], [first], bits)
        del ids, c, first
        if order > 2:
            yield from _packed(below, a, bits, shards)
            return
        none = lambda n: np.zeros(n, np.int64)
        rows = [np.concatenate(x) for x in ((a[0], none(len(contexts))), *((none(len(a[0])), x) for x in sums))]
        yield from _packed(*_summed([np.concatenate([below[0], contexts])], rows, bits), bits, shards)

    return packed.repartitionById(shards, F.col("shard")).mapInArrow(write, _PACKED)


def _singles(packed: DataFrame, folder: str, order: int, bits: int, shards: int) -> DataFrame:
    """Writes the values of single words by number, shard by shard; returns the sums of their counts."""
    names = VALUES if order > 1 else VALUES[:1]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/order1-{TaskContext.get().partitionId()}"
        (ids,), sums = _merged(batches, 1, 1 + len(names), bits)
        if not len(ids):
            return
        _note(path, sums[0])
        for name, x in zip(names, sums):
            dense = np.zeros(ids[-1] // shards + 1, np.int64)
            dense[ids // shards] = x
            _put(f"{path}.{name}", dense)
        a = sums[0]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (a.sum(), (a == 1).sum(), (a == 2).sum(), (a > 2).sum())], ["total", "n1", "n2", "n3"])

    return packed.repartitionById(shards, F.col("shard")).mapInArrow(write, "total long, n1 long, n2 long, n3 long")


def _counts(folder: str, order: int, shards: int) -> np.ndarray:
    """Counts of counts of an order. Spark runs no task for a shard without rows."""
    counts = np.zeros(5, np.int64)
    for k in range(shards):
        if os.path.exists(path := f"{folder}/order{order}-{k}.json"):
            with open(path) as f:
                counts += json.load(f)
    return counts


class Grams:
    """The files of one order."""

    def __init__(self, folder: str, order: int, top: int, bits: int, shards: int):
        self.path, self.order, self.bits, self.shards = f"{folder}/order{order}", order, bits, shards
        self.names = VALUES if order == 1 and top > 1 else ("a", "s", "n1", "n2") if order > 2 else ("a",)
        self.maps: dict[int, dict | None] = {}

    def _map(self, shard: int) -> dict | None:
        if shard not in self.maps:
            path = f"{self.path}-{shard}"
            held = {n: Column(f"{path}.{n}") for n in self.names} if os.path.exists(f"{path}.json") else None
            if held and self.order > 1:
                held |= {n: _mapped(f"{path}.{n}", t) for n, t in (("context", np.int64 if self.order > 2 else np.uint32), ("run", np.int64), ("word", np.uint32))}
                held["start"] = Column(f"{path}.start", np.uint16)
            self.maps[shard] = held
        return self.maps[shard]

    def find(self, ids: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Count of each n-gram and, of three words or more, the values of its context, of a single word its
        values as a context (0: absent)."""
        order, new = _sorted(ids, self.bits)
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        ids = [x[order[new]] for x in ids]
        out = {n: np.zeros(len(ids[0]), np.int64) for n in (VALUES if len(self.names) > 1 else VALUES[:1])}
        key = _key(ids[:-1], self.bits) if self.order > 1 else ids[0] // self.shards
        for k, mine in _by_shard(_shard(ids, self.bits, self.shards), self.shards):
            held = self._map(k)
            if held is None:
                continue
            if self.order == 1:
                mine = mine[key[mine] < len(held["a"].small)]
                for n in self.names:
                    out[n][mine] = held[n][key[mine]]
                continue
            asked = key[mine].astype(held["context"].dtype)
            at = np.searchsorted(held["context"], asked)
            hit = np.flatnonzero(held["context"][np.minimum(at, len(held["context"]) - 1)] == asked)
            mine, at = mine[hit], at[hit]
            low, high = (held["run"][x // RUN] + held["start"][x] for x in (at, at + 1))
            if self.order > 2:
                for n in self.names[1:]:
                    out[n][mine] = held[n][at]
                out["n3"][mine] = high - low - out["n1"][mine] - out["n2"][mine]
            word, place, last = ids[-1][mine].astype(np.uint32), low, high - 1
            for step in (1 << k for k in range(int((last - low).max(initial=0)).bit_length() - 1, -1, -1)):
                some = np.flatnonzero(last - place >= step)
                further = place[some] + step  # up to the last follower that is not after the word
                fits = held["word"][further] <= word[some]
                place[some[fits]] = further[fits]
            hit = np.flatnonzero(held["word"][place] == word)
            out["a"][mine[hit]] = held["a"][place[hit]]
        return {n: x[back] for n, x in out.items()}


@lru_cache(maxsize=16)
def open_grams(folder: str, order: int, top: int, bits: int, shards: int) -> Grams:
    return Grams(folder, order, top, bits, shards)


def discounts(counts: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen once to four times."""
    n1, n2, n3, n4 = (float(x) for x in counts[:4])
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.05), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    order: int
    tokens: int
    types: int
    discount: tuple[tuple[float, float, float], ...]  # by order, from 1
    unigram_total: int
    unigram_free: float
    bits: int
    shards: int


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[list[int], list[bytes], int]]:
    """Numbers of tokens of texts and their tokens, END after each text, in bounded blocks."""
    sizes, tokens = [], []
    for batch in batches:
        for text in texts_of(batch, column):
            words = text.translate(LOWER).split()
            words.append(END)
            sizes.append(len(words))
            tokens += words
            if len(tokens) >= BLOCK_TOKENS:
                yield sizes, tokens
                sizes, tokens = [], []
    if sizes:
        yield sizes, tokens


def _gathered(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
    """Blocks of parallel arrays joined up to ``SUM_ROWS``."""
    kept: list[tuple[np.ndarray, ...]] = []
    for block in blocks:
        kept.append(block)
        if sum(len(x[0]) for x in kept) > SUM_ROWS:
            yield [np.concatenate(x) for x in zip(*kept)]
            kept = []
    if kept:
        yield [np.concatenate(x) for x in zip(*kept)]


def _padded(ids: np.ndarray, sizes: list[int], order: int) -> np.ndarray:
    """Rows of ``order`` ids, the last one the token, the first ones what precedes it in its text."""
    n, pad = np.array(sizes), order - 1
    long = np.full(len(ids) + pad * len(n), BEGIN_ID, np.int64)
    at = np.arange(len(ids)) + pad * (np.repeat(np.arange(len(n)), n) + 1)
    long[at] = ids
    return np.stack([long[at - pad + k] for k in range(order)])


def train(docs: DataFrame, text_col: str = "text", order: int = 2, folder: str | None = None) -> Model:
    """Counts ``docs`` and writes the model below ``folder`` (by default in the shared folder).

    Lower-cases A-Z; tokens are the words between white space and one end for each text. Null
    texts count as empty. No rows give a model that knows nothing.
    """
    with shuffles_removed(docs.sparkSession):
        return _train(docs, text_col, order, folder)


def _train(docs: DataFrame, text_col: str, order: int, folder: str | None) -> Model:
    spark = docs.sparkSession
    folder = mounted(folder or shared_folder(spark, "ngram"))
    os.makedirs(folder, exist_ok=True)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))
    types, tokens = _number(texts, folder, shards)
    shards, bits = max(shards, -(-tokens // SHARD_TOKENS)), (types + 1).bit_length()
    if types + 1 >= 1 << 32:
        raise ValueError("more words than numbers of four bytes")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = open_words(folder)

        def read():
            for sizes, tokens in _blocks(batches, "_text"):
                distinct, at = _distinct(tokens)
                yield tuple(_padded(known.find(_hashes(distinct))[0][at], sizes, order))

        for rows in _gathered(read()):
            yield from _packed(*_summed(rows, [], bits), bits, shards)

    rows = texts.mapInArrow(grams, _PACKED)
    for k in range(order, 1, -1):
        before, rows = rows, store(_grams(rows, folder, k, bits, shards), "counts")
        if k < order:
            discard(before)
    sums = _singles(rows, folder, order, bits, shards)
    total, n1, n2, n3 = (x or 0 for x in sums.agg(*(F.sum(c) for c in sums.columns)).first())
    if order > 1:
        discard(rows)
    discount = tuple(discounts(_counts(folder, k, shards)) for k in range(1, order + 1))
    d = discount[0]
    free = (d[0] * n1 + d[1] * n2 + d[2] * n3) / total if total else 1.0
    return Model(folder, order, tokens, types, discount, total, free, bits, shards)


def _distinct(tokens: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different tokens, and for each token which of them it is."""
    distinct = list(set(tokens))
    place = dict(zip(distinct, range(len(distinct))))
    return distinct, np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))


def _hashes(words: Collection[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _added(w: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal words added up, by word."""
    order = np.argsort(w)
    w, a = w[order], a[order]
    starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    return w[starts], np.add.reduceat(a, starts)


def _number(texts: DataFrame, folder: str, shards: int) -> tuple[int, int]:
    """Writes hashes and counts of words, shard by shard; returns the numbers of words and of tokens."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = (Counter(tokens) for _, tokens in _blocks(batches, "_text"))
        for w, a in _gathered((_hashes(c.keys()), np.fromiter(c.values(), np.int64, len(c))) for c in counted):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _added(w, a)], ["w", "a"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        parts = [[b.column(c).to_numpy() for c in ("w", "a")] for b in batches if b.num_rows]
        if not parts:
            return
        w, a = _added(*(np.concatenate(x) for x in zip(*parts)))
        _replace(f"{folder}/words-{shard}.bin", w.tobytes())
        _put(f"{folder}/words-{shard}.a", a)
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (shard, len(w), a.sum())], ["shard", "types", "tokens"])

    rows = texts.mapInArrow(words, "w long, a long").repartitionById(shards, F.pmod("w", F.lit(shards)).cast("int"))
    found = rows.mapInArrow(write, "shard long, types long, tokens long").collect()  # a row for each shard
    types = [0] * shards
    for r in found:
        types[r.shard] = r.types
    _replace(f"{folder}/words.json", json.dumps(types).encode())
    return sum(types), sum(r.tokens for r in found)


def probabilities(model: Model, rows: np.ndarray) -> np.ndarray:
    """Probability of the last number of each column of ``rows`` after the numbers before it; columns
    go through whole texts, token by token."""
    take = lambda a, d: np.maximum(a - np.select([a == 0, a == 1, a == 2], [0.0, d[0], d[1]], d[2]), 0.0)
    opened = lambda k: open_grams(model.folder, k, model.order, model.bits, model.shards)
    p = np.full(rows.shape[1], model.unigram_free / (model.types + 1))
    for k in range(1, model.order + 1):
        found = opened(k).find(list(rows[model.order - k :]))
        a, d = found["a"], model.discount[k - 1]
        if k == 1:
            p = p + take(a, d) / max(model.unigram_total, 1)
            single = found
            continue
        context = found
        if k == 2:  # the token before, or the start of the text
            first, begin = rows[-2] == BEGIN_ID, opened(1).find([np.array([BEGIN_ID])])
            context = {n: np.where(first, begin[n], np.roll(x, 1)) for n, x in single.items()}
        s = np.maximum(context["s"], 1)
        free = (d[0] * context["n1"] + d[1] * context["n2"] + d[2] * context["n3"]) / s
        p = np.where(context["s"] > 0, take(a, d) / s + free * p, p)
    return p


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_tokens, n_known, base_score, score`` of every row: the tokens, those seen in training,
    the log10 probability under add-one counts and under the model.

    Null texts count as empty: one token, the end. Rows stay as they are.
    """
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text"))
    names = ["n_tokens", "n_known", "base_score", "score"]
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL("n_tokens long, n_known long, base_score double, score double").fields])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = open_words(model.folder)
        keys: list[pa.Array] = []

        def noted():
            for batch in batches:
                for k in range(0, batch.num_rows, 512):
                    keys.append(batch.column(0).slice(k, 512))
                    yield batch.slice(k, 512)

        done = pa.array([], schema_type)
        for sizes, tokens in _blocks(noted(), "_text"):
            distinct, at = _distinct(tokens)
            ids, count = (x[at] for x in known.find(_hashes(distinct)))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            add = lambda x: pa.array(np.add.reduceat(x, starts))  # noqa: E731, B023
            base = np.log10((count + 1) / (model.tokens + model.types + 1))
            p = np.log10(probabilities(model, _padded(ids, sizes, model.order)))
            waiting = pa.concat_arrays([done, *keys])
            keys.clear()
            done = waiting.slice(len(sizes))
            yield pa.RecordBatch.from_arrays([waiting.slice(0, len(sizes)), pa.array(sizes, pa.int64()), add((count > 0).astype(np.int64)), add(base), add(p)], [id_col, *names])

    from pyspark.sql.pandas.types import to_arrow_type

    schema_type = to_arrow_type(docs.schema[id_col].dataType)
    return rows.mapInArrow(scored, schema)
