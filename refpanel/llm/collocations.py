"""Phrase collocations from a weighted de Bruijn graph.

Only the longest grams are counted in the corpus: they are the weighted edges between overlapping
nodes of one word less. Chains of edges without branching are compacted to paths. The counts of all
shorter phrases follow from the flow out of the nodes, corrected by the grams that pieces end with.
Words and word pairs below the least count can be in no phrase that reaches it, so pieces are cut
there before edges are formed, which changes no count that matters.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refpanel.llm.common import Cache, shared_folder, shuffles_removed, store
from refpanel.llm.ngram import mounted

#: Words of the longest phrase: the edges of the graph.
ORDER = 5
WORDS = [f"w{k}" for k in range(1, ORDER + 1)]
#: Ends a piece; cannot be a word.
BREAK = b"\n"
#: What separates pieces, and a tab that separates words as a space does.
_FOLDED = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Grams or words counted in a task before they are handed on, and words' bytes.
HELD = 1_000_000
HELD_BYTES = 128 << 20
#: Rows handed to Spark at once, and words whose keys a worker keeps.
BATCH_ROWS = 65_536
KEPT = 250_000
#: Word numbers of a stored row, and of a block worked on at once, about.
ROW_IDS = 32_768
BLOCK_IDS = 250_000
#: Files of a lookup table.
FILES = 64
#: Parts that the first rows of a language are chosen in, before they meet.
PARTS = 64


def tokens(text: bytes) -> list[bytes]:
    """Words of a text with ``BREAK`` after every piece."""
    return [w for w in text.translate(_FOLDED).replace(b"\n", b" \n ").split(b" ") if w] + [BREAK]


class KeySet:
    """Sorted 64-bit keys in files that workers map into memory; a key has its position, from 1."""

    def __init__(self, folder: str, sizes: tuple[int, ...]):
        self.folder, self.sizes = folder, sizes
        self.before = np.concatenate([[0], np.cumsum(sizes)])
        self.maps: dict[int, np.ndarray] = {}

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key over all files, 0 where it is absent."""
        unique, back = np.unique(keys, return_inverse=True)
        part = unique % len(self.sizes)
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(len(self.sizes) + 1))
        at = np.zeros(len(unique), np.int64)
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            if not self.sizes[k]:
                continue
            if k not in self.maps:
                self.maps[k] = np.memmap(f"{self.folder}/{k}.bin", np.int64, "r", shape=(self.sizes[k],))
            mine = order[bounds[k] : bounds[k + 1]]
            pos = np.minimum(np.searchsorted(self.maps[k], unique[mine]), self.sizes[k] - 1)
            at[mine] = np.where(self.maps[k][pos] == unique[mine], self.before[k] + pos + 1, 0)
        return at[back]


@lru_cache(maxsize=4)
def key_set(folder: str, sizes: tuple[int, ...]) -> KeySet:
    return KeySet(folder, sizes)


def write_keys(keys: DataFrame) -> tuple[str, tuple[int, ...]]:
    """Writes the distinct longs of column ``key`` as a ``KeySet`` in the shared folder; a file is
    renamed when it is whole, so a task may run twice."""
    folder = mounted(shared_folder(keys.sparkSession, "keys"))
    os.makedirs(folder, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mark, n = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        with open(f"{folder}/{part}.bin.{mark}", "wb") as f:
            for batch in batches:
                n += batch.num_rows
                f.write(batch.column(0).to_numpy().tobytes())
        os.replace(f.name, f"{folder}/{part}.bin")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64())], ["part", "n"])

    dealt = keys.select("key").repartitionById(FILES, F.pmod("key", F.lit(FILES)).cast("int")).sortWithinPartitions("key")
    sizes = {r.part: r.n for r in dealt.mapInArrow(write, "part int, n long").collect()}  # one row for each file
    return folder, tuple(sizes.get(k, 0) for k in range(FILES))


def _languages(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Language and text of rows (lang, text)."""
    return zip(batch.column(0).to_pylist(), (v.as_py() or b"" for v in batch.column(1).cast(pa.large_binary())))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, f`` of rows (lang, text), added up by task before they are shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, mine in counts.items():
                mine.pop(BREAK, None)
                while mine:  # taken out as they are handed on
                    words, n = zip(*(mine.popitem() for _ in range(min(len(mine), BATCH_ROWS))))
                    columns = [pa.array([lang] * len(n), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "f"])
            counts.clear()

        for batch in batches:
            for lang, text in _languages(batch):
                counts.setdefault(lang, Counter()).update(tokens(text))
                size += len(text)
                if size > HELD_BYTES or sum(map(len, counts.values())) > HELD:
                    yield from out()
                    size = 0
        yield from out()

    each = docs.mapInArrow(counted, "lang string, word string, f long")
    return each.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _keys_of(lang: str, seed: int) -> Cache:
    """Keys of the words of a language: signed 64-bit hashes of both."""
    start = xxhash.xxh64(lang.encode() + b"\n", seed)

    def key(word: bytes) -> int:
        h = start.copy()
        h.update(word)
        return h.intdigest() - 2**63

    return Cache(key)


def _keys(words: DataFrame, seed: int) -> DataFrame:
    """``words`` with ``key``, a hash of language and word."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            caches = Cache(lambda lang: _keys_of(lang, seed))
            keys = [caches[g].fn(w.encode()) for g, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "key"])

    return words.mapInArrow(keyed, "lang string, word string, f long, key long")


def _parts(ids: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """``ids`` in parts of at least ``length`` that end with a 0."""
    ends = np.flatnonzero(ids == 0) + 1
    at = 0
    while at < len(ids):
        k = np.searchsorted(ends, at + length)
        end = int(ends[k]) if k < len(ends) else len(ids)
        yield ids[at:end]
        at = end


def _sequences(docs: DataFrame, known: tuple[str, tuple[int, ...]], seed: int) -> DataFrame:
    """``ids``: word numbers of each text, 0 at the end of a piece and for rare words."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, caches = key_set(*known), Cache(lambda lang: _keys_of(lang, seed))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                keys = []
                for lang, text in _languages(batch.slice(k, 256)):
                    words = tokens(text)  # a break has no number either
                    keys.append(np.fromiter(map(caches[lang].__getitem__, words), np.int64, len(words)))
                if sum(map(len, caches.values())) > KEPT:
                    caches.clear()
                found = np.split(table.find(np.concatenate(keys)), np.cumsum([len(x) for x in keys])[:-1])
                found = [ids[(ids != 0) | np.concatenate([[True], ids[:-1] != 0])] for ids in found]  # one 0 between fragments
                rows = [part.astype(np.int32) for ids in found for part in _parts(ids, ROW_IDS)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["ids"])

    return docs.mapInArrow(numbered, "ids array<int>")


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Word numbers of many texts in a row; every text ends with a 0."""
    for batch in batches:
        for ids in _parts(batch.column(0).flatten().to_numpy(), BLOCK_IDS):
            yield np.concatenate([ids.astype(np.int64), np.zeros(ORDER, np.int64)])


def _added(columns: list[np.ndarray], counts: np.ndarray) -> list[np.ndarray]:
    """Equal rows added up."""
    order = np.lexsort(columns[::-1])
    change = np.zeros(len(order), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= np.diff(c[order]) != 0
    starts = np.flatnonzero(change)
    return [*(c[order][starts] for c in columns), np.add.reduceat(counts[order], starts)] if len(starts) else [*columns, counts]


def _summed(rows_of, names: list[str]):
    """A task that adds up the rows of its blocks, ``HELD`` at a time, and hands them on in short
    batches, since both sides of a worker's pipe hold a batch whole."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def merged() -> list[np.ndarray]:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            return _added(columns[:-1], columns[-1])

        def out() -> Iterator[pa.RecordBatch]:
            columns = held.pop()
            for k in range(0, len(columns[0]), BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + BATCH_ROWS].astype(np.int64)) for c in columns], names)

        for ids in _flat(batches):
            rows = rows_of(ids)
            held.append([*rows, np.ones(len(rows[0]), np.int64)])
            if 2 * sum(len(h[0]) for h in held) > 3 * HELD:
                held.append(merged())
                if len(held[0][0]) > HELD:
                    yield from out()
        if held:
            held.append(merged())
            yield from out()

    return task


def _pairs(sequences: DataFrame) -> DataFrame:
    """``key, f``: every two neighbouring words as one number."""

    def rows(ids: np.ndarray) -> list[np.ndarray]:
        both = (ids[:-1] != 0) & (ids[1:] != 0)
        return [(ids[:-1][both] << 32) | ids[1:][both]]

    each = sequences.mapInArrow(_summed(rows, ["key", "f"]), "key long, f long")
    return each.groupBy("key").agg(F.sum("f").alias("f"))


def edges(sequences: DataFrame, frequent: tuple[str, tuple[int, ...]]) -> DataFrame:
    """``w1 .. w5, f``: the longest grams with their counts; where a piece ends earlier, what is
    left of it, filled with 0. Pieces are cut where two words are no frequent pair."""

    def rows(ids: np.ndarray) -> list[np.ndarray]:
        table = key_set(*frequent)
        goes_on = (ids[:-1] != 0) & (ids[1:] != 0)
        goes_on[goes_on] = table.find((ids[:-1][goes_on] << 32) | ids[1:][goes_on]) > 0
        first = np.flatnonzero(ids)
        out, alive = [ids[first]], np.ones(len(first), bool)
        for k in range(1, ORDER):
            alive = alive & goes_on[np.minimum(first + k - 1, len(goes_on) - 1)]
            out.append(np.where(alive, ids[np.minimum(first + k, len(ids) - 1)], 0))
        return [c.astype(np.int32) for c in out]  # word numbers fit 31 bits

    each = sequences.mapInArrow(_summed(rows, [*WORDS, "f"]), ", ".join(f"{c} long" for c in [*WORDS, "f"]))
    return each.groupBy(*WORDS).agg(F.sum("f").alias("f"))


def _filled(k: int) -> list[Column]:
    """The first ``k`` words, then zeros."""
    return [F.col(w) if j < k else F.lit(0).cast("long").alias(w) for j, w in enumerate(WORDS)]


def paths(graph: DataFrame, least: int) -> DataFrame:
    """``words, f``: the edges with their unbranched chains of frequent edges compacted.

    A node is passed through if one edge brings all its occurrences and one takes all of them away;
    the edges on its two sides then have the same count. Chains are numbered by pointers that double
    their reach every round; they cannot close to a ring, because every piece has a beginning.
    """
    full = F.col(WORDS[-1]) != 0
    node = [F.col(w).alias(w) for w in WORDS[:-1]]
    flow = graph.filter(F.col(WORDS[-2]) != 0).groupBy(*node).agg(F.sum("f").alias("flow")).filter(F.col("flow") >= least)
    heavy = store(graph.filter(full & (F.col("f") >= least)).withColumn("id", F.monotonically_increasing_id()), "heavy")
    flow = store(flow, "flow")
    out = heavy.join(flow, WORDS[:-1]).filter("f = flow").select(*node, F.col("id").alias("next"), F.col("f").alias("nf"))
    into = heavy.select(*(F.col(w).alias(v) for v, w in zip(WORDS, WORDS[1:])), "id", "f")
    links = into.join(out, WORDS[:-1]).filter("f = nf").select(F.col("next").alias("id"), F.col("id").alias("prev"))
    at = heavy.join(links, "id", "left").select("id", F.coalesce("prev", "id").alias("head"), F.col("prev").isNotNull().cast("long").alias("pos"))
    at = store(at, "chains")
    while True:
        up = at.select(F.col("id").alias("head"), F.col("head").alias("top"), F.col("pos").alias("more"))
        jumped = store(at.join(up, "head").select("id", F.col("top").alias("head"), (F.col("pos") + F.col("more")).alias("pos"), (F.col("more") > 0).alias("moved")), "chains")
        at = jumped.select("id", "head", "pos")
        if jumped.filter("moved").isEmpty():
            break
    chained = heavy.join(at, "id")
    last = F.array_sort(F.collect_list(F.struct("pos", WORDS[-1])))  # a chain is at most one piece long
    start = F.min(F.struct("pos", F.array(*WORDS[:-1]).alias("w")))["w"]
    chains = chained.groupBy("head").agg(start.alias("s"), last.alias("l"), F.first("f").alias("f"))
    chains = chains.select(F.concat("s", F.transform("l", lambda x: x[WORDS[-1]])).alias("words"), "f")
    rest = graph.filter(~(full & (F.col("f") >= least))).select(F.array(*WORDS).alias("words"), "f")
    return chains.unionByName(rest)


def phrase_counts(compact: DataFrame, least: int) -> DataFrame:
    """``w1 .. w5, k, f``: all phrases of ``k`` words with a count of ``least`` or more.

    Edges of the compacted graph are windows of its paths. A shorter phrase is met as often as flow
    leaves the node it names, plus as often as a piece ends with it, which is what the edges filled
    with zeros hold; so each length is a sum over the next longer one's rows, ends included."""
    windows = F.transform(F.sequence(F.lit(0), F.size("words") - ORDER), lambda k: F.slice("words", k + 1, ORDER))
    rows = compact.select(F.explode(windows).alias("_w"), "f").select(*(F.col("_w")[k].alias(w) for k, w in enumerate(WORDS)), "f")
    found = []
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            rows = rows.select(*_filled(k), "f").groupBy(*WORDS).agg(F.sum("f").alias("f"))
        rows = store(rows, "flow")
        found.append(rows.filter((F.col(WORDS[k - 1]) != 0) & (F.col("f") >= least)).withColumn("k", F.lit(k)))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _part(start: int, length: int) -> list[Column]:
    """Words ``start`` to ``start + length`` of a phrase as a phrase."""
    return [(F.col(WORDS[start + j]) if j < length else F.lit(0).cast("long")).alias(w) for j, w in enumerate(WORDS)]


def _scored(counts: DataFrame, sizes: DataFrame, scale: int) -> DataFrame:
    """Candidates with ``l, r, score`` of their lowest-scoring cut. Products take up to 38 digits."""
    rows = counts.filter("k > 1").withColumn("p", F.struct(*WORDS))
    cuts = None
    for k in range(2, ORDER + 1):
        for cut in range(1, k):
            one = rows.filter(F.col("k") == k).select("p", "k", F.col("f").alias("a"), F.lit(cut).alias("cut"), F.struct(*_part(0, cut)).alias("pl"), F.struct(*_part(cut, k - cut)).alias("pr"))
            cuts = one if cuts is None else cuts.unionByName(one)
    part = counts.select(F.struct(*WORDS).alias("p"), "f")
    both = cuts.join(part.toDF("pl", "l"), "pl").join(part.toDF("pr", "r"), "pr").withColumn("w1", F.col("p.w1")).join(sizes, "w1")
    high = f"(CAST({scale} * a AS DECIMAL(20, 0)) * CAST(n AS DECIMAL(17, 0)))"
    score = F.expr(f"{high} DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))")
    best = both.withColumn("score", score).groupBy("p", "k", "a", "lang", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("p", "k", "a", "lang", "n", "b.score", "b.l", "b.r")


def _contained(counts: DataFrame, percent: int) -> DataFrame:
    """Phrases ``p`` inside a longer one that is met at least ``percent`` % as often: ``p, most``."""
    longer = None
    for k in range(3, ORDER + 1):
        for length in range(2, k):
            for start in range(k - length + 1):
                one = counts.filter(F.col("k") == k).select(F.struct(*_part(start, length)).alias("p"), "f")
                longer = one if longer is None else longer.unionByName(one)
    return longer.groupBy("p").agg(F.max("f").alias("most"))


def mine(docs: DataFrame, top: int = 2_000, least: int = 100, percent: int = 100, scale: int = 1_000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Phrases of two to five words within a piece that occur ``least`` times or more; the score of the
    lowest-scoring cut into two parts is ``floor(scale * a * n / (l * r))``, in exact arithmetic.
    Phrases inside a longer candidate that is met at least ``percent`` % as often are left out. Order: score
    descending, ``a`` descending, phrase ascending by bytes. A null language is ``und``, a null text
    has no words; repeated rows count each; no rows give no phrases.
    """
    with shuffles_removed(docs.sparkSession):
        return _mine(docs, top, least, percent, scale, lang_col, text_col)


def _mine(docs: DataFrame, top: int, least: int, percent: int, scale: int, lang_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = store(word_counts(texts), "words")
    sizes = store(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    seed = 0
    while True:  # another seed in the unlikely case that two words share a key
        keyed = store(_keys(words, seed), "keys")
        clash = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("f").alias("m")).filter((F.col("c") > 1) & (F.col("m") >= least))
        if clash.isEmpty():
            break
        seed += 1
    frequent = keyed.filter(F.col("f") >= least)
    known = write_keys(frequent)
    if sum(known[1]) >= 2**31:
        raise ValueError("word numbers must fit 31 bits; raise the least count")
    sequences = store(_sequences(texts, known, seed), "sequences")
    pairs = write_keys(_pairs(sequences).filter(F.col("f") >= least))
    graph = store(edges(sequences, pairs), "edges")
    counts = store(phrase_counts(store(paths(graph, least), "paths"), least), "counts")

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = key_set(*known)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(table.find(batch.column(2).to_numpy()))], ["lang", "word", "id"])

    names = store(frequent.select("lang", "word", "key").mapInArrow(numbers, "lang string, word string, id long"), "names")
    totals = names.join(sizes, "lang").select(F.col("id").alias("w1"), "lang", "n")
    scored = _scored(counts, totals, scale).join(_contained(counts, percent), "p", "left")
    kept = store(scored.filter(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).drop("most"), "scored")
    spelt = kept.select("*", F.posexplode(F.array(*(F.col(f"p.{w}") for w in WORDS))).alias("at", "id")).filter("id <> 0").join(names.select("id", "word"), "id")
    spelt = spelt.groupBy("p", "lang", "a", "l", "r", "n", "score").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("p"), F.lit(PARTS))).orderBy(*order)
    first = spelt.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
