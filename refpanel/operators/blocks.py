"""Best hits of many queries, block by block, without a row for any shared k-mer.

Pairs that share a k-mer grow with the square of the sequences, and a shuffle of them soon takes more
disk than the sequences themselves. Here only texts move: references are dealt into blocks of about
``BLOCK_LETTERS`` letters, each query goes to every block that it meets, and a task holds the sorted
k-mers of one block while the queries stream by. What leaves the task is a query's best hit in that block.
The copies of queries grow with the square too, so blocks are searched in rounds: a round copies about twice as many
letters as there are, and what it shuffled is deleted before the next one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.session import materialize, set_while, ship_code, shuffles_removed

#: Letters of references that one task holds, about; a longer sequence is a block of its own.
BLOCK_LETTERS = 5_000_000
#: Letters of queries that one task holds against a block, about, and letters that a round may copy at least.
SLICE_LETTERS, ROUND_LETTERS = 250_000_000, 200_000_000
#: Rows that a task gets at a time: few, as a row is a whole text.
BATCH_ROWS = "1000"
#: Letters of queries that are looked up together, about.
QUERY_LETTERS = 500_000
#: Shared k-mers that are sorted, and letters that are compared, at a time.
LIMIT = 2_000_000

_COUNTS = ["shared", "seeds", "diag", "q_start", "span", "matches", "overlap_matches", "q_len", "r_len"]
_SCHEMA = "q_family string, q_id string, r_family string, r_id string, total long, " + ", ".join(f"{c} {'long' if c in ('shared', 'seeds') else 'int'}" for c in _COUNTS)


class Texts:
    """Some texts as one array of code points, with the place and length of each."""

    def __init__(self, texts: list[str]):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.letters = letters.astype(np.uint16) if not len(letters) or letters.max() < 65_536 else letters

    def hashes(self, k: int, seed: int) -> np.ndarray:
        """Hash of ``k`` letters from every place on, over the ends of texts too; put together from halves."""
        n = max(0, len(self.letters) - k + 1)
        factor = 0x9E3779B97F4A7C15 + 2 * seed
        have, size = self.letters.astype(np.uint64), 1
        for bit in bin(k)[3:]:
            power = np.uint64(pow(factor, size, 1 << 64))
            both = have[: max(0, len(have) - size)] * power
            both += have[size:]
            have, size = both, 2 * size
            if bit == "1":
                have = have[:-1] * np.uint64(factor)
                have += self.letters[size:]
                size += 1
        h = have[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def of(self, at: np.ndarray) -> np.ndarray:
        """The text of each place in all letters."""
        return np.searchsorted(self.starts, at, "right") - 1

    def inside(self, k: int) -> np.ndarray:
        """Places in all letters from which ``k`` letters are of one text."""
        sizes = np.maximum(self.lengths - k + 1, 0)
        return _spread(self.starts, sizes)


def _equal(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, k: int) -> np.ndarray:
    """Whether the ``k`` letters from ``at`` in ``a`` are those from ``bt`` in ``b``."""
    same = np.ones(len(at), bool)
    for i in range(k):
        same &= a.take(at + i) == b.take(bt + i)
    return same


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.empty(0, np.int64)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each size, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Block:
    """Distinct k-mers of some references with the first place of each in each of them.

    What two sequences share is mostly longer than a k-mer, so shared k-mers are not listed one by one: of
    each run of them on a diagonal only the first and the last are. A shared k-mer is the first of its run unless
    the letters before it agree as well (and these k-mers count, as first of their kind in their texts). So
    a k-mer's places are kept by the letter before, and once more by the letter behind.
    """

    def __init__(self, ids: list[str], families: list, texts: list[str], k: int):
        self.k, self.ids, self.families, self.texts = k, ids, families, Texts(texts)
        names = {f: i for i, f in enumerate(dict.fromkeys(families))}
        self.family = np.array([names[f] for f in families], np.int64)
        self.rank = np.empty(len(ids), np.int64)
        self.rank[sorted(range(len(ids)), key=lambda i: ids[i].encode("utf-8", "surrogatepass"))] = np.arange(len(ids))
        for seed in range(1000):  # another one where two k-mers have one hash
            if self._build(seed):
                return
        raise ValueError("no hash tells the k-mers of this block apart")

    def _sorted(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of ``at`` by hash, those of a hash in order."""
        bits = np.uint64(max(1, len(self.texts.letters).bit_length()))
        keys = h[at]
        keys >>= bits
        keys <<= bits
        keys |= at.view(np.uint64)
        keys.sort()
        at = (keys & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
        keys >>= bits
        # Where hashes differ in their last bits only, these decide.
        full = h[at]
        del h
        unlike = (keys[1:] == keys[:-1]) & (full[1:] != full[:-1])
        if unlike.any():
            some = np.flatnonzero(np.isin(keys, keys[1:][unlike]))
            some = some, some[np.lexsort((at[some], full[some]))]
            at[some[0]], full[some[0]] = at[some[1]], full[some[1]]
        return full, at

    def _build(self, seed: int) -> bool:
        letters, k = self.texts.letters, self.k
        h, at = self._sorted(self.texts.hashes(k, seed), self.texts.inside(k))
        same = h[1:] == h[:-1]
        twice = np.flatnonzero(same)
        if not all(_equal(letters, at[p], letters, at[p + 1], k).all() for p in np.array_split(twice, 1 + len(twice) // LIMIT)):
            return False
        copy = twice[self.texts.of(at[twice]) == self.texts.of(at[twice + 1])] + 1
        keep = np.ones(len(h), bool)
        keep[copy] = False
        h, at = h[keep], at[keep]
        first = _runs(h)  # of each distinct k-mer
        self.hashes, self.seed = h[first], seed
        self.first = np.append(first, len(at))
        self.bits = max(1, int(len(self.hashes)).bit_length())
        self.bucket = np.zeros((1 << self.bits) + 1, np.int32)
        np.cumsum(np.bincount((self.hashes >> np.uint64(64 - self.bits)).astype(np.int64), minlength=1 << self.bits), out=self.bucket[1:])
        self.seen = np.zeros(1 << self.bits, np.uint8)  # a small table tells most that are not there
        spot = (self.hashes >> np.uint64(61 - self.bits)).astype(np.int64)
        starts = _runs(spot >> 3)
        self.seen[spot[starts] >> 3] = np.bitwise_or.reduceat(np.uint8(1) << (spot & 7).astype(np.uint8), starts) if len(starts) else 0
        # Letters as small numbers: 0 for none in a reference, 1 for none in a query.
        self.alphabet = np.unique(letters)
        kind = np.uint8 if len(self.alphabet) < 254 else np.int32
        counts = np.zeros(len(letters) + 2, bool)  # by place, with one place before and one behind
        counts[at + 1] = True
        codes = np.zeros(len(letters) + 2, kind)
        if letters.dtype == np.uint16:
            numbers = np.zeros(65_536, kind)
            numbers[self.alphabet] = np.arange(len(self.alphabet)) + 2
            codes[1:-1] = numbers[letters]
        else:
            codes[1:-1] = np.searchsorted(self.alphabet, letters) + 2
        sizes = np.diff(self.first)
        many = np.flatnonzero(sizes > 1)  # of the others there is nothing to put in order
        some, kmer = _spread(self.first[many], sizes[many]), np.repeat(many, sizes[many])
        self.sides = []
        for step in (-1, 1):
            beside = codes[at + (0 if step < 0 else 1 + k)]
            beside[~counts[at + 1 + step]] = 0
            order = some[np.argsort((kmer << 32) | beside[some], kind="stable")]
            places = at.astype(np.int32)
            places[some], beside[some] = places[order], beside[order]
            self.sides.append((places, beside))
        return True

    def _lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are there, and their k-mers: hashes are spread evenly, so a few steps find each."""
        spot = (h >> np.uint64(61 - self.bits)).view(np.int64)
        bit = self.seen.take(spot >> 3)
        bit >>= spot.astype(np.uint8) & np.uint8(7)
        bit &= np.uint8(1)
        hit = np.flatnonzero(bit.view(bool))
        h = h[hit]
        found = self.bucket[(h >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        active = np.flatnonzero(found < len(self.hashes))
        while len(active):
            active = active[self.hashes[found[active]] < h[active]]
            found[active] += 1
            active = active[found[active] < len(self.hashes)]
        there = np.flatnonzero(found < len(self.hashes))
        there = there[self.hashes[found[there]] == h[there]]
        return hit[there], found[there]

    def _seeds(self, q: Texts) -> tuple[np.ndarray, ...]:
        """Text, place and k-mer of the first of each k-mer of each text, and the letters beside those that follow on one another."""
        hit, kmer = self._lookup(q.hashes(self.k, self.seed))
        text = q.of(hit)
        real = hit - q.starts[text] + self.k <= q.lengths[text]
        hit, kmer, text = hit[real], kmer[real], text[real]
        real = _equal(q.letters, hit, self.texts.letters, self.sides[0][0][self.first[kmer]].astype(np.int64), self.k)
        hit, kmer, text = hit[real], kmer[real], text[real]
        once = np.unique(text * len(self.hashes) + kmer, return_index=True)[1]  # the first, since places are in order
        once.sort()
        at, kmer, text = hit[once], kmer[once], text[once]
        # Those letters are in shared k-mers, so some reference has them.
        n = np.flatnonzero((at[1:] == at[:-1] + 1) & (text[1:] == text[:-1]))
        before, behind = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
        before[n + 1], behind[n] = (np.searchsorted(self.alphabet, q.letters[at[n] + step]) + 2 for step in (0, self.k))
        return text, at - q.starts[text], kmer, before, behind

    def best(self, texts: list[str], least: np.ndarray) -> list[np.ndarray]:
        """``query, reference`` and the counts of each query's best reference of each family.

        A seeded span of fewer letters than the query's ``least`` is no hit.
        """
        q = Texts(texts)
        parts = [self._contenders([np.concatenate(x) for x in zip(*some)], least) for some in self._gathered(self._seeds(q))]
        if not parts:
            return [np.empty(0, np.int64)] * (2 + len(_COUNTS))
        rows = self._contenders([np.concatenate(x) for x in zip(*parts)], least)
        query, ref, shared, n, diag, lo, hi = rows
        span = hi - lo + self.k
        matches = self._matches(q, query, ref, lo, lo - diag, span)
        score = 3 * matches - 2 * span  # match +1, mismatch -2
        order = np.lexsort((self.rank[ref], -score, self.family[ref], query))
        top = order[_runs(query[order] * len(self.ids) + self.family[ref[order]])]
        query, ref, shared, n, diag, lo, span, matches = (x[top] for x in (query, ref, shared, n, diag, lo, span, matches))
        q_len, r_len, start = q.lengths[query], self.texts.lengths[ref], np.maximum(diag, 0)
        overlap = self._matches(q, query, ref, start, start - diag, np.minimum(q_len, r_len + diag) - start)
        return [query, ref, shared, n, diag, lo, span, matches, overlap, q_len, r_len]

    def _gathered(self, seeds: tuple[np.ndarray, ...]) -> Iterator[list[list[np.ndarray]]]:
        """Best diagonals of all pairs, in lists of bounded size."""
        kept: list[list[np.ndarray]] = []
        for rows in self._pairs(*seeds):
            kept.append(rows)
            if sum(len(x[0]) for x in kept) > LIMIT:
                yield kept
                kept = []
        if kept:
            yield kept

    def _unlike(self, side: int, kmer: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of the two stretches of a k-mer's places that have another letter than ``beside`` on that side."""
        codes = self.sides[side][1]
        begin, end = self.first[kmer], self.first[kmer + 1]
        first, last = codes[begin], codes[end - 1]
        low = np.where(first < beside, end, begin)  # where the stretch of that letter begins and ends
        high = np.where(last > beside, begin, end)
        for out, more in ((low, first < beside), (high, last > beside)):
            some = np.flatnonzero(more & (first <= beside) & (last >= beside) & ((first != beside) | (last != beside)))
            a, b = begin[some], end[some]
            while len(a) and (b > a).any():  # the first place whose letter is not below, or is above
                middle = (a + b) >> 1
                up = (codes[np.minimum(middle, len(codes) - 1)] < beside[some]) if out is low else (codes[np.minimum(middle, len(codes) - 1)] <= beside[some])
                up &= b > a
                a, b = np.where(up, middle + 1, a), np.where(up, b, np.minimum(middle, b))
            out[some] = a
        none = (first > beside) | (last < beside)
        low, high = np.where(none, end, low), np.where(none, end, high)
        return begin, low - begin, high, end - high

    def _pairs(self, text: np.ndarray, place: np.ndarray, kmer: np.ndarray, before: np.ndarray, behind: np.ndarray) -> Iterator[list[np.ndarray]]:
        """Best diagonal of each pair of a query and a reference."""
        if not len(text):
            return
        ends = []
        for side, beside in ((0, before), (1, behind)):
            a, n, b, m = self._unlike(side, kmer, beside)
            ends.append((np.concatenate([a, b]), np.concatenate([n, m])))
        sizes = sum(n[: len(text)] + n[len(text) :] for _, n in ends)
        done = np.cumsum(sizes)
        queries, starts = np.arange(text[-1] + 2), 0
        last = done[np.searchsorted(text, queries[:-1], "right") - 1] * (np.searchsorted(text, queries[:-1], "right") > 0)
        while starts <= text[-1]:  # whole queries, as many as the limit takes
            base = last[starts - 1] if starts else 0
            stop = max(starts + 1, int(np.searchsorted(last, base + LIMIT, "right")))
            a, b = np.searchsorted(text, (starts, stop))
            if b > a and last[stop - 1] > base:
                mine = [[(x[a:b], n[a:b]), (x[len(text) + a : len(text) + b], n[len(text) + a : len(text) + b])] for x, n in ends]
                yield from self._lines(text[a:b], place[a:b], mine, 0, len(self.ids))
            starts = stop

    def _listed(self, side: int, text: np.ndarray, place: np.ndarray, stretches: list, low: int, high: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Query, its place, reference and place there of what the stretches hold, of references from ``low`` to below ``high``."""
        for begin, size in stretches:
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // LIMIT, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(size)]):
                at = self.sides[side][0][_spread(begin[a:b], size[a:b])].astype(np.int64)
                own, mine = np.repeat(text[a:b], size[a:b]), np.repeat(place[a:b], size[a:b])
                ref = self.texts.of(at)
                if low > 0 or high < len(self.ids):
                    some = (ref >= low) & (ref < high)
                    own, mine, ref, at = own[some], mine[some], ref[some], at[some]
                yield own, mine, ref, at - self.texts.starts[ref]

    def _lines(self, text: np.ndarray, place: np.ndarray, ends: list, low: int, high: int) -> Iterator[list[np.ndarray]]:
        """Best diagonal of each pair of a query and a reference from ``low`` to below ``high``."""
        queries = int(text[-1] - text[0]) + 1
        back = int(self.texts.lengths[low:high].max())
        widths = [int(x).bit_length() for x in (queries * (high - low), back + place.max() + 1, place.max())]
        total = sum(int(n.sum()) for side in ends for _, n in side)
        if queries > 1 and sum(widths) > 63:
            cut = int(np.searchsorted(text, text[0] + (queries + 1) // 2))
            for part in (slice(0, cut), slice(cut, None)):
                yield from self._lines(text[part], place[part], [[(x[part], n[part]) for x, n in side] for side in ends], low, high)
            return
        if high - low > 1 and (sum(widths) > 63 or queries == 1 and total * (high - low) > LIMIT * len(self.ids)):
            for a, b in ((low, (low + high) // 2), ((low + high) // 2, high)):
                yield from self._lines(text, place, ends, a, b)
            return
        keys = []
        for side, stretches in enumerate(ends):
            parts = []
            for own, mine, ref, at in self._listed(side, text, place, stretches, low, high):
                pair = (own - text[0]) * (high - low) + ref - low
                parts.append((((pair << widths[1]) | (mine - at + back)) << widths[2]) | mine)
            keys.append(np.sort(np.concatenate(parts)) if parts else np.empty(0, np.int64))
        if not len(keys[0]):
            return
        begin, end = keys  # of each run of shared k-mers, the first and the last
        line = begin >> widths[2]
        starts = _runs(line)
        n = np.add.reduceat(end - begin + 1, starts)
        mask = (1 << widths[2]) - 1
        lo, hi = begin[starts] & mask, end[np.append(starts[1:], len(line)) - 1] & mask
        pair, diag = line[starts] >> widths[1], (line[starts] & ((1 << widths[1]) - 1)) - back
        first = _runs(pair)
        shared = np.add.reduceat(n, first)
        most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(pair))))
        best = np.flatnonzero(n == most)
        best = best[_runs(pair[best])]  # the lowest diagonal of those
        pair = pair[best]
        yield [pair // (high - low) + text[0], pair % (high - low) + low, shared, n[best], diag[best], lo[best], hi[best]]

    def _contenders(self, rows: list[np.ndarray], least: np.ndarray) -> list[np.ndarray]:
        """Rows that can be the best hit of their query and family, see ``similarity.contenders``."""
        query, ref, _, n, _, lo, hi = rows
        span = hi - lo + self.k
        possible = np.flatnonzero(span >= least[query])
        rows, span, n = [x[possible] for x in rows], span[possible], n[possible]
        _, target = np.unique(rows[0] * len(self.ids) + self.family[rows[1]], return_inverse=True)
        sure = 3 * np.minimum(n + self.k - 1, span) - 2 * span
        floor = np.full(target.max() + 1 if len(target) else 0, np.iinfo(np.int64).min)
        np.maximum.at(floor, target, sure)
        return [x[span >= floor[target]] for x in rows]

    def _matches(self, q: Texts, query: np.ndarray, ref: np.ndarray, q_from: np.ndarray, r_from: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Equal letters along each stretch."""
        out = np.zeros(len(query), np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // LIMIT, prepend=-1)) if len(size) else []
        for a, b in zip(cuts, [*cuts[1:], len(size)]):
            part = size[a:b]
            same = q.letters[_spread(q.starts[query[a:b]] + q_from[a:b], part)] == self.texts.letters[_spread(self.texts.starts[ref[a:b]] + r_from[a:b], part)]
            out[a:b] = np.add.reduceat(same, np.cumsum(part) - part, dtype=np.int64)
        return out


def block_hits(q: DataFrame, r: DataFrame, totals: DataFrame | int, k: int, least_score, best: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``best`` leaves of ``(q_family, q_id, r_family, r_id, total, counts)``, in each round: hits of each query, the best in each block and reference family.

    ``q([family], id, seq)`` and ``r(family, id, seq)`` hold distinct sequences. ``totals(family, total)`` is the
    length of the references of each family, if queries meet their own family only, or a number, the length
    of all. ``least_score(q_len, total)`` gives the least span of a hit (a number) or is None.
    """
    spark = r.sparkSession
    same_family = isinstance(totals, DataFrame)
    parts = lambda letters, size: F.greatest(F.lit(1), F.ceil(F.col(letters) / size).cast("int"))
    asked = q.groupBy(*(["family"] if same_family else [])).agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("asked"))
    sizes = asked.join(totals, "family") if same_family else asked.withColumn("total", F.lit(totals).cast("long"))
    sizes = materialize(sizes.withColumn("many", parts("total", BLOCK_LETTERS)).withColumn("slices", parts("asked", SLICE_LETTERS)))
    # Every block takes all queries of its group, every slice all references of its block.
    tasks, copied, letters = sizes.agg(F.sum(F.col("many") * F.col("slices")), F.sum(F.col("many") * F.col("asked") + F.col("slices") * F.col("total")), F.sum(F.col("asked") + F.col("total"))).first()
    rounds = max(1, -(-int(copied or 0) // max(ROUND_LETTERS, 2 * int(letters or 0))))
    with_sizes = lambda rows: rows.join(sizes, "family") if same_family else rows.join(F.broadcast(sizes))
    group = (F.col("family") if same_family else F.lit("")).alias("g")
    columns = ["g", "b", "s", "side", "family", "id", "seq", "total"]
    block, part = F.pmod(F.xxhash64("family", "id"), F.col("many")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    refs = with_sizes(r.select("family", "id", "seq")).filter(F.length("seq") >= k).select(group, block.alias("b"), each("slices").alias("s"), F.lit(0).alias("side"), "family", "id", "seq", "total")
    asked = with_sizes(q.select(F.col("family") if same_family else F.lit("").alias("family"), "id", "seq")).filter(F.length("seq") >= k)
    asked = asked.select(group, each("many").alias("b"), part.alias("s"), F.lit(1).alias("side"), "family", "id", "seq", "total")
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * -(-int(tasks or 1) // rounds))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, refs, block, queries, letters = None, [], None, [], 0

        def found() -> pa.RecordBatch:
            ids, texts = zip(*queries)
            spans = np.array([least_score(len(t), total) if least_score else 0.0 for t in texts])
            query, ref, *counts = block.best(list(texts), spans)
            fields = [[key[0]] * len(query), [ids[i] for i in query], [block.families[i] for i in ref], [block.ids[i] for i in ref], [total] * len(query)]
            return pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(fields, types)), *(pa.array(x).cast(t) for x, t in zip(counts, types[5:]))], names)

        total = 0
        for batch in batches:
            for g, b, s, side, family, name, seq, length in zip(*(c.to_pylist() for c in batch.columns)):
                if (g, b, s) != key:
                    if queries:
                        yield found()
                    key, refs, block, queries, letters, total = (g, b, s), [], None, [], 0, length
                if side == 0:
                    refs.append((name, family, seq))
                    continue
                if not refs and block is None:
                    continue
                if block is None:
                    block = Block(*(list(x) for x in zip(*refs)), k)
                    refs = []
                queries.append((name, seq))
                letters += len(seq)
                if letters >= QUERY_LETTERS:
                    yield found()
                    queries, letters = [], 0
        if queries:
            yield found()

    ship_code(spark)
    names = ["q_family", "q_id", "r_family", "r_id", "total", *_COUNTS]
    types = [*[pa.string()] * 4, pa.int64(), *(pa.int64() if c in ("shared", "seeds") else pa.int32() for c in _COUNTS)]
    found = None
    with shuffles_removed(spark):
        for i in range(rounds):
            now = F.pmod(F.col("b") + F.pmod(F.xxhash64("g"), F.lit(rounds)), F.lit(rounds)) == i
            rows = refs.select(columns).filter(now).unionByName(asked.select(columns).filter(now))
            rows = rows.repartition(least, "g", "b", "s").sortWithinPartitions("g", "b", "s", "side")
            with set_while(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
                hits = materialize(best(rows.mapInArrow(searched, _SCHEMA)))
            found = hits if found is None else found.unionByName(hits)
    return found


def least_span(max_evalue: float | None, scale: float, kappa: float):
    """The least score as a plain function for tasks; see ``similarity.least_score``."""
    if max_evalue is None:
        return None
    return lambda q_len, total: (math.log(max(q_len * total, 1) * kappa) - math.log(max_evalue)) / scale - 1e-6
