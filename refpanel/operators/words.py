"""Which sequences are similar to which others: words as sorted numbers, counted by diagonal, letters compared.

A sequence cut into ``y`` words end to end keeps ``y - x`` of them on a diagonal with ``x`` mismatches.
The words that are most frequent among the others are left out, as many as still leave ``need`` sure
ones. Words of one diagonal lie in one strip of diagonals, so words are first counted by strip, then by
diagonal in the few strips that have ``need``, and only then are letters compared. Nothing of this
leaves the task but pairs that are similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from refpanel.operators.blocks import LIMIT, Texts, _runs, _spread

#: Letters of queries whose words are looked up together, about.
QUERY_LETTERS = 500_000
#: Letters and number of texts of which all pairs are compared, at most.
LEAF_LETTERS, LEAF_TEXTS = 1_000_000, 512
#: Places of words, and strips of diagonals, that are counted together: few enough for a processor's cache.
PLACES, STRIPS = 250_000, 250_000
#: A strip has ``1 << STRIP`` diagonals.
STRIP = 8
#: Letters from which a pair is compared by itself.
ALONE = 150


def _codes(letters: np.ndarray, at: np.ndarray | None, k: int, bits: int) -> np.ndarray:
    """Numbers below ``1 << bits`` of the words of ``k`` letters from ``at``, or of every one."""
    n = max(0, len(letters) - k + 1) if at is None else len(at)
    h = np.zeros(n, np.uint32)
    for i in range(k):
        h *= np.uint32(0x9E3779B1)
        h += letters[i : i + n] if at is None else letters[at + i]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0x297A2D39)
    return h >> np.uint32(32 - bits)


def _order(codes: np.ndarray) -> np.ndarray:
    """Places by code, those of a code in order."""
    keys = np.empty(len(codes), np.uint64)
    for a in range(0, len(codes), LIMIT):
        part = codes[a : a + LIMIT].astype(np.uint64)
        keys[a : a + LIMIT] = (part << np.uint64(32)) | np.arange(a, a + len(part), dtype=np.uint64)
    keys.sort()
    out = np.empty(len(codes), np.int32)
    for a in range(0, len(codes), LIMIT):
        out[a : a + LIMIT] = keys[a : a + LIMIT] & np.uint64(0xFFFFFFFF)
    return out


class Words:
    """Words of some texts at all places, to find the texts that others are similar to."""

    def __init__(self, texts: list[str], min_identity: float, word: int):
        self.texts, self.min_identity = Texts(texts), min_identity
        self.words = [word >> i for i in range(word.bit_length())]
        self.bits = max(8, min(22, len(self.texts.letters).bit_length()))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _table(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the places of each code begin, and the places."""
        if k not in self.tables:
            codes = _codes(self.texts.letters, None, k, self.bits)
            first = np.zeros((1 << self.bits) + 1, np.int64)
            np.cumsum(np.bincount(codes, minlength=1 << self.bits), out=first[1:])
            self.tables[k] = first, _order(codes)
        return self.tables[k]

    def earliest(self, texts: list[str]) -> np.ndarray:
        """The first text of these words that each of ``texts`` is similar to, or -1."""
        query, ref = self.similar(texts)
        none = len(self.texts.lengths)
        out = np.full(len(texts), none, np.int64)
        np.minimum.at(out, query, ref)
        out[out == none] = -1
        return out

    def similar(self, texts: list[str], earlier: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """All similar pairs of one of ``texts`` and one of these, a pair more than once if on several diagonals.

        With ``earlier`` those of a text and one of a lower number."""
        q = Texts(texts)
        x = np.floor((1 - self.min_identity) * q.lengths + 1e-9).astype(np.int64)
        parts, left = [], np.flatnonzero(q.lengths > x)
        for k in self.words:  # the longest word of which more fit into the text than mismatches can spoil
            fits = q.lengths[left] // k > x[left]
            mine, left = left[fits], left[~fits]
            if len(mine):
                cuts = np.flatnonzero(np.diff(np.cumsum(q.lengths[mine]) // QUERY_LETTERS, prepend=-1))
                parts += [p for a, b in zip(cuts, [*cuts[1:], len(mine)]) for p in self._met(q, mine[a:b], k, x[mine[a:b]], earlier)]
        return tuple(np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in (0, 1))

    def _met(self, q: Texts, mine: np.ndarray, k: int, x: np.ndarray, earlier: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        first, places = self._table(k)
        y = q.lengths[mine] // k
        before = np.cumsum(y) - y
        own = np.repeat(np.arange(len(mine)), y)
        place = (np.arange(len(own)) - before[own]) * k
        code = _codes(q.letters, q.starts[mine][own] + place, k, self.bits)
        begin = first[code]
        size = first[code.astype(np.int64) + 1] - begin
        need = np.minimum(y - x, 8 + y // 16)
        order = np.argsort((own << 32) | size)
        used = order[np.arange(len(own)) - before[own] < (x + need)[own]]  # of each its rarest words
        used = used[size[used] > 0]
        own, place, begin, size = own[used], place[used], begin[used], size[used]
        met = np.bincount(own, size, len(mine)).astype(np.int64)
        asked = np.flatnonzero(met >= need)
        strips = (len(self.texts.letters) + int(q.lengths[mine].max()) >> STRIP) + 2
        group = np.zeros(len(mine), np.int64)  # of those counted together, 0 for none
        n = full = width = 0
        for i, m in zip(asked.tolist(), met[asked].tolist()):
            if not n or full + m > PLACES or width + strips > STRIPS:
                n, full, width = n + 1, 0, 0
            group[i], full, width = n, full + m, width + strips
        for g in range(1, n + 1):
            some = np.flatnonzero(group == g)
            words = slice(np.searchsorted(own, some[0]), np.searchsorted(own, some[-1], "right"))
            o, p, b, s = own[words], place[words], begin[words], size[words]
            if len(some) == 1 and met[some[0]] > LIMIT:
                found = self._frequent(p, b, s, places, int(need[some[0]]), int(q.lengths[mine[some[0]]]))
            else:
                real = group[o] == g
                found = self._counted(np.searchsorted(some, o[real]), p[real], b[real], s[real], places, need[some], strips, int(q.lengths[mine].max()))
            query, ref, diag = found
            query = mine[some[query]]
            if earlier:
                query, ref, diag = (f[ref < query] for f in (query, ref, diag))
            if len(query):
                yield self._compared(q, query, ref, diag)

    def _counted(self, own, place, begin, size, places, need, strips: int, back: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, text and diagonal (the query's place 0 in all letters) of those with enough words."""
        width = strips << STRIP
        spread = np.repeat(begin - (np.cumsum(size) - size), size)
        spread += np.arange(len(spread))
        line = np.repeat(own * width - place + back, size)
        line += places[spread]
        strip = line >> STRIP
        hot = (np.bincount(strip, minlength=len(need) * strips).reshape(len(need), strips) >= need[:, None]).ravel()
        if not hot.any():
            return (np.empty(0, np.int64),) * 3
        hot = np.flatnonzero(hot[strip])
        line, at = line[hot], places[spread[hot]]
        order = np.lexsort((at, line))
        line, at = line[order], at[order]
        starts = _runs(line)
        counts = np.diff(np.append(starts, len(line)))
        real = np.repeat(counts >= need[line[starts] // width], counts)
        line, ref = line[real], np.searchsorted(self.texts.starts, at[real], "right") - 1
        new = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (ref[1:] != ref[:-1])])) if len(line) else np.empty(0, np.int64)
        line, ref = line[new], ref[new]
        return line // width, ref, line % width - back

    def _frequent(self, place, begin, size, places, need: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for one query whose words are in too many places to be held at once."""
        total = len(self.texts.letters)
        counts = np.zeros(total + length + 1, np.int32)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // LIMIT, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(size)]):
            at = places[_spread(begin[a:b], size[a:b])].astype(np.int64)
            counts += np.bincount(at - np.repeat(place[a:b], size[a:b]) + length, minlength=len(counts)).astype(np.int32)
        diag = np.flatnonzero(counts >= need) - length
        ref = lambda at: np.searchsorted(self.texts.starts, np.clip(at, 0, total - 1), "right") - 1
        low, high = ref(diag), ref(diag + length - 1)
        return np.zeros(int((high - low + 1).sum()), np.int64), _spread(low, high - low + 1), np.repeat(diag, high - low + 1)

    def _compared(self, q: Texts, query: np.ndarray, ref: np.ndarray, diag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that match well enough on their diagonal."""
        low = np.maximum(diag, self.texts.starts[ref])
        size = np.minimum(diag + q.lengths[query], self.texts.starts[ref] + self.texts.lengths[ref]) - low
        start = low - diag + q.starts[query]
        matches, few = np.zeros(len(query), np.int64), np.flatnonzero((size > 0) & (size < ALONE))
        cuts = np.flatnonzero(np.diff(np.cumsum(size[few]) // LIMIT, prepend=-1)) if len(few) else []
        for a, b in zip(cuts, [*cuts[1:], len(few)]):
            part = few[a:b]
            same = q.letters[_spread(start[part], size[part])] == self.texts.letters[_spread(low[part], size[part])]
            matches[part] = np.add.reduceat(same, np.cumsum(size[part]) - size[part], dtype=np.int64)
        mine, theirs, many = q.letters, self.texts.letters, np.flatnonzero(size >= ALONE)
        for i, a, b, n in zip(many.tolist(), start[many].tolist(), low[many].tolist(), size[many].tolist()):
            matches[i] = np.count_nonzero(mine[a : a + n] == theirs[b : b + n])
        good = (size > 0) & (matches / q.lengths[query] >= self.min_identity)
        return query[good], ref[good]


def greedy(texts: list[str], min_identity: float, word: int) -> np.ndarray:
    """The representative of each of ``texts``, longest first: itself, or the earliest one it is similar to."""
    owner = np.arange(len(texts))

    def settled(some: list[int]) -> list[int]:
        """Representatives among ``some``, of which none is similar to an earlier representative."""
        done = np.cumsum([len(texts[i]) for i in some])
        if len(some) < 2:
            return some
        if done[-1] > LEAF_LETTERS or len(some) > LEAF_TEXTS:
            half = min(max(1, int(np.searchsorted(done, done[-1] // 2))), len(some) - 1)
            reps, rest = settled(some[:half]), some[half:]
            first = Words([texts[i] for i in reps], min_identity, word).earliest([texts[i] for i in rest])
            for i, r in zip(rest, first.tolist()):
                owner[i] = i if r < 0 else reps[r]
            return reps + settled([i for i, r in zip(rest, first.tolist()) if r < 0])
        query, ref = Words([texts[i] for i in some], min_identity, word).similar([texts[i] for i in some], earlier=True)
        order = np.lexsort((ref, query))
        query, ref = query[order], ref[order]
        rep = np.ones(len(some), bool)
        starts = _runs(query)
        for a, b in zip(starts, [*starts[1:], len(query)]):
            mine = ref[a:b][rep[ref[a:b]]]
            if len(mine):
                rep[query[a]] = False
                owner[some[query[a]]] = some[mine[0]]
        return [i for i, r in zip(some, rep.tolist()) if r]

    settled(list(range(len(texts))))
    return owner
