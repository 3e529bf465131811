"""Plain versions of the operators' definitions, for small inputs."""

import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width=4):
    w = WORD.findall(lower(text))
    return frozenset(zip(*(w[k:] for k in range(width)))) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(links, nodes):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def near_duplicates(docs, percent=80):
    """{id: (set size, smallest id reachable)}; ids are unique."""
    sets = {i: shingles(t) for i, t in docs}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    roots = components(linked, sets)
    return {i: (len(s), roots[i]) for i, s in sets.items()}


def contamination(docs, items, size=13):
    """[(id, words, hit words, item ids)] in the order of ``docs``."""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w, seen, again = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:]))
    inside = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def entities(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".") if x.isdigit()), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def kneser_ney(texts, order, discounts):
    """(probability of a word after a context of order - 1 ids, vocabulary); None is the end."""
    docs = [[*WORD.findall(lower(t)), None] for t in texts]
    vocabulary = {w for d in docs for w in d}
    counts = {order: Counter(tuple((["<s>"] * (order - 1) + d)[k : k + order]) for d in docs for k in range(len(d)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter()
        for g, c in counts[n + 1].items():
            counts[n][g[1:]] += c if g[1] == "<s>" else 1
    discount = {n: discounts([sum(v == k for v in c.values()) for k in range(1, 5)]) for n, c in counts.items()}

    def p(context, word):
        n = len(context) + 1
        below = p(context[1:], word) if n > 1 else 1 / (len(vocabulary) + 1)
        seen = [c for g, c in counts[n].items() if g[:-1] == context]
        if not seen:
            return below
        d = lambda c: discount[n][min(c, 3) - 1] if c else 0
        c = counts[n][(*context, word)]
        return (max(c - d(c), 0) + sum(map(d, seen)) * below) / sum(seen)

    return p, vocabulary
