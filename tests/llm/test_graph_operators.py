"""Fingerprints, manifests and collocations against plain versions."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from refpanel.llm import collocations, merkle, simhash
from refpanel.llm import workload as llm

from . import plain


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(len(words) - 3, 1))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_segments_leave_one_bit():
    for distance in range(9):
        found = simhash.segments(distance)
        assert [b for s in found for b in s] == list(range(64)) and distance // len(found) <= 1
        assert len(found) == 1 or distance // (len(found) - 1) > 1


@pytest.mark.parametrize("distance,bucket,tile", [(4, 10**4, 2048), (6, 10**4, 7), (1, 8, 3), (4, 8, 2048), (0, 8, 8)])
def test_fingerprint_links(spark, monkeypatch, distance, bucket, tile):
    """Every pair within the distance, in dense groups, chains and noise; small buckets take blocks."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "TILE", tile)
    draw = random.Random(distance)
    flip = lambda x, n: x ^ sum(1 << b for b in draw.sample(range(64), n))
    fps = {draw.getrandbits(64) for _ in range(150)} | {0}
    center = draw.getrandbits(64)
    fps |= {flip(center, draw.randint(0, distance)) for _ in range(80)}
    for _ in range(30):
        center = flip(center, draw.randint(1, distance + 1))
        fps.add(center)
    fps = sorted(signed(x) for x in fps)
    pairs = [(a, b) for k, a in enumerate(fps) for b in fps[:k] if ((a ^ b) & (2**64 - 1)).bit_count() <= distance]
    want = plain.components(pairs, set(fps))
    found = {r.node: r.root for r in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), distance).collect()}
    assert {x: found.get(x, x) for x in fps} == want


def test_simhash_documents(spark):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    docs = [" ".join(draw.choices(words, k=draw.choice([1, 3, 4, 5, 80, 300]))) for _ in range(120)]
    for k in range(60):
        base = docs[k % 7 + 20].split()
        base[draw.randrange(len(base))] = "changed"
        docs.append(" ".join(base).upper())
    docs += ["", None, " \t\n", "one", "One", "é " * 10, docs[5], docs[5]]
    rows = list(enumerate(docs))
    fps = [plain_fingerprint(t) for t in docs]
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = plain.components(links, set(range(len(fps))))
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {k: (f"{fp:016x}", want[k]) for k, fp in enumerate(fps)}


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(f"t{k % 97}" for k in range(5000))
    monkeypatch.setattr(simhash, "HASHED", 611)
    assert simhash.fingerprint(text.encode(), 4) == signed(plain_fingerprint(text))


def test_simhash_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 10 and simhash.near_duplicates(nothing).count() == 0
    assert {r.component_id for r in rows if r.doc_id in (2, 3, 4)} == {2}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root and the siblings of every leaf, level by level."""
    level, owner, proof = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for k, at in enumerate(owner):
            run = range(at - at % 3, min(at - at % 3 + 3, len(level)))
            proof[k].append((at % 3, [level[j] for j in run if j != at]))
        level = [h(*level[k : k + 3]) for k in range(0, len(level), 3)]
        owner = [at // 3 for at in owner]
    return level[0], proof


def plain_audit(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h(*map(part, (r[0], r[2], r[3], r[4], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = plain_tree([x[2] for x in groups[s]])
    root, above = plain_tree([trees[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for (_, _, own, r), way in zip(groups[s], trees[s][1]):
            way = way + above[k]
            at = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                at = leaf(r, r[1].replace("\n", ""))
            for spot, others in way:
                at = h(*others[:spot], at, *others[spot:])
            out.append((r[0], own, trees[s][0], root, h(*(d for _, o in way for d in o)), at, at == root))
    return out


@pytest.mark.parametrize("levels", [6, 1])
def test_manifest(spark, monkeypatch, levels):
    """Sources of every size from 1 to 40, a hot one, null and repeated rows; low blocks give several tiers."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    draw = random.Random(9)
    rows = []
    for s, n in enumerate([*range(1, 12), 27, 28, 40, 200]):
        for _ in range(n):
            rows.append((draw.randrange(10**6), draw.choice(["a\nb", "c", "", "\n\n", "é\n"]), f"s{s}", "en", 3))
    rows += [(None, "x\ny", None, None, None), (7, None, None, "en", 1), (7, None, None, "en", 1), (9, "a\nb", "é", "en", 3), (8, "A", "Z", "en", 3)]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(7)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = merkle.audit(docs, tampered=tampered).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(plain_audit(rows), key=key)
    assert {r.verified for r in found} == {True, False} and len({r.root for r in found}) == 1


def test_one_leaf_is_the_root(spark):
    docs = spark.createDataFrame([(1, "t", "s", "en", 1)], "doc_id long, text string, source string, lang string, n_chars long")
    (r,) = merkle.audit(docs).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("") and r.verified


def test_manifest_rows(odd, nothing):
    assert merkle.audit(odd).filter("verified").count() == 10 and merkle.audit(nothing).count() == 0


def plain_phrases(rows, top, least, percent=100):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    cands = {(g, p): a for (g, p), a in f.items() if len(p) > 1 and a >= least}
    out = []
    for (g, p), a in cands.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
        if any(x == g and len(q) > len(p) and 100 * b >= percent * a and inside(q) for (x, q), b in cands.items()):
            continue
        score, _, left, right = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p)))
        out.append((g, -score, -a, " ".join(p).encode(), left, right))
    ranked, seen = [], Counter()
    for g, score, a, p, left, right in sorted(out):
        seen[g] += 1
        if seen[g] <= top:
            ranked.append((g, seen[g], p.decode(), -a, left, right, n[g], -score))
    return ranked


@pytest.mark.parametrize("least,percent,top", [(1, 100, 10**6), (3, 100, 2000), (4, 80, 25)])
def test_collocations(spark, least, percent, top):
    """Chains, loops, short pieces, repeated passages, control characters and null languages."""
    draw = random.Random(least)
    words = "the of a b c d Ünder x\x01 z".split(" ")
    passage = " ".join(f"p{k}" for k in range(12))
    rows = []
    for _ in range(120):
        text = " ".join(draw.choices(words, k=draw.randint(0, 12))) + draw.choice([". ", ",", "\n", "\t", " "]) + draw.choice([passage, "A b A b A b", "", "the"])
        rows.append((text, draw.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), ("  . ! ", "fr")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = collocations.mine(docs, top=top, least=least, percent=percent).collect()
    assert sorted(map(tuple, found)) == sorted(plain_phrases(rows, top, least, percent))


def test_collocation_blocks(spark, monkeypatch):
    """The same where every buffer is full at once."""
    for name, value in {"HELD": 5, "ROW_IDS": 4, "BLOCK_IDS": 3, "PARTS": 2}.items():
        monkeypatch.setattr(collocations, name, value)
    rows = [("one two three four five six. one two", "en")] * 3 + [("two three four five", "en")]
    found = collocations.mine(spark.createDataFrame(rows, "text string, lang string"), least=2).collect()
    assert sorted(map(tuple, found)) == sorted(plain_phrases(rows, 2000, 2))


def test_paths_are_compacted(spark):
    rows = [(k, k + 1, k + 2, k + 3, k + 4, 5) for k in range(1, 41)] + [(1, 50, 0, 0, 0, 5)]
    found = collocations.paths(spark.createDataFrame(rows, "w1 long, w2 long, w3 long, w4 long, w5 long, f long"), 5).collect()
    assert sorted(len(r.words) for r in found) == [5, 44] and max(r.words for r in found)[0] == 1


def test_large_products(spark):
    """Scores beyond 64-bit products."""
    counts = spark.createDataFrame([(1, 2, 0, 0, 0, 2, 10**12), (1, 0, 0, 0, 0, 1, 10**12 + 7), (2, 0, 0, 0, 0, 1, 10**12 + 9)], "w1 long, w2 long, w3 long, w4 long, w5 long, k int, f long")
    sizes = spark.createDataFrame([(1, "en", 3 * 10**15)], "w1 long, lang string, n long")
    (r,) = collocations._scored(counts, sizes, 1000).collect()
    assert r.score == 1000 * 10**12 * 3 * 10**15 // ((10**12 + 7) * (10**12 + 9))


def test_collocation_rows(odd, nothing):
    assert collocations.mine(odd, least=50).count() > 0 and collocations.mine(nothing).count() == 0
    assert set(llm.SQL) >= {"op12_merkle_manifest", "op13_collocations"}


def test_counting_tasks_stay_small():
    """What a task holds and hands on at once doesn't grow with its rows."""
    draw = np.random.default_rng(5)
    ids = draw.integers(1, 1_000, (40, 100_000), np.int32)
    batches = (pa.RecordBatch.from_arrays([pa.array(list(np.pad(x.reshape(-1, 1_000), ((0, 0), (0, 1)))))], ["ids"]) for x in ids)
    grams = lambda ids: [np.roll(ids, -k)[ids != 0] for k in range(5)]
    tracemalloc.start()
    total = 0
    for batch in collocations._summed(grams, [*collocations.WORDS, "f"])(batches):
        assert batch.num_rows <= 100_000
        total += sum(batch.column(5).to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == ids.size and peak < 200 << 20
