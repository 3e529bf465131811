import math
import random

import pytest
from pyspark.sql import functions as F

from refpanel.operators import alignment as aln
from refpanel.operators import qc
from refpanel.operators import reads as rd
from refpanel.operators import regions as rg
from refpanel.operators.cluster import cluster_greedy
from refpanel.operators.similarity import bitscore, evalue, least_score, similarity_join


def mutate(rng, seq, rate, letters="ACDEFGHIKLMNPQRSTVWY"):
    return "".join(rng.choice(letters) if rng.random() < rate else c for c in seq)


def align(q, r, k):
    """Plain definition of the best diagonal of two sequences."""
    first = lambda s: {s[i : i + k]: i for i in reversed(range(len(s) - k + 1))}
    a, b = first(q), first(r)
    diags = {}
    for kmer in a.keys() & b.keys():
        diags.setdefault(a[kmer] - b[kmer], []).append(a[kmer])
    if not diags:
        return None
    diag, pos = min(diags.items(), key=lambda d: (-len(d[1]), d[0]))
    start = max(0, diag)
    size = min(len(q), len(r) + diag) - start
    same = [q[start + i] == r[start - diag + i] for i in range(size)]
    lo, hi = min(pos) - start, max(pos) - start + k
    return {"shared": len(a.keys() & b.keys()), "n": len(a), "identity": sum(same) / min(len(q), len(r)), "pident": 100 * sum(same[lo:hi]) / (hi - lo)}


@pytest.fixture(scope="module")
def proteins():
    rng = random.Random(11)
    rows = []
    for f in "AB":
        seeds = ["".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(rng.randint(40, 90))) for _ in range(6)]
        hot = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(20))
        for i in range(40):
            seq = mutate(rng, rng.choice(seeds), rng.choice([0, 0, 0.03, 0.08, 0.15]))
            seq = seq + hot if i % 3 == 0 else seq  # a passage in a third of the rows
            rows.append((f, f"{f}{i:02d}", seq[: rng.randint(len(seq) - 6, len(seq))]))
        rows += [(f, f"{f}x{i}", rows[-1][2]) for i in range(10)]  # copies
    return rows


def test_similarity_join_equals_brute_force(spark, proteins):
    queries, refs = proteins[::2], proteins[1::2]
    frame = lambda rows: spark.createDataFrame(rows, "family string, accession string, seq string")
    got = {r.accession: (r.family, round(r.pident, 6)) for r in similarity_join(frame(queries), frame(refs), k=5, max_evalue=None, containment=40).collect()}
    found = set()
    for f, acc, seq in queries:
        hits = [align(seq, s, 5) for g, _, s in refs if g == f]
        hits = [h for h in hits if h and h["shared"] * 100 >= 40 * h["n"]]
        if hits:
            found.add(acc)
            assert got[acc][1] in {round(h["pident"], 6) for h in hits}
    assert found == set(got)


def near(q, r, identity):
    """Whether ``identity`` of ``q`` matches ``r`` on some diagonal."""
    allowed = int((1 - identity) * len(q) + 1e-9) if q else -1  # an empty one is like no other
    for diag in range(-allowed, len(r) - len(q) + allowed + 1):
        spoilt = max(0, -diag) + max(0, diag + len(q) - len(r))
        for i in range(max(0, -diag), min(len(q), len(r) - diag)):
            spoilt += q[i] != r[i + diag]
            if spoilt > allowed:
                break
        if spoilt <= allowed:
            return True
    return False


def sequential(rows, identity):
    """Representative of each of ``(group, accession, seq)``, one sequence after the other."""
    owner = {}
    for f in {r[0] for r in rows}:
        mine, reps = sorted((r for r in rows if r[0] == f), key=lambda r: (-len(r[2]), r[1])), []
        for _, acc, seq in mine:
            owner[acc] = next((a for a, s in reps if near(seq, s, identity)), acc) if len(mine) >= 5 else acc
            reps += [(acc, seq)] if owner[acc] == acc else []
    return owner


def clustered(spark, rows, *args, **kwargs):
    df = spark.createDataFrame([(f, "positive", a, s) for f, a, s in rows], "family string, label string, accession string, seq string")
    return {r.accession: r.representative for r in cluster_greedy(df, *args, **kwargs).collect()}


@pytest.mark.parametrize("identity,k", [(0.9, 8), (0.7, 5)])
def test_cluster_greedy_equals_sequential(spark, proteins, identity, k):
    """Copies, a passage in a third of the rows, very short sequences, a group that is too small."""
    rows = proteins + [("C", f"c{i}", "ACDEF" * 3) for i in range(4)]
    rows += [("S", f"s{i:02d}", s) for i, s in enumerate(["A", "C", "AC", "CA", "ACD", "ACDEFGHIKL", "ACDEFGHIKV", "VCDEFGHIKL", "CDEFGHIKL", "", "ACDEFGHIKLMNPQRSTVWYACDEFGHIKL"])]
    assert clustered(spark, rows, identity, k=k) == sequential(rows, identity)


def test_cluster_greedy_keeps_spread_mismatches(spark):
    """Pairs at 90 % identity cluster however their mismatches lie, those just below do not."""
    rng, rows = random.Random(5), []
    letters = "ACDEFGHIKLMNPQRSTVWY"
    for i in range(14):
        base = [rng.choice(letters) for _ in range(300)]
        other, n = base[:], 29 + i % 3
        for p in [j * 300 // n for j in range(n)] if i < 7 else rng.sample(range(300), n):
            other[p] = letters[(letters.index(other[p]) + 1) % 20]
        rows += [("f", f"a{i:02d}", "".join(base)), ("f", f"b{i:02d}", "".join(other))]
    got = clustered(spark, rows)
    assert got == sequential(rows, 0.9)
    assert {a for a, r in got.items() if a != r} == {f"b{i:02d}" for i in range(14) if i % 3 < 2}


def test_cluster_greedy_chains_and_large_groups(spark):
    """A chain of sequences of which only neighbours are similar, and many variants of one."""
    rng, letters, rows = random.Random(3), "ACDEFGHIKLMNPQRSTVWY", []
    seq = [rng.choice(letters) for _ in range(120)]
    order = list(range(120))
    for i in range(40):
        for p in (order * 20)[i * 8 : i * 8 + 8]:
            seq[p] = letters[(letters.index(seq[p]) + 1) % 20]
        rows.append(("chain", f"h{i:03d}", "".join(seq)))
    base = [rng.choice(letters) for _ in range(200)]
    for i in range(150):
        other = base[: rng.randint(195, 200)]
        for p in rng.sample(range(190), rng.randint(0, 15)):
            other[p] = rng.choice(letters)
        rows.append(("dense", f"d{i:03d}", "".join(other)))
    assert clustered(spark, rows) == sequential(rows, 0.9)


CONTIG = "contig_id string, family string, label string, accession string, seq string"


def test_reads_are_found_where_they_were_cut(spark):
    rng = random.Random(2)
    contigs = [(f"c{i}", "f", "positive", f"a{i}", "".join(rng.choice("ACGT") for _ in range(900))) for i in (1, 12)]
    df = spark.createDataFrame(contigs + [("c3", "f", "positive", "a3", "ACGT" * 100)], CONTIG)
    tiles = rd.tile_reads(df.filter("contig_id <> 'c3'"), [60, 100], 50)
    assert tiles.count() == 2 * 2 * (17 + 17)
    assigned = {r.read_id: r.contig_id for r in rd.assign_contig(tiles.select("read_id"), df).collect()}
    assert all(k.startswith(v + "_") for k, v in assigned.items())
    located = {r.read_id: (r.start, r.end) for r in rd.locate_reads(tiles.select("read_id", "contig_id", "seq"), df).collect()}
    assert located == {r.read_id: (r.start, r.end) for r in tiles.collect()}
    truth = {r.read_id: (r.overlap_bp, r.overlaps_cds) for r in rd.read_truth(tiles.select("read_id", "seq"), df).collect()}
    assert truth["c1_250_60/1"] == (10, 0) and truth["c1_300_60/2"] == (60, 1) and truth["c1_0_100/1"] == (0, 0)
    assert {r.contig_id: r.usable for r in rd.cds_bounds(df).collect()} == {"c1": True, "c12": True, "c3": False}


def test_location_uses_the_last_place_that_fits(spark):
    unit = "ACGTTGCATCAGGATCCATTG"
    contig = unit + "C" * 30 + unit + "GGTT"
    df = spark.createDataFrame([("c", "f", "positive", "a", contig)], CONTIG)
    reads = spark.createDataFrame([("one", "c", unit), ("fits", "c", unit + "C" * 30), ("short", "c", "ACGT"), ("none", "c", "T" * 40)], "read_id string, contig_id string, seq string")
    got = {r.read_id: (r.start, r.end) for r in rd.locate_reads(reads, df).collect()}
    # the last place of the unit is 51; there the longer read would run over the end, and its next probe is placed at 0
    assert got["one"] == (51, 72) and got["fits"] == (0, 51) and "short" not in got and "none" not in got


def test_orfs(spark):
    dna = "ATGAAATTTTAACCC"
    got = rd.translate_orfs(spark.createDataFrame([("r/1", dna)], "read_id string, seq string"), min_aa=3).collect()
    forward = {(r.orf_id, r.aa) for r in got if r.frame == 1}
    assert forward == {("r/1_1_1_1", "MKF")}
    assert {r.frame for r in got} <= {1, 2, 3, 4, 5, 6} and ("r/1_1_4_1", "G*NFH".split("*")[0]) not in {(r.orf_id, r.aa) for r in got}


def test_region_overlap_brute_force(spark):
    rng = random.Random(4)
    regions = [(f"f{i % 3}", rng.choice("ab"), s, s + rng.randint(10, 3500), i) for i, s in enumerate(rng.sample(range(1, 9000), 25))]
    reads = [(f"r{i}", rng.choice("ab"), s, s + 149) for i, s in enumerate(rng.sample(range(1, 12000), 200))]
    got = rg.overlap_regions(
        spark.createDataFrame(reads, "read_id string, contig string, start long, end long"),
        spark.createDataFrame(regions, "family string, contig string, start long, end long, ord long"),
    )
    for r in got.collect():
        hits = [g for g in regions if g[1] == r.contig and min(r.end, g[3]) - max(r.start, g[2]) + 1 >= 20]
        assert r.family == (min(hits, key=lambda g: g[4])[0] if hits else "background")
    assert got.count() == 200


def test_alignment_trim_and_profile(spark):
    rows = [("f", "a", "AC-D"), ("f", "b", "AC-"), ("f", "c", "A-GD"), ("g", "x", "AA")]
    df = spark.createDataFrame(rows, "family string, accession string, aligned string")
    assert {r.accession: r.trimmed for r in aln.trim_alignment(df, default_gt=0.6).collect()} == {"a": "ACD", "b": "AC-", "c": "A-D"}
    profile = {(r.family, r.col, r.residue): (r.n, r.depth) for r in aln.build_profile(df).collect()}
    assert profile["f", 1, "C"] == (2, 2) and profile["f", 0, "A"] == (3, 3) and ("f", 2, "-") not in profile


def test_location_compares_characters_as_they_are(spark):
    """Wildcards in a read match only themselves, and most reads may come from one long contig."""
    rng = random.Random(6)
    contig = "".join(rng.choice("ACGT") for _ in range(200_000))
    contig = contig[:500] + "N*.A" + contig[504:]
    df = spark.createDataFrame([("big", "f", "positive", "a", contig), ("small", "f", "positive", "b", "A" * 700)], CONTIG)
    cuts = [(f"r{i}", "big", contig[p : p + 80], p) for i, p in enumerate(rng.sample(range(1000, 199_000), 200))]
    cuts.append(("wild", "big", contig[490:560], 490))
    reads = [c[:3] for c in cuts] + [("dot", "big", "." * 60), ("star", "big", "*" * 60), ("long", "small", "A" * 800), ("none", "big", None)]
    got = {r.read_id: r.start for r in rd.locate_reads(spark.createDataFrame(reads, "read_id string, contig_id string, seq string"), df).collect()}
    assert got == {c[0]: c[3] for c in cuts}


def test_purity_flags_similar_and_spares_unrelated_negatives(spark):
    """Negatives at 70 to 100 % identity are flagged, unrelated ones of ordinary length are not."""
    rng, letters = random.Random(8), "ACDEFGHIKLMNPQRSTVWY"
    draw = lambda: "".join(rng.choice(letters) for _ in range(300))
    positives = [("f", f"p{i:03d}", draw()) for i in range(300)]
    negatives = [("f", f"n{i:02d}", draw()) for i in range(60)]
    for i in range(40):
        seq = list(positives[i][2])
        for p in rng.sample(range(5, 295), i * 85 // 39):  # the identity between the outer seeds is 70 % or more
            seq[p] = letters[(letters.index(seq[p]) + 1) % 20]
        negatives.append(("f", f"s{i:02d}", "".join(seq)))
    frame = lambda rows: spark.createDataFrame(rows, "family string, accession string, seq string")
    hits = similarity_join(frame(negatives), frame(positives))
    flagged = {r.accession for r in qc.negative_purity(frame(negatives), hits).filter("flagged").collect()}
    assert flagged == {f"s{i:02d}" for i in range(40)}
    assert all(r.evalue <= 0.001 for r in hits.collect())
    weak = similarity_join(frame(negatives), frame(positives), max_evalue=None)
    assert weak.filter("accession like 'n%' and pident = 100").count() > 30  # chance hits, which the cut is for


def test_evalue(spark):
    row = spark.range(1).select(evalue(bitscore(F.lit(40), F.lit(2)), F.lit(100.0), F.lit(90_000.0)), least_score(F.lit(100.0), F.lit(90_000.0), 1e-3)).first()
    assert row[0] == pytest.approx(0.621 * 100 * 90_000 * math.exp(-1.33 * 36))
    assert 0.621 * 100 * 90_000 * math.exp(-1.33 * row[1]) == pytest.approx(1e-3, rel=1e-4)
