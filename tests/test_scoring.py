import random
import statistics

import pytest
from pyspark.sql import functions as F

from refpanel.operators import calibrate as cal
from refpanel.operators import metrics as m
from refpanel.operators.cumulative import exact_quantile, nth_digest, running_totals
from refpanel.operators.scorecard import qc_scorecard

HITS = "method string, sample string, read_id string, subject_id string, family string, bitscore double"
TRUTH = "read_id string, family string, label string, overlaps_cds int, read_length int"


def test_running_totals_with_a_hot_key(spark):
    rng = random.Random(1)
    data = {("hot", round(rng.uniform(-50, 900), 1)): rng.randint(1, 5) for _ in range(900)} | {("b", float(i)): 1 for i in range(5)}
    df = spark.createDataFrame([(k, s, n) for (k, s), n in data.items()], "k string, s double, n long")
    for desc in (False, True):
        got = {(r.k, r.s): (r.cum_n, r.tot_n) for r in running_totals(df, ["k"], "s", ["n"], descending=desc).collect()}
        for (k, s), n in data.items():
            want = sum(v for (k2, s2), v in data.items() if k2 == k and (s2 >= s if desc else s2 <= s))
            assert got[k, s] == (want, sum(v for (k2, _), v in data.items() if k2 == k))


def test_exact_quantile_and_nth_digest(spark):
    values = [1.0, 2.5, 2.5, 7.0, 100.0, 3.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 4.0)], "k string, v double")
    got = {r.k: r.q for r in exact_quantile(df, ["k"], "v", 0.5, "q").collect()}
    assert got == {"a": statistics.median(values), "b": 4.0}
    keyed = spark.range(3000).withColumn("k", F.lit("x")).withColumn("h", F.md5(F.col("id").cast("string")))
    want = sorted(r.h for r in keyed.collect())[599]
    assert nth_digest(keyed, ["k"], "h", lambda n: F.floor(n * 0.2), "c").first().c == want


def labelled(spark, with_score=True):
    hits = [
        ("search", "s1", "r1", "p1", "A", 50.0), ("search", "s1", "r1", "p2", "B", 60.0), ("search", "s1", "r2", "p1", "A", 40.0),
        ("search", "s1", "r2", "p9", "A", 40.0), ("search", "s2", "r2", "p1", "B", 41.0), ("search", "s1", "r3", "p1", "A", 30.0),
        ("search", "s1", "bg1", "p1", "A", 20.0), ("search", "s1", "r5", "p1", "A", 45.0),
    ]
    truth = [("r1", "A", "positive", 1, 120), ("r2", "A", "positive", 1, 150), ("r3", "A", "positive", 0, 149), ("r4", "B", "positive", 1, 100), ("r5", "A", "positive", 1, 99), ("bg1", "background", "negative", 0, 100), ("bg2", "background", "negative", 0, 100)]
    calls = m.best_hit(spark.createDataFrame(hits, HITS))
    return m.label_reads(calls, spark.createDataFrame(truth, TRUTH), methods=("search",), with_score=with_score), calls


def test_labels_and_summary(spark):
    got, calls = labelled(spark)
    picked = {(r.sample, r.read_id): (r.family, r.subject_id) for r in calls.collect()}
    assert picked["s1", "r1"] == ("B", "p2") and picked["s1", "r2"] == ("A", "p1")
    by_read = [(r.read_id, r.family_called, r.bitscore, r.correct) for r in got.collect()]
    assert sum(r[0] == "r2" for r in by_read) == 2  # one row per sample when truth has no sample
    assert ("r4", "NO_CALL", 19.0, False) in by_read
    s = {r.family: r for r in m.summarize(got).collect()}
    assert (s["A"].tp, s["A"].fp, s["A"].fn) == (2, 1, 2) and s["B"].f1 is None and s["B"].precision is None
    wide = {r.family: r for r in m.summarize(got, fp_scope="all").collect()}
    assert (wide["A"].fp, wide["B"].fp) == (2, 2)
    lengths = m.summarize_by_length(got).collect()
    assert sum(r.tp for r in lengths) == 2 and {r.read_length_bucket for r in lengths} == {"50-99bp", "100-149bp", "150-199bp"}
    bg = m.background_fpr(got).first()
    assert (bg.n_background_reads, bg.n_false_positive_calls, bg.background_fpr) == (2, 1, 0.5)


def test_no_calls_at_all_uses_minus_one(spark):
    truth = spark.createDataFrame([("r", "A", "positive", 1, 10)], TRUTH)
    got = m.label_reads(spark.createDataFrame([], HITS), truth, methods=("search",)).first()
    assert got.bitscore == -1.0 and got.family_called == "NO_CALL"


def test_best_threshold_takes_lowest_of_ties(spark):
    rows = [("search", "A", "A", True, 10.0), ("search", "A", "B", False, 5.0), ("search", "A", "A", True, 1.0), ("search", "B", "B", True, 3.0)]
    df = spark.createDataFrame(rows, "method string, family_called string, family_true string, genuine boolean, bitscore double")
    got = m.best_threshold(df).collect()
    # thresholds 10 -> f1 2/3, 5 -> 1/2, 1 -> 4/5; B is all true and left out
    assert [(r.family, r.best_threshold, r.tp, r.fp, r.fn) for r in got] == [("A", 1.0, 2, 1, 0)]


def test_curves_match_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.choice([True, False]), float(rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame([("search", c, s) for c, s in data], "method string, correct boolean, bitscore double")
    pos, neg = [s for c, s in data if c], [s for c, s in data if not c]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert m.roc_auc(df).first().roc_auc == pytest.approx(pairs)
    area, last_r, last_p = 0.0, 0.0, 1.0
    for t in sorted({s for _, s in data}, reverse=True):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        r, p = tp / len(pos), tp / (tp + fp)
        area += (r - last_r) * (p + last_p) / 2
        last_r, last_p = r, p
    assert m.pr_auc(df).first().pr_auc == pytest.approx(area)
    assert m.roc_auc(df.filter("correct")).count() == 0


def scores(spark, family, pos, neg):
    return [(family, "positive", float(x)) for x in pos] + [(family, "negative", float(x)) for x in neg]


def test_calibration_ladder(spark):
    data = (
        scores(spark, "clean", [10, 12], [4]) + scores(spark, "nopos", [], [5]) + scores(spark, "noneg", [7, 9], []) + scores(spark, "low", [0.5], [])
        + scores(spark, "few", [5, 9], [6] * 29) + scores(spark, "many", [5, 9], [6] * 30) + scores(spark, "seen", [7], [])
    )
    df = spark.createDataFrame(data, "family string, label string, score double")
    families = spark.createDataFrame([(f,) for f in ("clean", "nopos", "noneg", "low", "few", "many", "seen", "void")], "family string")
    searched = spark.createDataFrame([("seen",)], "family string")
    got = {r.family: (r.cutoff, r.status, r.f1) for r in cal.calibrate(df, "f1", families, searched).collect()}
    assert got["clean"] == (7.0, "clean_separation", 1.0)
    assert got["nopos"] == (0.0, "no_positive_scores", None) == got["void"]
    assert got["noneg"] == (6.0, "no_negatives_available", None) and got["low"][0] == 0.0
    assert got["few"] == (7.0, "insufficient_negative_data", None)
    assert got["many"] == (9.0, "overlapping_distributions_f1_calibrated", 2 / 3)
    assert got["seen"] == (6.0, "clean_separation_no_negative_hits", 1.0)
    pct = {r.family: (r.cutoff, r.status) for r in cal.calibrate(df, "percentile").collect()}
    assert pct["few"] == (6.0, "overlapping_distributions_review_needed") and pct["clean"][1] == "clean_separation"
    fixed = spark.createDataFrame([("clean", 6.0), ("many", 6.0), ("few", None)], "family string, cutoff double")
    cur = {r.family: (r.status, r.f1) for r in cal.check_curated_cutoff(df, fixed).collect()}
    assert cur["clean"] == ("pfam_ga_clean", 1.0) and cur["many"][0] == "pfam_ga_review_needed" and cur["few"][0] == "insufficient_negative_data"


def test_f1_sweep_brute_force(spark):
    rng = random.Random(3)
    data = scores(spark, "f", [rng.randint(0, 40) for _ in range(150)], [rng.randint(-10, 30) for _ in range(90)])
    pos, neg = [s for _, l, s in data if l == "positive"], [s for _, l, s in data if l == "negative"]
    best = max(((2 * sum(p >= t for p in pos) / (sum(p >= t for p in pos) + sum(n >= t for n in neg) + len(pos)), -t) for t in {s for *_, s in data}))
    got = cal.f1_sweep(spark.createDataFrame(data, "family string, label string, score double")).first()
    assert (got.f1, -got.cutoff) == best


def test_scorecard_flags_strictly_above_a_tenth(spark):
    fam = spark.createDataFrame([("a",), ("b",), ("c",)], "family string")
    purity = spark.createDataFrame([("a", 10, 1), ("b", 100, 11)], "family string, n_total long, n_flagged long")
    lengths = spark.createDataFrame([("a", "positive", 8, 1)], "family string, label string, n_total long, n_flagged long")
    cut = spark.createDataFrame([("a", 1.0, "clean_separation"), ("b", 1.0, "pfam_ga_clean")], "family string, cutoff double, status string")
    got = {r.family: (r.review_needed, r.review_reasons) for r in qc_scorecard(fam, purity, lengths, cut).collect()}
    assert got == {"a": ("yes", "pos_length=12%"), "b": ("yes", "neg_purity=11%;hmm_status=pfam_ga_clean"), "c": ("no", "")}


def test_hits_without_score_or_cover(spark):
    """A truncated hit never beats a scored one, and passes only bounds of 0."""
    hits = [("search", "s", "r1", "p1", "A", None), ("search", "s", "r1", "p2", "B", 50.0), ("search", "s", "r2", "p3", "A", None)]
    got = {r.read_id: (r.family, r.bitscore) for r in m.best_hit(spark.createDataFrame(hits, HITS)).collect()}
    assert got == {"r1": ("B", 50.0), "r2": ("A", None)}
    rows = [("full", 0.9, 0.8, 0.7), ("low", 0.12, 0.03, 0.5), ("cut", 0.9, 0.8, None), ("bare", None, 0.8, 0.7)]
    df = spark.createDataFrame(rows, "id string, pident double, qcov double, scov double")
    assert {r.id for r in m.filter_hits(df).collect()} == {"full", "cut"}
    assert {r.id for r in m.filter_hits(df, 0.0, 0.5, 0.1).collect()} == {"full", "bare"}


def test_cascade_joins_do_not_move_the_calls(spark):
    calls = spark.range(100_000).selectExpr("'s' AS sample", "cast(id AS string) AS read_id", "cast(id % 3 AS string) AS family", "1.0D AS bitscore")
    config = spark.createDataFrame([("1", 0.5, "yes", 2.0)], "family string, precision double, needs_check string, short_read_threshold double")
    plan = m.apply_cascade(calls, config, calls)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(family" not in plan


def test_benchmark_from_reads(spark):
    """Reads cut from contigs with planted genes are located, translated, searched and scored."""
    import random

    from refpanel.functions.sequence import GENETIC_CODE
    from refpanel.operators.reads import tile_reads
    from refpanel.plans import benchmark_reads

    rng = random.Random(4)
    codons = {}
    for i, aa in enumerate(GENETIC_CODE):
        codons.setdefault(aa, "TCAG"[i // 16] + "TCAG"[i // 4 % 4] + "TCAG"[i % 4])
    draw = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    proteins = {f: draw(200, "ACDEFGHIKLMNPQRSTVWY") for f in ("fa", "fb")}
    flank = 300
    dna = {f: draw(flank, "ACGT") + "".join(codons[a] for a in p) + draw(flank, "ACGT") for f, p in proteins.items()}
    contigs = spark.createDataFrame([(f"c_{f}", f, "positive", f"a_{f}", s) for f, s in dna.items()], "contig_id string, family string, label string, accession string, seq string")
    reads = tile_reads(contigs, [150, 240], 60).select("read_id", "seq")
    background = spark.createDataFrame([(f"bg{i}/1", draw(200, "ACGT")) for i in range(20)], "read_id string, seq string")
    refs = spark.createDataFrame([(f, f"r_{f}", p) for f, p in proteins.items()], "family string, accession string, seq string")
    alignment = spark.createDataFrame([(f, f"m{i}_{f}", p) for f, p in proteins.items() for i in range(3)], "family string, accession string, aligned string")
    out = benchmark_reads(reads, contigs, refs, alignment, background, min_aa=20)
    summary = {(r.method, r.family): r for r in out["summary"].collect()}
    assert set(summary) == {(m, f) for m in ("search", "profile") for f in proteins}
    # Reads that touch a gene by a few letters only cannot be told; all calls are right.
    assert all(r.precision == 1.0 and r.recall > 0.6 for r in summary.values()), summary
    assert {r.method: r.n_false_positive_calls for r in out["background"].collect()} == {"search": 0, "profile": 0}
    assert {r.read_length_bucket for r in out["by_length"].collect()} == {"150-199bp", "200-249bp"}
    assert sum(r.tp for r in out["by_length"].collect()) == sum(r.tp for r in summary.values())


def test_grouped_metrics_equal_the_single_ones(spark):
    from refpanel.operators import metrics as m

    rows = [("search", f"r{i}", "ab"[i % 2] if i % 5 else "background", ["a", "b", "NO_CALL"][i % 3], bool(i % 5) and i % 7 > 1, 40 * (i % 6)) for i in range(200)]
    df = spark.createDataFrame(rows, "method string, read_id string, family_true string, family_called string, genuine boolean, read_length int")
    for got, want in zip(m.grouped_metrics(df), (m.summarize(df), m.summarize_by_length(df), m.background_fpr(df))):
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_release_from_its_raw_snapshot(spark):
    """Derived tables made anew from stored raw ones are those of a fresh run; subsets are runs of their own."""
    import random

    from refpanel.plans import build_release
    from refpanel.sources.families import families_table, subset_families

    rng = random.Random(6)
    rows = []
    for i in range(80):
        seq = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(rng.randint(90, 110)))
        rows.append((f"p{i:02d}", ["a" if i % 2 else "b"], ["d1" if i % 4 < 2 else "d2"], [2], f"genus{i % 6}_x", seq))
    catalogue = spark.createDataFrame(rows, "accession string, gene_names array<string>, domains array<string>, lineage array<int>, organism string, seq string")
    families = families_table(spark, [dict(family="a", pos_genes=["a"], neg_pfam=["d1"], exclude_genes=["a"]), dict(family="b", pos_genes=["b"], neg_pfam=["d2"], exclude_genes=["b"], scope="annotate_only")])
    first = build_release(catalogue, families, "v1")
    shown = lambda r: (sorted(map(str, r.split.collect())), sorted(map(str, r.cutoffs.collect())))
    again = build_release(catalogue, families, "v2", raw=first.sequences, split_mode="taxonomy")
    fresh = build_release(catalogue, families, "v2", split_mode="taxonomy")
    assert shown(again) == shown(fresh) and shown(again)[0] != shown(first)[0]
    one = build_release(catalogue, subset_families(families, ["a"]), "sub", raw=first.sequences)
    assert {r.family for r in one.scorecard.collect()} == {"a"} and {r.family for r in one.split.collect()} == {"a"}
