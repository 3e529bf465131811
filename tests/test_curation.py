import pytest

from refpanel.operators import qc, refs, split
from refpanel.operators import select as sel
from refpanel.sources.families import families_table

SEQ = "family string, label string, accession string, organism string, seq string, length int"


def seqs(spark, family, label, lengths, start=0):
    return [(family, label, f"{family}{label[0]}{i + start}", f"G{i % 3}_s{i}", "A" * n, n) for i, n in enumerate(lengths)]


def test_length_window_edges_and_fusions(spark):
    fam = families_table(spark, [dict(name="a", fusion_partner="b", fusion_marker="M"), dict(name="b"), dict(name="c", negative_median_override=200)])
    rows = (
        seqs(spark, "a", "positive", [100, 100, 100, 100, 100, 150, 151, 240, 250])
        + seqs(spark, "b", "positive", [200] * 5)
        + seqs(spark, "c", "negative", [100] * 5)
        + seqs(spark, "b", "negative", [10] * 4)
        + seqs(spark, "a", "negative", [100] * 6)
    )
    domains = spark.createDataFrame([("ap7", ["M", "Z"]), ("an0", ["M"])], "accession string, domains array<string>")
    df = spark.createDataFrame(rows, SEQ)
    got = {r.accession: r.outcome for r in qc.length_outliers(df, fam, domains).collect()}
    assert (got["ap5"], got["ap6"], got["ap7"], got["ap8"]) == ("kept", "flagged", "fusion", "flagged")
    assert got["an0"] == "contaminant" and got["an1"] == "kept"
    assert {got[f"cn{i}"] for i in range(5)} == {"flagged"} and got["bn0"] == "too_few"
    plain = {r.accession: r.outcome for r in qc.length_outliers(df, fam).collect()}
    assert plain["ap8"] == "fusion"  # without evidence, length alone decides
    man = {(r.family, r.label): r for r in qc.length_manifest(qc.length_outliers(df, fam, domains)).collect()}
    assert (man["a", "negative"].n_total, man["a", "negative"].n_contaminants) == (5, 1) and ("b", "negative") not in man
    assert man["c", "negative"].median_source == "override"


def test_extra_positives_dedupe(spark):
    have = spark.createDataFrame(seqs(spark, "a", "positive", [5]), SEQ)
    extra = [("a", 1, "x__L_1 p", "AA"), ("a", 2, "y__L_1 p", "CC"), ("a", 3, "ap0 known", "A"), ("zz", 4, "q", "A")]
    added, manifest = qc.add_extra_positives(have, spark.createDataFrame(extra, "family string, ord long, header string, seq string"))
    assert [(r.family, r.source_tag, r.accession, r.seq) for r in added.collect()] == [("a", "a_study", "L_1", "AA")]
    assert tuple(manifest.first()) == ("a", 3, 1, 2)


@pytest.mark.parametrize("maker", [split.split_random, split.split_by_genus])
def test_splits(spark, maker):
    df = spark.createDataFrame(seqs(spark, "a", "positive", [9] * 23) + seqs(spark, "b", "positive", [9] * 4) + [("c", "positive", f"c{i}", "One_x", "A", 1) for i in range(10)], SEQ)
    got = maker(df).collect()
    count = lambda f, s: sum(r.family == f and r.split == s for r in got)
    assert count("b", "train") == count("b", "test") == 0
    assert count("c", "test") == 2
    if maker is split.split_random:
        assert (count("a", "train"), count("a", "test")) == (19, 4)
    else:
        genera = {s: {r.organism.split("_")[0] for r in got if r.family == "a" and r.split == s} for s in ("train", "test")}
        assert genera["train"] and genera["test"] and not genera["train"] & genera["test"]
    assert sorted(map(tuple, got)) == sorted(map(tuple, maker(df.repartition(3)).collect()))


def test_capped_sample_sizes(spark):
    df = spark.createDataFrame(seqs(spark, "a", "positive", [9] * 1300) + seqs(spark, "b", "positive", [9] * 20), SEQ)
    caps = spark.createDataFrame([("a", "positive", 90), ("b", "positive", 50)], "family string, label string, max_n int")
    got = sel.capped_sample(df, caps).collect()
    mine = [r.accession for r in got if r.family == "a"]
    assert len(mine) == 90 and len(got) == 110
    assert set(mine) <= set(sorted(f"ap{i}" for i in range(1300))[:500])


def test_selection_rules(spark):
    fam = families_table(spark, [dict(name="a", pos_genes=["x"], neg_pfam=["D"], exclude_genes=["x"], taxonomy_id=2, fusion_partner="b", fusion_marker="F"), dict(name="b", pos_pfam=["D"], neg_pfam=["E"], neg_genes=["q"])])
    cat = spark.createDataFrame(
        [("1", ["x"], ["D"], [2]), ("2", ["y"], ["D"], [2]), ("3", ["y"], ["D", "F"], [2]), ("4", ["y"], ["D"], [3]), ("5", ["q"], ["E"], [3]), ("6", ["y"], ["E"], [3])],
        "accession string, gene_names array<string>, domains array<string>, lineage array<int>",
    )
    pick = lambda label: sorted((r.family, r.accession) for r in sel.select_sequences(cat, fam, label).collect())
    assert pick("positive") == [("a", "1"), ("b", "1"), ("b", "2"), ("b", "3"), ("b", "4")]
    assert pick("negative") == [("a", "2"), ("b", "5")]


def test_decoys_fused_and_assembly(spark):
    fam = families_table(spark, [dict(name="b", fusion_partner="a", decoy_from_negatives=True), dict(name="a", fusion_partner="b"), dict(name="c", fusion_partner="nope")])
    parts = spark.createDataFrame(
        [("b", "negative", "n1", "o", "AC", "train"), ("b", "negative", "p1", "o", "AD", "train"), ("b", "negative", "n2", "o", "AE", "test"), ("a", "positive", "p1", "o", "AF", "train"), ("a", "positive", "p2", "o", "AG", "test")],
        "family string, label string, accession string, organism string, seq string, split string",
    )
    decoys = refs.decoy_refs(parts, fam)
    assert [(r.family, r.accession) for r in decoys.collect()] == [("b_decoy", "n1")]
    pairs = sel.fusion_pairs(fam)
    assert [tuple(r) for r in pairs.collect()] == [("a", "b")]
    cand = spark.createDataFrame([("a", "f1", "o", "S1"), ("b", "f1", "o", "S2"), ("b", "f2", "o", "S3")], "family string, accession string, organism string, seq string")
    ded = spark.createDataFrame([("a", "b", "f2", "o", "S4"), ("a", "b", "f3", "o", "S5")], "fam_a string, fam_b string, accession string, organism string, seq string")
    fused = refs.fusion_refs(pairs, cand, ded)
    assert sorted((r.family, r.accession, r.seq) for r in fused.collect()) == [("a_b_fused", "f1", "S1"), ("a_b_fused", "f2", "S3"), ("a_b_fused", "f3", "S5")]
    everything = refs.assemble_refs(parts, decoys, fused)
    assert {r.accession for r in everything.collect()} == {"p1", "n1", "f1", "f2", "f3"}
    report = {r.check: r.n for r in split.leakage_report(parts, everything, parts.filter("split = 'test' and label = 'negative'")).collect()}
    assert set(report.values()) == {0}


def test_unnamed_rows_are_selected_as_negatives(spark):
    """No gene names or domains is as good as an empty list; only the anchor decides."""
    fam = families_table(spark, [dict(name="a", pos_genes=["x"], neg_pfam=["D"], exclude_genes=["x"], exclude_pfam=["E"], fusion_partner="b", fusion_marker="F")])
    rows = [("1", None, ["D"], [2]), ("2", ["y"], ["D"], [2]), ("3", ["x"], ["D"], None), ("4", ["y"], ["D", "F"], None), ("5", None, None, None), ("6", ["x"], None, None)]
    cat = spark.createDataFrame(rows, "accession string, gene_names array<string>, domains array<string>, lineage array<int>")
    assert {r.accession for r in sel.select_sequences(cat, fam, "negative").collect()} == {"1", "2"}
    assert {r.accession for r in sel.select_sequences(cat, fam, "positive").collect()} == {"3", "6"}


def test_small_tables_are_broadcast(spark):
    """Config and per-family results have known sizes: the sequences are not dealt by family."""
    fam = families_table(spark, [dict(name=f) for f in "abc"])
    assert "LocalRelation" in fam._jdf.queryExecution().optimizedPlan().toString()
    seqs = spark.range(200_000).selectExpr("element_at(array('a', 'b', 'c'), cast(id % 3 AS int) + 1) AS family", "'positive' AS label", "cast(id AS string) AS accession", "'o' AS organism", "repeat('A', 40) AS seq", "40 AS length")
    for df in (sel.apply_scope(seqs, fam, "profile"), split.split_random(seqs), seqs.join(fam.select("family", "trim_gt"), "family")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning(family" not in plan
