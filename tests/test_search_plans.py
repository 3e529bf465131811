"""What moves between tasks in the searches: texts and asked-for k-mers, not every k-mer of the references."""

import random

from pyspark.sql import functions as F

from refpanel.operators import alignment, similarity


def sequences(spark, n, seed, letters=60):
    rng = random.Random(seed)
    rows = [("a", str(i), "".join(rng.choice("ACDEFGHIKL") for _ in range(letters))) for i in range(n)]
    return spark.createDataFrame(rows, "family string, accession string, seq string")


def test_seed_index_moves_texts_only(spark):
    seqs = sequences(spark, 8, 1)
    index = similarity.seed_index(seqs, 5)
    per_sequence = index.groupBy("family", "accession").agg(F.count(F.lit(1)))
    plan = per_sequence._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(family" in plan
    want = {(r.accession, r.seq[i : i + 5], r.seq.find(r.seq[i : i + 5])) for r in seqs.collect() for i in range(56)}
    assert {(r.accession, r.kmer, r.pos) for r in index.collect()} == want


def plans_of(monkeypatch, module, run):
    seen = []
    write = module.materialize

    def noted(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(module, "materialize", noted)
    return run(), seen


def test_references_keep_only_asked_kmers(spark, monkeypatch):
    refs = sequences(spark, 12, 2)
    queries = refs.filter("accession < '2'").withColumn("accession", F.concat(F.lit("q"), "accession"))
    run = lambda: {(r.accession, r.subject_id, r.matches) for r in similarity.similarity_join(queries, refs, 5, None).collect()}
    found, plans = plans_of(monkeypatch, similarity, run)
    assert any("LeftSemi" in p and "strategy=broadcast" in p for p in plans)
    monkeypatch.setattr(similarity, "BROADCAST_KMERS", 0)  # many queries: the join alone finds the same
    assert run() == found and {("q0", "0", 60), ("q1", "1", 60)} <= found


def test_profile_scan_cuts_only_chosen_members(spark):
    rows = sequences(spark, 6, 3).withColumnRenamed("seq", "aligned")
    queries = rows.filter("accession = '2'").select("accession", F.col("aligned").alias("seq"))
    scan = alignment.profile_scan(queries, rows, alignment.build_profile(rows))
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert [(r.family, r.query_id, r.n_scored) for r in scan.collect()] == [("a", "2", 60)]


def test_sibling_audit_subtracts_once(spark):
    from refpanel.operators import select

    rows = [(f"f{i}", [f"g{i}", f"x{i % 3}"], ["P"], ["g1"] if i % 2 else None) for i in range(6)]
    panel = spark.createDataFrame(rows, "family string, pos_genes array<string>, neg_pfam array<string>, exclude_genes array<string>")
    audit = select.sibling_exclusion_audit(panel)
    assert audit._jdf.queryExecution().optimizedPlan().toString().count("array_except") == 1
    symbols = {g for r in rows for g in r[1]}
    want = {f: ",".join(sorted(symbols - set(pos) - set(out or []))) for f, pos, _, out in rows}
    assert {r.family: r.missing_genes for r in audit.collect()} == want
    assert all(r.n_missing == len(want[r.family].split(",")) for r in audit.collect())
