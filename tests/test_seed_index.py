import random

import pytest
from pyspark.sql import functions as F

from refpanel.functions import kmers
from refpanel.operators.seed_index import add_release, create_seed_index, indexed_search, release_seeds
from refpanel.operators.similarity import align_pairs, best_hits, distinct_sequences, similarity_join
from refpanel.plans.benchmark import search_reads

LETTERS = "ACDEFGHIKLMNPQRSTVWY"
SCHEMA = "family string, accession string, seq string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def releases():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    seeds = {f: [word(rng.randint(60, 200)) for _ in range(4)] for f in "AB"}

    def like(seq):
        return "".join(rng.choice(LETTERS) if rng.random() < 0.1 else c for c in seq)

    first = [(f, f"{f}{i}", like(rng.choice(seeds[f]))) for f in "AB" for i in range(15)]
    first += [("A", "A00", first[0][2]), ("A", "copy", first[0][2]), ("B", "empty", ""), ("B", "null", None)]
    second = [r for r in first if r[1] != "A3"] + [("B", f"new{i}", like(seeds["B"][0])) for i in range(5)]
    queries = [(f, f"q{f}{i}", like(rng.choice(seeds[f]))) for f in "AB" for i in range(12)]
    queries += [("A", "qempty", ""), ("A", "qnull", None), ("A", "again", queries[0][2])]
    return first, second, queries


def rows_of(df):
    columns = ["family", "accession", "subject_id", "shared", "span", "matches", "pident", "bitscore", "evalue"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("same_family", [True, False])
def test_indexed_search_equals_search(spark, releases, tmp_path, same_family):
    first, second, queries = releases
    folder = str(tmp_path / "index")
    create_seed_index(spark, folder, 5, same_family)
    for name, rows in (("v1", first), ("v2", second)):
        add_release(frame(spark, rows).withColumn("digest", F.lit("extra")), folder, name)
    for name, rows in (("v1", first), ("v2", second)):
        refs = frame(spark, [r for r in rows if r[2] is not None])
        for evalue in (0.001, None):
            want = rows_of(similarity_join(frame(spark, queries), refs, 5, evalue, same_family=same_family))
            assert rows_of(indexed_search(frame(spark, queries), folder, name, evalue)) == want and want


def test_refresh_adds_only_new_sequences(spark, releases, tmp_path):
    first, second, _ = releases
    folder = str(tmp_path / "index")
    create_seed_index(spark, folder)
    add_release(frame(spark, first), folder, "v1")
    once = release_seeds(spark, folder).count()
    add_release(frame(spark, second), folder, "v2")
    more = {s[i : i + 5] for _, a, s in second if a.startswith("new") for i in range(len(s) - 4)}
    rows = release_seeds(spark, folder)
    assert once < rows.count() <= once + sum(len(s) - 4 for _, a, s in second if a.startswith("new"))
    assert more <= {r.kmer for r in rows.select("kmer").distinct().collect()}
    assert rows.count() == rows.select("r_id", "kmer").distinct().count()
    with pytest.raises(ValueError):
        add_release(frame(spark, second), folder, "v2")
    with pytest.raises(ValueError):
        indexed_search(frame(spark, first), folder, "v9")


def test_what_a_broken_run_left_is_not_read(spark, releases, tmp_path):
    first, _, queries = releases
    folder = str(tmp_path / "index")
    create_seed_index(spark, folder)
    add_release(frame(spark, first), folder, "v1")
    want = rows_of(indexed_search(frame(spark, queries), folder, "v1"))
    stray = spark.createDataFrame([("A", "x", queries[0][2][:5], 0, "stray")], "family string, digest string, kmer string, pos int, batch string")
    stray.write.partitionBy("batch").mode("append").parquet(f"{folder}/seeds")
    spark.createDataFrame([("A", "x", queries[0][2], "stray")], "family string, digest string, seq string, batch string").write.parquet(f"{folder}/sequences/stray")
    assert rows_of(indexed_search(frame(spark, queries), folder, "v1")) == want


def test_empty_index_and_no_queries(spark, releases, tmp_path):
    folder = str(tmp_path / "index")
    create_seed_index(spark, folder, same_family=False)
    add_release(frame(spark, []), folder, "v0")
    assert indexed_search(frame(spark, releases[2]), folder, "v0").count() == 0
    add_release(frame(spark, releases[0]), folder, "v1")
    assert indexed_search(frame(spark, []), folder, "v1").count() == 0


def test_index_is_not_moved(spark, releases, tmp_path):
    folder = str(tmp_path / "index")
    create_seed_index(spark, folder, buckets=4)
    for name, rows in zip(("v1", "v2"), releases):
        add_release(frame(spark, rows), folder, name)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = frame(spark, releases[2]).select("family", F.explode(kmers("seq", 5)).alias("kmer"))
        plan = asked.join(release_seeds(spark, folder), ["family", "kmer"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the queries'


def test_bounds_leave_the_best_hits_alone(spark, releases):
    first, _, queries = releases
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    whole = word(100)
    queries = [*queries, ("A", "whole", whole)]
    first = [r for r in first if r[2] is not None] + [("A", "close", whole[:50] + "?" + whole[51:])]
    first += [("A", f"passage{i}", word(40) + whole[i : i + 20] + word(40)) for i in range(30)]
    q, members = distinct_sequences(frame(spark, queries), ["family"], 5)
    r, _ = distinct_sequences(frame(spark, first), ["family"], 5)
    r = r.withColumn("total", F.lit(4000).cast("long"))
    each = align_pairs(None, q, r, ["family"], 5, None, [F.col("q_id"), F.col("r_id")])  # a target of its own for each pair
    few = align_pairs(None, q, r, ["family"], 5, None, [F.col("q_id"), F.col("family")])
    best = lambda hits: rows_of(best_hits(hits.withColumnRenamed("r_id", "subject_id"), members, ["family"]))
    assert best(each) == best(few)
    assert few.count() <= each.count() - 30


def test_reads_are_searched_through_the_index(spark, releases, tmp_path):
    first, _, queries = releases
    folder = str(tmp_path / "index")
    create_seed_index(spark, folder, same_family=False)
    add_release(frame(spark, first), folder, "v1")
    orfs = spark.createDataFrame([(f"{a}_1", a, s) for _, a, s in queries if s], "orf_id string, read_id string, aa string")
    refs = frame(spark, [r for r in first if r[2] is not None])
    plain, indexed = search_reads(orfs, refs), search_reads(orfs, None, index=(folder, "v1"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, indexed.collect()))


def test_index_is_built_in_rounds_and_names_sequences_by_number(spark, releases, tmp_path, monkeypatch):
    from refpanel.operators import seed_index

    first, _, queries = releases
    folder = str(tmp_path / "index")
    monkeypatch.setattr(seed_index, "ROUND_LETTERS", 500, raising=False)
    create_seed_index(spark, folder, 5, False, buckets=2)
    add_release(frame(spark, first), folder, "v1")
    stored = spark.read.parquet(f"{folder}/seeds")
    assert dict(stored.dtypes)["n"] == "bigint" and "digest" not in stored.columns
    assert len(stored.inputFiles()) > 2  # rounds, each with a file for a bucket
    refs = frame(spark, [r for r in first if r[2] is not None])
    want = rows_of(similarity_join(frame(spark, queries), refs, 5, same_family=False))
    assert rows_of(indexed_search(frame(spark, queries), folder, "v1")) == want and want
