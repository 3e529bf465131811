"""Search queries give the best hit of every row, however weak it is."""

import random

import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def weak(spark, tmp_path_factory):
    """Texts of 9,000 random letters; an item and a negative text share 17 letters with one of them."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    docs = [text(9000) for _ in range(9)]
    docs[3] = docs[1][500:517] + text(9000)  # doc 3 is negative, doc 1 positive
    d = str(tmp_path_factory.mktemp("weak"))
    rows = [(i, t, "en", "s1", len(t)) for i, t in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(7, text(300) + docs[4][100:117] + text(300))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_similarity_join_keeps_weak_hits(spark, weak):
    (row,) = QUERIES["similarity_join"](spark, weak).collect()
    assert (row.accession, row.subject_id, row.matches) == ("7", "4", 17)


def test_negative_purity_keeps_weak_hits(spark, weak):
    rows = {r.accession: r for r in QUERIES["negative_purity"](spark, weak).collect()}
    assert rows["3"].max_pident == 100.0 and rows["3"].flagged and rows["0"].max_pident == 0.0


def test_purity_manifest_counts_weak_hits(spark, weak):
    (row,) = QUERIES["purity_manifest"](spark, weak).collect()
    assert (row.n_total, row.n_kept, row.n_flagged) == (3, 2, 1)


def test_profile_scan_keeps_weak_hits(spark, weak):
    (row,) = QUERIES["profile_scan"](spark, weak).collect()
    assert (row.family, row.query_id, row.n_scored) == ("en", "7", 17)


def test_benchmark_cascade_takes_every_hit(spark):
    data = "/root/testdata/sf0.001"
    of = lambda name: {tuple(r) for r in QUERIES[name](spark, data).collect()}
    assert of("benchmark_cascade") == of("cascade_config")
