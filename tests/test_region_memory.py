"""Region bins are dealt with the reads: no task holds all of them."""

from refpanel.operators import regions as rg


def test_bins_are_not_broadcast(spark):
    reads = spark.createDataFrame([("r1", "c", 100, 249), ("r2", "c", 90_000, 90_149)], "read_id string, contig string, start long, end long")
    regions = spark.createDataFrame([("f", "c", 1, 80_000, 1)], "family string, contig string, start long, end long, ord long")
    found = rg.overlap_regions(reads, regions)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.read_id: r.family for r in found.collect()} == {"r1": "f", "r2": "background"}
