"""The contig of a read, looked up once for all reads that begin alike."""

from refpanel.operators.reads import assign_contig


def test_assign_contig_looks_up_beginnings(spark):
    contigs = spark.createDataFrame([("c1",), ("c12",), ("c1_2",)], "contig_id string")
    names = [f"{c}_{i}/1" for c in ("c1", "c12", "c1_2", "d7") for i in range(40)] + ["c", "c1", None]
    reads = spark.createDataFrame([(n, "A") for n in [*names, "c12_5/1"]], "read_id string, seq string")
    got = assign_contig(reads, contigs)
    want = [(n, "A", max((c for c in ("c1", "c12", "c1_2") if n and n.startswith(c)), key=len, default=None)) for n in [*names, "c12_5/1"]]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.read_id, r.seq, r.contig_id) for r in got.collect()), key=key) == sorted(want, key=key)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_head" in plan and "Aggregate [read_id" not in plan
    assert assign_contig(reads, contigs.limit(0)).filter("contig_id IS NOT NULL").isEmpty()
