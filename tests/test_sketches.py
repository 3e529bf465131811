import random
from statistics import median

from refpanel import sources
from refpanel.operators.sketches import merged_manifest, release_sketches


def test_merged_releases_equal_one_pass(spark, tmp_path):
    """Sketches of two stored releases say together what the sequences of both do."""
    rng = random.Random(1)
    rows = [("ab"[i % 2], "positive", f"g{rng.randrange(40)}_s{rng.randrange(30)}", rng.randint(50, 900)) for i in range(6000)]
    frame = lambda r: spark.createDataFrame(r, "family string, label string, organism string, length int")
    for name, part in (("r1", rows[:2500]), ("r2", rows[2500:])):
        sources.write_release(release_sketches(frame(part)), str(tmp_path), name)
    for r in merged_manifest(spark.read.parquet(str(tmp_path))).collect():
        mine = [x for x in rows if x[0] == r.family]
        lengths = sorted(x[3] for x in mine)
        assert r.n == len(mine)
        assert abs(r.n_organisms - len({x[2] for x in mine})) <= 0.05 * r.n_organisms
        assert abs(r.n_genera - len({x[2].split("_")[0] for x in mine})) <= 1
        assert lengths[int(0.48 * len(mine))] <= r.median_length <= lengths[int(0.52 * len(mine))]
        assert abs(r.median_length - median(lengths)) < 40
    assert merged_manifest(release_sketches(frame([]))).count() == 0


def test_sinks_follow_the_config_order(spark, tmp_path):
    """Tables with ``ord`` are written in its order, however the rows lie."""
    rows = spark.createDataFrame([(f"f{k:02d}", (k * 7) % 31) for k in range(31)], "family string, ord int").repartition(5)
    sources.write_id_list(rows, f"{tmp_path}/ids")
    sources.write_tsv(rows, f"{tmp_path}/tsv")
    want = [f"f{k:02d}" for k in sorted(range(31), key=lambda k: (k * 7) % 31)]
    lines = lambda d: [x for f in sorted((tmp_path / d).glob("part-*")) for x in f.read_text().splitlines() if not x.startswith("family")]
    assert lines("ids") == want and [x.split("\t")[0] for x in lines("tsv")] == want
