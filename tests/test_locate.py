"""Location of reads: dealt with their contigs, a contig's k-mers are sorted once for all of its reads."""

import random

from pyspark.sql import functions as F

from refpanel.operators import reads as rd


def plain(read, contig, k, probes):
    """Place of a read by the definition: probes in turn, each at its last place."""
    for seq in (read, read.translate(str.maketrans("ACGTNacgtn", "TGCANtgcan"))[::-1]):
        for i in range(0, len(seq) - k + 1, max(1, (len(seq) - k) // probes)) if len(seq) >= k else ():
            at = contig.rfind(seq[i : i + k])
            if at >= 0 and 0 <= at - i and at - i + len(seq) <= len(contig):
                return at - i
    return None


def test_places_equal_the_definition(spark, monkeypatch):
    """Repeats, both strands, changed letters, any characters, contigs without reads, two contigs of one id, long ones."""
    rng = random.Random(3)
    draw = lambda n, of="ACGT": "".join(rng.choice(of) for _ in range(n))
    contigs = [(f"c{i}", draw(rng.randint(5, 400)) + draw(30) * rng.randint(0, 4)) for i in range(30)]
    contigs += [("c1", draw(200)), ("odd", draw(300, "".join(map(chr, range(0x4E00, 0x4F00))) + "\U0001f9ecé")), ("none", None), (None, draw(90)), ("unread", draw(99))]
    reads = []
    for i, (name, seq) in enumerate(contigs[:32] * 12):
        at = rng.randrange(len(seq))
        cut = list(seq[at : at + rng.choice([7, 20, 60, 90])])
        cut = "".join(rng.choice("ACGT") if rng.random() < 0.03 else x for x in cut)
        reads.append((f"r{i}", name, cut if i % 2 else cut.translate(str.maketrans("ACGT", "TGCA"))[::-1], i))
    reads += [("lost", "c99", draw(80), 1), ("null", "c1", None, 2), ("free", None, draw(80), 3)]
    want = sorted((r, c, s, n, p, p + len(s)) for r, c, s, n in reads if s for name, seq in contigs if seq and name == c for p in [plain(s, seq, 9, 4)] if p is not None)
    assert len(want) > 200
    frames = spark.createDataFrame(reads, "read_id string, contig_id string, seq string, n int"), spark.createDataFrame(contigs, "contig_id string, seq string")
    for letters, long in ((2_000_000, 2_000_000), (500, 150)):
        monkeypatch.setattr(rd, "TASK_LETTERS", letters)
        monkeypatch.setattr(rd, "LONG", long)
        got = rd.locate_reads(*frames, 9, 4)
        assert got.columns == ["contig_id", "read_id", "seq", "n", "start", "end"]
        assert sorted((r.read_id, r.contig_id, r.seq, r.n, r.start, r.end) for r in got.collect()) == want


def test_a_contig_moves_once(spark):
    """A contig does not stand beside each of its reads."""
    contigs = spark.createDataFrame([("c", "ACGT" * 100)], "contig_id string, seq string")
    reads = spark.range(50).select(F.col("id").cast("string").alias("read_id"), F.lit("c").alias("contig_id"), F.lit("ACGT" * 10).alias("seq"))
    plan = rd.locate_reads(reads, contigs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "regexp_instr" not in plan and "_reversed" not in plan
