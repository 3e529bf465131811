"""Six-frame translation in batches against a plain one, and its speed on many reads."""

import random
import time

from pyspark.sql import functions as F

from refpanel.functions.sequence import GENETIC_CODE
from refpanel.operators import reads as rd


def plain(name, seq, min_aa):
    codon = lambda c: GENETIC_CODE[16 * "TCAG".index(c[0]) + 4 * "TCAG".index(c[1]) + "TCAG".index(c[2])] if set(c) <= set("TCAG") else "X"
    back = seq.translate(str.maketrans("ACGTNacgtn", "TGCANtgcan"))[::-1]
    for add, strand in ((0, seq), (3, back)):
        for f in (1, 2, 3):
            s, n, at = strand[f - 1 :].upper(), 0, f
            for part in "".join(codon(s[i : i + 3]) for i in range(0, len(s) - 2, 3)).split("*"):
                if len(part) >= min_aa:
                    n += 1
                    yield f"{name}_{at}_{f + add}_{n}", name, f + add, at, part
                at += 3 * (len(part) + 1)


def test_orfs_equal_plain(spark, monkeypatch):
    rng = random.Random(8)
    seqs = ["".join(rng.choice("ACGTacgtNxé") if rng.random() < 0.03 else rng.choice("ACGT") for _ in range(n)) for n in (0, 1, 2, 3, 5, 60, 61, 62, 400, 900)]
    rows = [(f"r{i}/1", s) for i, s in enumerate(seqs)]
    frame = spark.createDataFrame([*rows, ("none", None)], "read_id string, seq string")
    for min_aa in (0, 1, 7):
        want = sorted(o for r in rows for o in plain(*r, min_aa))
        assert sorted(tuple(o) for o in rd.translate_orfs(frame, min_aa).collect()) == want
    assert [b - a for a, b in rd._spans(["x" * rd.CHUNK, "y", "z"])] == [1, 2]


def test_orfs_of_many_reads(spark):
    """An expression evaluated for each codon took 13 s for a third of these."""
    rng = random.Random(9)
    seq = "".join(rng.choice("ACGT") for _ in range(150))
    many = spark.range(0, 300_000, 1, 8).select(F.col("id").cast("string").alias("read_id"), F.lit(seq).alias("seq"))
    start = time.perf_counter()
    assert rd.translate_orfs(many, 20).count() == 300_000 * sum(1 for _ in plain("r", seq, 20))
    assert time.perf_counter() - start < 20
