import random

import pytest

from refpanel.operators.reads import tile_reads
from refpanel.operators.similarity import kmer_rows

COMPLEMENT = str.maketrans("ACGT", "TGCA")


@pytest.fixture(scope="module")
def contigs():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    sizes = [0, 1, 4, 5, 39, 40, 41, 79, 80, 81, 500, 1003]
    return [(f"c{n}", word(n)) for n in sizes] + [("lines", word(50) + "\n" + word(70)), ("null", None)]


@pytest.mark.parametrize("chunk", [1, 20, 40, 65_536])
def test_tiles_do_not_depend_on_chunks(spark, contigs, chunk):
    frame = spark.createDataFrame(contigs, "contig_id string, seq string")
    got = [(r.read_id, r.seq, r.start, r.end) for r in tile_reads(frame, [30, 45], 20, chunk).collect()]
    want = []
    for name, seq in contigs:
        for n in (30, 45):
            for i in range(0, len(seq or "") - n + 1, 20):
                cut = seq[i : i + n]
                want += [(f"{name}_{i}_{n}/1", cut, i, i + n), (f"{name}_{i}_{n}/2", cut.translate(COMPLEMENT)[::-1], i, i + n)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("chunk", [1, 7, 40, 65_536])
def test_kmers_do_not_depend_on_chunks(spark, contigs, chunk):
    frame = spark.createDataFrame(contigs, "id string, seq string")
    got = sorted(tuple(r) for r in kmer_rows(frame, ["id"], 5, chunk).collect())
    assert got == sorted((name, i, seq[i : i + 5]) for name, seq in contigs for i in range(len(seq or "") - 4))


def test_a_long_contig_is_cut_in_bounded_rows(spark):
    rng = random.Random(4)
    part = "".join(rng.choice("ACGT") for _ in range(10_007))
    seq = part * 300  # three million letters
    frame = spark.createDataFrame([("long", seq)], "contig_id string, seq string")
    tiles = tile_reads(frame, [150], 50)
    assert tiles.count() == 2 * ((len(seq) - 150) // 50 + 1)
    last = tiles.filter("mate = 1").orderBy("start", ascending=False).first()
    assert last.seq == seq[last.start : last.end]
