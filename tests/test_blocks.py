"""Many queries: pairs are compared block by block, no row is made for a shared k-mer."""

import random

import pytest

from refpanel.operators import blocks, similarity
from tests.test_search_plans import plans_of

PAYLOAD = ["family", "accession", "subject_id", "shared", "seeds", "diag", "q_start", "span", "matches", "q_len", "r_len", "pident", "identity", "bitscore", "evalue"]


@pytest.fixture(scope="module")
def tables(spark):
    """Variants, copies, ties, passages that many rows share, odd letters, short and missing texts."""
    rng = random.Random(7)
    draw = lambda n: "".join(rng.choice("ACDEF") for _ in range(n))
    rows, passage = [], draw(40)
    for f in "abc":
        seeds = [draw(rng.randint(20, 120)) for _ in range(6)]
        for i in range(30):
            seq = "".join(rng.choice("ACDEF") if rng.random() < 0.05 else x for x in rng.choice(seeds))
            rows.append((f, f"{f}{i}", seq + passage * (i % 4 == 0) + "\U0001f9ecé" * (i % 5 == 0)))
        rows += [(f, f"{f}copy{i}", rows[-1][2]) for i in range(3)] + [(f, f"{f}short", "ACD"), (f, f"{f}none", None), (f, f"{f}empty", "")]
    frame = lambda some: spark.createDataFrame(some, "family string, accession string, seq string")
    return frame(rows[::2] + [("lone", "x", draw(50))]), frame(rows[1::2])


@pytest.mark.parametrize("same_family", [True, False])
@pytest.mark.parametrize("evalue", [None, 0.001])
def test_blocks_give_what_seeds_give(tables, monkeypatch, same_family, evalue):
    run = lambda: sorted(map(str, similarity.similarity_join(*tables, 5, evalue, same_family=same_family).select(*PAYLOAD).collect()))
    few, plans = plans_of(monkeypatch, similarity, run)
    assert any("kmer" in p for p in plans)
    monkeypatch.setattr(similarity, "BROADCAST_KMERS", 0)
    for block, batch, limit in ((5_000_000, 500_000, 2_000_000), (2000, 150, 30)):
        for name, value in (("BLOCK_LETTERS", block), ("QUERY_LETTERS", batch), ("LIMIT", limit)):
            monkeypatch.setattr(blocks, name, value)
        many, plans = plans_of(monkeypatch, similarity, run)
        assert many == few and len(many) > 40
        assert not any("kmer" in p for p in plans)
