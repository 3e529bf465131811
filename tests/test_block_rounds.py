"""Blocks are searched in rounds, so copies of queries are few at a time; every cut gives the same."""

import pytest

from refpanel.operators import blocks, similarity
from tests.test_blocks import PAYLOAD, tables  # noqa: F401
from tests.test_search_plans import plans_of


@pytest.mark.parametrize("same_family", [True, False])
def test_rounds_and_slices_give_what_one_does(tables, monkeypatch, same_family):  # noqa: F811
    run = lambda: sorted(map(str, similarity.similarity_join(*tables, 5, None, same_family=same_family).select(*PAYLOAD).collect()))
    monkeypatch.setattr(similarity, "BROADCAST_KMERS", 0)
    monkeypatch.setattr(blocks, "BLOCK_LETTERS", 1500)
    searches = lambda plans: sum("MapInArrow" in p for p in plans)
    once, plans = plans_of(monkeypatch, blocks, run)
    assert searches(plans) == 1
    for name, value in (("ROUND_LETTERS", 300), ("SLICE_LETTERS", 500), ("BLOCK_LETTERS", 300)):
        monkeypatch.setattr(blocks, name, value)
    many, plans = plans_of(monkeypatch, blocks, run)
    assert many == once and len(many) > 40
    assert searches(plans) > 1


def test_a_shared_passage_is_two_places_not_all(monkeypatch):
    """Of a run of shared k-mers the first and the last are listed, whatever its length."""
    passage = "".join("ACDEFGHIKLMNPQRSTVWY"[i * i % 19] + "ACDEFGHIKLMNPQRSTVWY"[i // 19 % 20] + "ACDEFGHIKLMNPQRSTVWY"[i % 20] for i in range(300))
    block = blocks.Block(["a", "b"], ["f", "f"], ["Y" + passage, passage[5:] + "A"], 16)
    listed = []
    spread = blocks._spread
    monkeypatch.setattr(blocks, "_spread", lambda starts, sizes: listed.append(int(sizes.sum())) or spread(starts, sizes))
    seeds = block._seeds(blocks.Texts([passage + "C"]))
    listed.clear()
    rows = [list(map(int, x)) for x in zip(*next(iter(block._pairs(*seeds))))]
    assert sum(listed) == 4
    assert [r[:4] for r in rows] == [[0, 0, len(seeds[0]), len(seeds[0])], [0, 1, len(seeds[0]) - 5, len(seeds[0]) - 5]]
