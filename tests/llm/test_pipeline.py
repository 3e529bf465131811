"""The pipeline and its stages, with their real models, against plain versions."""

import hashlib
import os

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from refpanel.llm import sanitise, toxicity

from . import plain

DATA = "/root/testdata/sf0.001"


def test_null_and_repeated_ids(spark, tmp_path, monkeypatch):
    text = lambda name: " ".join(f"{name}{k}" for k in range(60))
    rows = [(None, text("a"), 1), (None, text("b"), 2), (1, text("c"), 3), (1, text("d"), 4), (1, text("d"), 5), (None, text("e"), 6), (None, text("e"), 7), (2, text("f"), 8), (None, text("f"), 9), (3, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    spark.createDataFrame([(1, text("a")), (2, text("c"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = lambda stage, d=docs: sorted(r._row for r in stage(spark, d, str(tmp_path)).collect())

    assert left(corpus_pipeline.drop_contaminated) == [2, 4, 5, 6, 7, 8, 9, 10]
    kept = left(corpus_pipeline.drop_near_duplicates)
    assert {4, 5} & set(kept) and {6, 7} & set(kept) and len(kept) == 7 and {1, 2, 3, 8, 10} <= set(kept)
    monkeypatch.setattr(toxicity, "fit", lambda *a: toxicity.Model({"b": 1.0, "c": 1.0}, -9.0))
    assert left(corpus_pipeline.drop_toxic) == [1, 4, 5, 6, 7, 8, 9, 10]
    for stage in (corpus_pipeline.drop_contaminated, corpus_pipeline.drop_near_duplicates):
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns and left(stage, docs.limit(0)) == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
def test_run_is_its_stages(spark, tmp_path, monkeypatch):
    """Every stage on what the one before kept; stored tables of finished stages are gone."""
    monkeypatch.setattr("refpanel.llm.common.checkpoint_root", lambda _: str(tmp_path))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    verdict = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if not verdict[r.doc_id]]
    groups = plain.near_duplicates(rows)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, n, hit, _ in plain.contamination(rows, items) if hit and 20 * hit >= n}
    rows = [r for r in rows if r[0] not in bad]
    clean = sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for r in clean:
        ids = model.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = len(ids), hashlib.sha256(model.decode(ids).encode()).hexdigest()
    before = set(os.listdir(tmp_path))
    done = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in done.collect()} == want and 0 < len(want) < 200
    assert [f.split("-")[1] for f in set(os.listdir(tmp_path)) - before] == ["encoding"]


def test_stages_take_odd_and_empty_tables(spark, odd, nothing, tmp_path):
    spark.createDataFrame([(1, "no such passage " * 5)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 0), (5, 1), (8, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, str(tmp_path))
        assert name == "encoding" or found.columns == odd.columns
        assert 0 < found.count() <= 10 and stage(spark, nothing, str(tmp_path)).count() == 0
