"""Operators that look at a whole corpus, against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest

from refpanel.llm import decontaminate, near_dedup, ngram, quality_rank, revisits, toxicity
from refpanel.llm.components import components

from . import plain

SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku".split()


def prose(draw, n):
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 3))) for _ in range(n))


def edited(draw, text, n):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_components(spark):
    draw = random.Random(1)
    links = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [tuple(draw.sample(range(2000, 2200), 2)) for _ in range(150)] + [(5, 5)]
    want = plain.components(links, {n for ab in links for n in ab if ab[0] != ab[1]})
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [256, 16])
def test_near_duplicates(spark, monkeypatch, block):
    """Copies, near copies around the threshold and chains; small blocks take the block pairs."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    draw = random.Random(7)
    base = prose(draw, 150)
    docs = [edited(draw, base, draw.randint(0, 9)) for _ in range(90)]
    docs += [prose(draw, 40) for _ in range(40)] + [base.upper()] * 3 + ["", " \n", "one", "One", "two three", "x " * 400]
    chain = prose(draw, 120)
    for _ in range(12):
        chain = edited(draw, chain, 2)
        docs.append(chain)
    docs = list(enumerate(docs))
    draw.shuffle(docs)
    want = plain.near_duplicates(docs)
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicate_rows(odd, nothing):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == 10 and all(r.kept for r in rows)  # a repeated row is one document
    assert {r.n_shingles for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_minmax_estimates_without_bias():
    draw = np.random.default_rng(5)
    agree = []
    for _ in range(60):
        both, left, right = (draw.integers(0, 2**63, n, np.uint64) for n in (80, 10, 10))
        p = [np.concatenate([both, x])[:, None] * near_dedup._ODD + near_dedup._ADD for x in (left, right)]
        agree.append(np.mean([p[0].min(axis=0) == p[1].min(axis=0), p[0].max(axis=0) == p[1].max(axis=0)]))
    assert abs(np.mean(agree) - 0.8) < 0.02


@pytest.mark.parametrize("segment, block", [(400_000, 1_000_000), (200, 60)])
def test_contamination(spark, monkeypatch, segment, block):
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", segment)
    draw = random.Random(9)
    items = [(k, prose(draw, draw.choice([3, 12, 13, 14, 40]))) for k in range(25)] + [(None, prose(draw, 20)), (3, "du du"), (99, None), (98, "?!")]
    docs = []
    for k in range(120):
        text = prose(draw, draw.randint(0, 60))
        if k % 3 == 0:
            words = draw.choice(items[:26])[1].split()
            a = draw.randint(0, max(0, len(words) - 13))
            text = f"{text} {'-'.join(words[a:]).upper()} {prose(draw, draw.randint(0, 30))}"
        docs.append((k, text))
    docs += [(500, None), (501, ""), (5, docs[5][1])]
    rows = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_words=block)
    got = sorted((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in rows.collect())
    assert got == sorted((i, n, h, found, h > 0 and 20 * h >= n) for i, n, h, found in plain.contamination(docs, items))


def test_proximity_matches(spark):
    """In order, with up to two words between: exact, one gap, two gaps; three gaps and swaps fail."""
    phrase = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11 l12 m13".split()
    make = lambda gaps: " ".join(w for k, p in enumerate(phrase) for w in [p, *["zz"] * gaps.count(k)])
    docs = [(0, make([])), (1, make([4])), (2, make([0, 11])), (3, make([3, 3, 7])), (4, " ".join([*phrase[1::-1], *phrase[2:]]))]
    index = decontaminate.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    items = spark.createDataFrame([(7, " ".join(phrase))], "item_id long, text string")
    order = index.selectExpr("segment", "posexplode(ids) as (doc, id)").collect()
    by_id = {}
    for r in decontaminate.find(index, items, slop=2).collect():
        by_id[next(o.id for o in order if (o.segment, o.doc) == (r.segment, r.doc))] = (r["items"], r.near_items)
    assert by_id == {0: (["7"], []), 1: ([], ["7"]), 2: ([], ["7"])}


def test_contamination_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "the quick brown fox"), (2, None)], "item_id long, text string")
    rows = decontaminate.contamination(odd, items).collect()
    assert [r.doc_id for r in rows if r.contaminated] == [1, 1] and len(rows) == 10
    assert decontaminate.contamination(nothing, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd, items.limit(0)).collect())


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(spark, order):
    draw = random.Random(order)
    texts = [prose(draw, draw.randint(0, 25)) for _ in range(80)]
    heard = [*texts[:60], "unheard words here", "", texts[0]]
    docs = spark.createDataFrame(list(enumerate(heard)), "doc_id long, text string")
    model = ngram.train(spark.createDataFrame([(t,) for t in texts], "text string"), order=order)
    p, vocabulary = plain.kneser_ney(texts, order, lambda n: ngram.discounts(np.array(n)))
    assert model.types == len(vocabulary) and model.tokens == sum(len(t.split()) + 1 for t in texts)
    for r in ngram.score(docs, model).collect():
        words, total = [*heard[r.doc_id].split(), None], 0.0
        line = ["<s>"] * (order - 1) + words
        for k in range(len(words)):
            total += math.log10(p(tuple(line[k : k + order - 1]), line[k + order - 1]))
        assert r.n_tokens == len(words) and r.n_known == sum(w in vocabulary for w in words)
        assert r.score == pytest.approx(total, rel=1e-9)
    for context in itertools.product(["<s>", "ba", "never"], repeat=order - 1):
        assert sum(p(context, w) for w in [*vocabulary, "never"]) == pytest.approx(1)


def test_language_model_query_sees_two_words_before(spark, tmp_path, monkeypatch):
    """The registered query trains trigrams at least."""
    from refpanel.llm import workload

    orders, train = [], ngram.train
    monkeypatch.setattr(ngram, "train", lambda docs, **given: orders.append((m := train(docs, **given)).order) or m)
    spark.createDataFrame([(k, f"a b c{k}") for k in range(20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert workload.op1_kneser_ney(spark, str(tmp_path)).count() == 20 and orders[0] >= 3


def test_language_model_takes_few_bytes(spark, tmp_path):
    """A file entry of an n-gram is a number and a byte; counts that need more are as exact."""
    draw = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(draw.choices(words, k=200)) for _ in range(150)] + ["often so often"] * 300
    model = ngram.train(spark.createDataFrame([(t,) for t in texts], "text string"), order=3, folder=str(tmp_path / "model"))
    grams = {tuple(line[k - n + 1 : k + 1]) for t in texts for line in [["<s>", "<s>", *t.split(), None]] for n in (1, 2, 3) for k in range(2, len(line))}
    assert sum(f.stat().st_size for f in (tmp_path / "model").iterdir()) < 24 * len(grams)
    row = ngram.score(spark.createDataFrame([(1, "often so often")], "doc_id long, text string"), model).first()
    p, _ = plain.kneser_ney(texts, 3, lambda n: ngram.discounts(np.array(n)))
    line = ["<s>", "<s>", "often", "so", "often", None]
    assert row.score == pytest.approx(sum(math.log10(p(tuple(line[k - 2 : k]), line[k])) for k in range(2, 6)), rel=1e-9)


def test_language_model_rows(odd, nothing):
    model = ngram.train(odd)
    rows = ngram.score(odd, model).collect()
    assert len(rows) == 10 and all(r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    none = ngram.train(nothing)
    assert none.tokens == none.types == 0 and {r.score for r in ngram.score(odd, none).collect()} == {0.0}
    assert ngram.score(nothing, model).count() == 0


def test_hashes_are_sparks(spark):
    rows = [(0, 1), (-5, 2**62), (-(2**63), 7), (123456789, -1)]
    want = [r.h for r in spark.createDataFrame(rows, "a long, b long").selectExpr("xxhash64(a, b) AS h").collect()]
    assert ngram.hash_ids([np.array(c) for c in zip(*rows)]).tolist() == want


def labelled(spark, seed, words, bad):
    draw = random.Random(seed)
    docs, labels = [], []
    for k in range(600):
        text = prose(draw, draw.randint(20, 80))
        mark = k % 4 == 0
        if mark:
            text = bad(draw, text)
        docs.append((k, text))
        labels.append((k, int(mark)))
    return spark.createDataFrame(docs, "doc_id long, text string"), labels


def _auc(rows, labels):
    truth = dict(labels)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held for b, z in held if y > z]
    assert len(held) > 80
    return sum(pairs) / len(pairs)


def test_toxicity(spark, odd, nothing):
    def insulted(draw, text):
        words = text.split()
        for _ in range(1 + len(words) // 20):
            words.insert(draw.randrange(len(words)), draw.choice(["grumba", "zwackel", "Idiot", "plonkish"]))
        return " ".join(words)

    docs, labels = labelled(spark, 3, None, insulted)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = toxicity.score(docs, model).collect()
    assert _auc(rows, labels) > 0.97
    assert sum(r.predicted != dict(labels)[r.doc_id] for r in rows if r.held_out) < 6
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len(toxicity.score(odd, model).collect()) == 10 and toxicity.score(nothing, model).count() == 0
    assert toxicity.fit(nothing, spark.createDataFrame(labels, "doc_id long, toxic int")) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}


def test_label_model_discounts_copies():
    """Voters that always agree beyond the class count less than one that is independent."""
    draw = np.random.default_rng(2)
    y = draw.random(20_000) < 0.1
    vote = lambda: np.where(y, draw.random(len(y)) < 0.7, draw.random(len(y)) < 0.02)
    one, two = vote(), vote()
    votes = np.zeros((len(y), toxicity.VOTERS), int)
    votes[:, 0], votes[:, 1], votes[:, 2], votes[:, 3] = 2 * one, 2 * one, 2 * one, 2 * two
    codes, counts = np.unique(votes @ 3 ** np.arange(toxicity.VOTERS), return_counts=True)
    model = toxicity.LabelModel(codes, counts, 0.1)
    assert model.weight[0] < 0.6 < model.weight[3]
    assert model.correlation[0, 1] > 0.9 > abs(model.correlation[0, 3])


def test_quality_ranking(spark, odd, nothing):
    docs, labels = labelled(spark, 4, None, lambda draw, text: "".join(f"{w}{draw.choice('#$%|')} " for w in text.split()))
    labels = [(k, 1 - v) for k, v in labels]
    model = quality_rank.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = quality_rank.score(docs, model).collect()
    assert _auc(rows, labels) > 0.99
    assert sum(r.predicted != dict(labels)[r.doc_id] for r in rows) < 12
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len(quality_rank.score(odd, model).collect()) == 10 and quality_rank.score(nothing, model).count() == 0
    assert {round(r.score, 12) for r in quality_rank.score(odd, None).collect()} == {0.3}


def test_revisits(spark):
    response, revisit = ("response", 200), ("revisit", 304)
    rows = [
        (1, "HTTP://Example.org:80/a?utm_x=1&b=2&a=1#f", 10.0, *response, {"etag": 'W/"1"', "content-type": "text/html", "date": "d1"}, "one"),
        (2, "http://example.org/a?a=1&b=2", 20.0, *revisit, {"etag": '"1"', "content-type": "x", "date": "d2", "age": "3"}, None),
        (3, "http://example.org/a?a=1&b=2", 5.0, *revisit, {"etag": '"1"'}, None),
        (4, "http://example.org/a?a=1&b=2", 30.0, "response", 503, {}, "down"),
        (5, "http://example.org/a?a=1&b=2", 40.0, *response, {"last-modified": "m2"}, "two"),
        (6, "http://example.org/a?a=1&b=2", 40.0, *revisit, {"last-modified": "m2"}, None),
        (7, "http://example.org/a?a=1&b=2", 50.0, *revisit, {"last-modified": "m1"}, None),
        (8, "http://example.org/a?a=1&b=2", 60.0, *revisit, None, None),
        (9, None, 60.0, *revisit, {}, None),
        (10, "https://example.org", None, *revisit, {}, None),
    ]
    schema = "record_id long, url string, ts double, kind string, status int, headers map<string,string>, payload string"
    found = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert {k: (r.source_id, r.outcome) for k, r in found.items()} == {
        2: (1, "resolved"), 3: (None, "no_response"), 6: (5, "resolved"), 7: (None, "changed"), 8: (5, "resolved"), 9: (None, "no_response"), 10: (None, "no_response"),
    }
    assert found[2].headers == {"etag": '"1"', "content-type": "text/html", "date": "d2", "age": "3"} and found[2].payload == "one"
    assert found[2].url == "http://example.org/a?a=1&b=2" and found[10].url == "https://example.org/"
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_latest_before(spark, slices):
    draw = random.Random(slices)
    rows = [(draw.choice([1, 1, 1, 2, 3]), float(draw.randrange(50)), k, draw.random() < 0.3) for k in range(400)]
    found = revisits.latest_before(spark.createDataFrame(rows, "key long, ts double, id long, full boolean"), slices)
    for r in found.collect():
        key, ts = rows[r.id][:2]
        assert r.source == max(((t, i) for k, t, i, full in rows if full and k == key and (t, i) < (ts, r.id)), default=(0, None))[1]
