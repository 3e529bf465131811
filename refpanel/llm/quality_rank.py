"""Document quality by Bradley-Terry ranking.

Of two documents the better one is preferred with the logistic probability of their difference in
score; scores are linear in features of the text and learned from preference pairs. A quantile of
the scores of all documents is the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import store
from refpanel.llm.labelled import held_out, minimise, sigmoid, training_rows

#: Labelled rows that the ranking is fitted on, at most.
TRAINING_ROWS = 20_000
#: Preference pairs for each document of the rarer label.
PAIRS_EACH = 20
#: The score that a document at the threshold gets.
AT_THRESHOLD = 0.3
_NO_SYMBOLS = str.maketrans("", "", "#*$%&|<>")
_SHARES = 14


def features(text: str) -> list[float]:
    """Shares and logarithms that describe how a text is written; an empty text has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 2 * _SHARES
    lines = [x for x in text.split("\n") if x.strip()]
    triples = list(zip(words, words[1:], words[2:]))
    upper = sum(map(str.isupper, words))
    shares = [
        math.log(n) / 10,
        (len(text) - len(text.translate(_NO_SYMBOLS))) / n,
        text.count("|") / n,
        text.count("!") / n,
        upper / n,
        1 - len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(triples)) / max(len(triples), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(map(len, words)) / n / 10,
        sum(w[-1] in ".,;:?" for w in words) / n,
        sum(w[-1] in ".?!" for w in words) / n,
        sum(map(str.isdigit, words)) / n,
        math.log(n / max(len(lines), 1)) / 10,
    ]
    return shares + [math.sqrt(abs(x)) for x in shares]


class Ranking:
    """Weights over standardised features; ``raw`` is the Bradley-Terry score."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, worse_share: float):
        self.mean, self.scale, self.weights, self.worse_share = mean, scale, weights, worse_share

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale).clip(-8, 8) @ self.weights


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), rows], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Ranking | None:
    """Ranking learned from pairs of a better and a worse labelled document; None without any pair."""
    training = training_rows(docs, labels, label_col, rows, id_col, text_col)
    sample = training.mapInArrow(_described, "label int, x array<double>").toArrow()
    y = sample["label"].to_numpy() != 0
    if not y.any() or y.all():
        return None
    x = np.array(sample["x"].to_pylist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = ((x - mean) / scale).clip(-8, 8)
    better, worse = np.flatnonzero(y), np.flatnonzero(~y)
    draw = np.random.default_rng(1)
    pairs = PAIRS_EACH * min(len(better), len(worse))
    difference = z[draw.choice(better, pairs)] - z[draw.choice(worse, pairs)]

    def gradient(w: np.ndarray) -> np.ndarray:
        return -difference.T @ sigmoid(-difference @ w) / pairs + 1e-3 * w

    return Ranking(mean, scale, minimise(gradient, z.shape[1], steps=400, rate=0.05), 1 - y.mean())


def score(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``held_out``, ``score`` (0 to 1) and ``predicted`` (score of 0.3 or more) of every row.

    The score is the logistic function of the Bradley-Terry score, shifted so that the quantile at
    the share of worse training documents, taken over all documents, gets exactly 0.3. Null and
    empty texts are scored by their (zero) features; without a model every score is 0.3.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("raw", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t or "") for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.raw(rows) if model else np.zeros(len(rows)))], schema.names)

    raw = store(docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(scored, schema), "scores")
    share = float(model.worse_share) if model else 0.5
    cut = raw.select(F.percentile_approx("raw", F.lit(share), F.lit(100_000)).alias("cut")).first()["cut"] or 0.0
    at = F.lit(math.log(AT_THRESHOLD / (1 - AT_THRESHOLD)))
    passed = F.col("raw") >= cut
    value = 1 / (1 + F.exp(-(F.col("raw") - cut + at)))
    value = F.when(passed, F.greatest(value, F.lit(AT_THRESHOLD))).otherwise(value)
    return raw.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), value.alias("score"), (value >= AT_THRESHOLD).cast("int").alias("predicted"))
