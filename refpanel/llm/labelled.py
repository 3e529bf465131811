"""What the two trained document scorers share: training rows, term counts, logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refpanel.llm.common import store


def held_out(id_col: str, parts: int = 5, part: int = 0) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % parts == part


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``label, text`` of at most ``rows`` labelled rows, chosen by the hash of their id, none held out.

    The bound is that of the classifier's sample; the ids are bounded, so the join broadcasts them.
    A null label is no label; of several labels of an id the largest counts.
    """
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    marked = marked.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col)).cast("int").alias("label"))
    chosen = store(marked.orderBy(F.xxhash64("_id"), "_id").limit(rows), "sample")
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return store(texts.join(F.broadcast(chosen), "_id").select("label", "text"), "training")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def minimise(gradient, size: int, steps: int = 300, rate: float = 0.1) -> np.ndarray:
    """Adam on a full-batch gradient."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w
