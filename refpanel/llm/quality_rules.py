"""Quality rules whose thresholds come from quantile sketches per language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import Cache, hash_cache, store, texts_of

SYMBOLS = b"#*$%&|<>"
#: Quantile sketch size: rank error about 1 %.
SKETCH_K = 400
#: Traits that few texts show, bounded by a multiple of a high quantile of their group, and the least
#: bound as a count in a text of the group's median length: no share is finer than one word, and the
#: least repetition takes six. Name, quantile, multiple, least count.
TAIL_RULES = (
    ("symbols_per_word", 0.98, 2.0, 1),
    ("repeated_share", 0.98, 2.0, 6),
    ("dup_line_share", 0.98, 2.0, 1),
    ("shouting_share", 0.98, 2.0, 1),
)
#: Distances between its group's quartiles that the mean word length may lie below and above them.
WORD_FENCE = (3.0, 4.0)
_GRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def measures(text: bytes, numbers: Cache) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_shouted of one UTF-8 text."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    repeated = 0
    if n >= 3:
        w = np.fromiter(map(numbers.__getitem__, words), np.uint64, n)
        gram = (w[:-2] * _GRAM[0] + w[1:-1]) * _GRAM[1] + w[2:]
        order = np.argsort(gram, kind="stable")
        same = gram[order][1:] == gram[order][:-1]
        if same.any():
            again = np.zeros(n, bool)
            at = np.concatenate([order[1:][same], order[:-1][same]])
            again[at] = again[at + 1] = again[at + 2] = True
            repeated = int(again.sum())
    shouted = sum(x.isupper() and len(x) > 1 for x in words)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, shouted


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Counts of every row's whole text, with its groups; a null text has no words."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouted")
    groups = [F.col(c).cast("string").alias(f"_g{k}") for k, c in enumerate(group_cols)]
    rows = docs.select(F.col(id_col).alias(id_col), *groups, F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], *(T.StructField(n, T.LongType()) for n in names)])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = hash_cache()
        for batch in batches:
            values = np.array([measures(t, numbers) for t in texts_of(batch, "_text")], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(v) for v in values.T)], schema.names)
            numbers.trim()

    return rows.mapInArrow(counted, schema)


def _ratios() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "repeated_share": F.col("n_repeat_words") / n,
        "dup_line_share": F.col("n_dup_lines") / n,
        "shouting_share": F.col("n_shouted") / n,
        "word_chars_mean": F.col("word_chars") / n,
    }


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def thresholds(measured: DataFrame, group_cols: list[str], k: int = SKETCH_K) -> DataFrame:
    """One row per group with the bounds ``max_`` of each ratio and ``min_word_chars_mean``, read from
    sketches that tasks build over their rows and merge by group.

    Rows that fail the base rule are not part of the sketches, so what a group calls usual does not
    depend on how much of that it holds. ``floor_`` tells where the least count was the bound."""
    ratios = _ratios()
    names = [r for r, *_ in TAIL_RULES] + ["word_chars_mean"]
    sketches = [F.kll_sketch_agg_double(ratios[r], F.lit(k)).alias(r) for r in names]
    sketches.append(F.kll_sketch_agg_double(F.col("n_words").cast("double"), F.lit(k)).alias("_words"))
    at = lambda r, q: F.kll_sketch_get_quantile_double(r, F.lit(q))
    one = F.lit(1.0) / at("_words", 0.5)
    bounds = []
    for r, quantile, times, least in TAIL_RULES:
        bounds.append(F.greatest(times * at(r, quantile), least * one).alias(f"max_{r}"))
        bounds.append((times * at(r, quantile) < least * one).alias(f"floor_{r}"))
    low, high = at("word_chars_mean", 0.25), at("word_chars_mean", 0.75)
    spread = F.greatest(high - low, one)
    bounds += [(low - WORD_FENCE[0] * spread).alias("min_word_chars_mean"), (high + WORD_FENCE[1] * spread).alias("max_word_chars_mean")]
    return measured.filter(~_base_failed()).groupBy(*group_cols).agg(*sketches).select(*group_cols, *bounds)


def filter_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per input row: the counts, ``base_failed`` (under 50 words, or over half of them
    repeated) and ``kept`` (not failed and within all bounds of its language and source).

    A null language or source is a group of its own. Empty and null texts fail the base rule.
    """
    measured = store(measure(docs, id_col, text_col, group_cols), "measures")
    keys = [f"_g{k}" for k in range(len(group_cols))]
    bounds = store(thresholds(measured, keys), "bounds")
    renamed = bounds.select(*(F.col(c).alias(f"{c}b") for c in keys), *(c for c in bounds.columns if c not in keys))
    same = [F.col(c).eqNullSafe(F.col(f"{c}b")) for c in keys]
    within = F.lit(True)
    for r, column in _ratios().items():
        within = within & (column <= F.col(f"max_{r}"))
    within = within & (_ratios()["word_chars_mean"] >= F.col("min_word_chars_mean"))
    return measured.join(renamed, same, "left").select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", _base_failed().alias("base_failed"), (~_base_failed() & F.coalesce(within, F.lit(True))).alias("kept")
    )
