"""Running totals, exact quantiles and n-th rows that do not put one key in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refpanel.functions.ordering import hash_bucket, score_bucket


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: str,
    measures: list[str],
    descending: bool = False,
    bucket: Callable[[Column], Column] = score_bucket,
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive running sum) and ``tot_<m>`` for each measure.

    ``df`` holds one row per (keys, order). Rows are cut into order-preserving buckets; bucket
    totals (a few thousand rows per key) give each bucket its starting value, and the window
    runs inside (keys, bucket). A key with a third of all rows is spread over its buckets.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    rows = df.withColumn("_bucket", bucket(F.col(order)))
    before = Window.partitionBy(*keys).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    starts = rows.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    starts = starts.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_t_{m}").over(whole).alias(f"tot_{m}") for m in measures],
    )
    return rows.join(starts, [*keys, "_bucket"]).select(
        *df.columns,
        *[(F.sum(m).over(inside) + F.col(f"_o_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"tot_{m}" for m in measures],
    )


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, name: str) -> DataFrame:
    """Exact quantile with linear interpolation per key, over a histogram of distinct values."""
    histogram = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(histogram, keys, value, ["_n"])
    position = F.lit(float(q)) * (F.col("tot__n") - 1)
    ranked = ranked.withColumn("_pos", position)
    picked = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("cum__n") > F.floor("_pos"), F.col(value))).cast("double").alias("_lo"),
        F.min(F.when(F.col("cum__n") > F.ceil("_pos"), F.col(value))).cast("double").alias("_hi"),
        F.max("_pos").alias("_pos"),
    )
    return picked.select(
        *keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))).alias(name)
    )


def nth_digest(
    df: DataFrame, keys: list[str], digest: str, n_of: Callable[[Column], Column], name: str
) -> DataFrame:
    """The n-th smallest digest per key, ``n`` computed by ``n_of`` from the key's row count.

    Counts per 12-bit digest bucket locate the one bucket that holds the n-th row; only that
    bucket's rows (1/4096 of the key) are sorted. A null ``n`` gives no row for the key.
    """
    rows = df.select(*keys, digest).withColumn("_bucket", hash_bucket(F.col(digest)))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    target = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_end", F.sum("_c").over(upto))
        .withColumn("_n", n_of(F.sum("_c").over(Window.partitionBy(*keys))))
        .filter((F.col("_end") >= F.col("_n")) & (F.col("_end") - F.col("_c") < F.col("_n")))
        .select(*keys, "_bucket", (F.col("_n") - F.col("_end") + F.col("_c")).alias("_rank"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(digest)
    return (
        rows.join(target, [*keys, "_bucket"])
        .withColumn("_rn", F.row_number().over(inside))
        .filter(F.col("_rn") == F.col("_rank"))
        .select(*keys, F.col(digest).alias(name))
    )
