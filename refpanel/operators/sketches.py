"""Diversity and median length from sketches that are stored by release and merged.

A release adds its own sketches once; what several releases hold together is merged from those few
rows, without reading their sequences again. Distinct counts are within about 2 % (a relative
standard error of 1.6 % at 2**12 registers), medians within about 1 % of the ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.functions import genus_of

REGISTERS = 12
QUANTILE_K = 400


def release_sketches(seqs: DataFrame) -> DataFrame:
    """``family, label, n, organisms, genera, lengths`` of ``seqs(family, label, organism, length)``:
    the row count and three sketches, small enough to keep beside every release."""
    return seqs.groupBy("family", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg("organism", REGISTERS).alias("organisms"),
        F.hll_sketch_agg(genus_of("organism"), REGISTERS).alias("genera"),
        F.kll_sketch_agg_bigint(F.col("length").cast("long"), F.lit(QUANTILE_K)).alias("lengths"),
    )


def merged_manifest(sketches: DataFrame) -> DataFrame:
    """``family, label, n, n_organisms, n_genera, median_length`` over all rows of ``sketches``, one for
    each release; distinct counts and medians are estimates."""
    one = sketches.groupBy("family", "label").agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("organisms")).alias("n_organisms"),
        F.hll_sketch_estimate(F.hll_union_agg("genera")).alias("n_genera"),
        F.kll_merge_agg_bigint("lengths").alias("_l"),
    )
    return one.withColumn("median_length", F.kll_sketch_get_quantile_bigint("_l", F.lit(0.5))).drop("_l")
