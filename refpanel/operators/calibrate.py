"""Per-family score cutoffs from positive and negative scores.

Table ``scores(family, label, score)``; ``label`` is ``positive`` or ``negative``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refpanel.operators.cumulative import exact_quantile, running_totals
from refpanel.operators.metrics import f1_of

MIN_NEGATIVES = 30
NEGATIVE_PERCENTILE = 99.0


def restricted_best(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Best score of each query among hits to its own family; 0.0 when it has none.

    ``queries(family, label, query_id)``, ``hits(query_id, family, bitscore)``.
    """
    own = hits.groupBy("family", "query_id").agg(F.max("bitscore").alias("score"))
    return queries.join(own, ["family", "query_id"], "left").select(
        "family", "label", "query_id", F.coalesce("score", F.lit(0.0)).alias("score")
    )


def score_stats(scores: DataFrame) -> DataFrame:
    pos, neg = F.col("label") == "positive", F.col("label") == "negative"
    return scores.groupBy("family").agg(
        F.count_if(pos).alias("n_positive"),
        F.count_if(neg).alias("n_negative"),
        F.min(F.when(pos, F.col("score"))).alias("min_positive"),
        F.max(F.when(neg, F.col("score"))).alias("max_negative"),
    )


def f1_sweep(scores: DataFrame) -> DataFrame:
    """Cutoff (``>=``) with the best F1 per family over all distinct scores; the lowest wins a tie.

    Scores collapse to one row per distinct value, then one running total from the top gives
    the counts at every cutoff at once.
    """
    pos = (F.col("label") == "positive").cast("long")
    by_score = scores.groupBy("family", "score").agg(F.sum(pos).alias("p"), F.sum(1 - pos).alias("n"))
    sweep = running_totals(by_score, ["family"], "score", ["p", "n"], descending=True)
    f1 = F.coalesce(f1_of("cum_p", "cum_n", F.col("tot_p") - F.col("cum_p")), F.lit(0.0))
    best = sweep.groupBy("family").agg(F.min(F.struct((-f1).alias("neg_f1"), "score")).alias("b"))
    return best.select("family", F.col("b.score").alias("cutoff"), (-F.col("b.neg_f1")).alias("f1"))


def _ladder(no_negatives: Column, clean: Column) -> list[tuple[Column, Column]]:
    return [(F.col("n_positive") == 0, F.lit(0.0)), (no_negatives, F.greatest(F.col("min_positive") - 1.0, F.lit(0.0))), (clean, (F.col("max_negative") + F.col("min_positive")) / 2.0)]


def _choose(pairs: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = F.when(*pairs[0])
    for condition, value in pairs[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def calibrate(
    scores: DataFrame,
    policy: str = "f1",
    families: DataFrame | None = None,
    searched: DataFrame | None = None,
    min_negatives: int = MIN_NEGATIVES,
    percentile: float = NEGATIVE_PERCENTILE,
) -> DataFrame:
    """Cutoff and status per family.

    ``policy='f1'``: midpoint of a clean gap; highest negative + 1 with fewer than
    ``min_negatives`` negatives; else the F1 sweep. ``policy='percentile'``: midpoint, else the
    given percentile of the negatives. ``families`` lists families that may have no scores.
    ``searched`` lists families whose negatives were searched, even without a hit (f1 policy).
    """
    stats = score_stats(scores)
    if families is not None:
        stats = families.select("family").join(stats, "family", "left").fillna(0, ["n_positive", "n_negative"])
    none = F.col("n_negative") == 0
    clean = F.col("max_negative") < F.col("min_positive")
    rungs = _ladder(none, clean)
    if policy == "percentile":
        tail = exact_quantile(scores.filter(F.col("label") == "negative"), ["family"], "score", percentile / 100.0, "_tail")
        # The status names, here and below.
        status = ["no_positive_scores", "no_negatives_available", "clean_separation"]
        return stats.join(tail, "family", "left").select(
            "family",
            _choose(rungs, F.col("_tail")).alias("cutoff"),
            _choose([(c, F.lit(s)) for (c, _), s in zip(rungs, status)], F.lit("overlapping_distributions_review_needed")).alias("status"),
            "n_positive", "n_negative", "min_positive", "max_negative",
        )
    if policy != "f1":
        raise ValueError(f"unknown policy {policy!r}")
    if searched is None:
        stats = stats.withColumn("_searched", F.lit(False))
    else:
        stats = stats.join(searched.select("family").distinct().withColumn("_searched", F.lit(True)), "family", "left").fillna(False, ["_searched"])
    few = F.col("n_negative") < min_negatives
    rungs.append((few, F.col("max_negative") + 1.0))
    empty = F.when(F.col("_searched"), "clean_separation_no_negative_hits").otherwise("no_negatives_available")
    status = [F.lit("no_positive_scores"), empty, F.lit("clean_separation"), F.lit("insufficient_negative_data")]
    null = F.lit(None).cast("double")
    f1 = [null, F.when(F.col("_searched"), F.lit(1.0)), F.lit(1.0), null]
    conditions = [c for c, _ in rungs]
    return stats.join(f1_sweep(scores).select("family", F.col("cutoff").alias("_best"), F.col("f1").alias("_f1")), "family", "left").select(
        "family",
        _choose(rungs, F.col("_best")).alias("cutoff"),
        _choose(list(zip(conditions, status)), F.lit("overlapping_distributions_f1_calibrated")).alias("status"),
        _choose(list(zip(conditions, f1)), F.col("_f1")).alias("f1"),
        "n_positive", "n_negative", "min_positive", "max_negative",
    )


def check_curated_cutoff(scores: DataFrame, curated: DataFrame) -> DataFrame:
    """How a given fixed cutoff separates each family's own scores.

    ``curated(family, cutoff)``; a family with a null cutoff is calibrated by the f1 policy.
    """
    fixed = curated.filter(F.col("cutoff").isNotNull())
    pos, neg = F.col("label") == "positive", F.col("label") == "negative"
    below, above = F.col("score") < F.col("cutoff"), F.col("score") >= F.col("cutoff")
    tested = scores.join(fixed, "family").groupBy("family").agg(
        F.first("cutoff").alias("cutoff"),
        F.count_if(pos).alias("n_positive"),
        F.count_if(neg).alias("n_negative"),
        F.count_if(pos & below).alias("n_positive_below"),
        F.count_if(neg & above).alias("n_negative_above"),
        F.min(F.when(pos, F.col("score"))).alias("min_positive"),
        F.max(F.when(neg, F.col("score"))).alias("max_negative"),
    )
    clean = (F.col("n_positive_below") == 0) & (F.col("n_negative_above") == 0)
    checked = tested.select(
        "family", "cutoff",
        F.when(clean, "pfam_ga_clean").otherwise("pfam_ga_review_needed").alias("status"),
        f1_of(F.col("n_positive") - F.col("n_positive_below"), "n_negative_above", "n_positive_below").alias("f1"),
        "n_positive", "n_negative", "min_positive", "max_negative",
    )
    rest = curated.filter(F.col("cutoff").isNull()).select("family")
    return checked.unionByName(calibrate(scores.join(rest, "family", "left_semi"), "f1"))
