"""Scoring of calls against read truth: best hits, precision/recall, sweeps, curves, cascade.

Tables: ``hits(method, sample, read_id, subject_id, family, pident, qcov, scov, bitscore)``,
``truth(read_id, family, label, overlaps_cds, read_length)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refpanel.operators.cumulative import running_totals
from refpanel.session import materialize

NO_CALL = "NO_CALL"
BACKGROUND = "background"
METHODS = ("search", "profile")


def ratio(num, den) -> Column:
    """``num / den`` as double, null when the denominator is 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def f1_of(tp, fp, fn) -> Column:
    """F1 in one division; null when precision or recall is 0 or undefined (that is, tp = 0)."""
    tp, fp, fn = (F.col(c) if isinstance(c, str) else c for c in (tp, fp, fn))
    return F.when(tp > 0, (2.0 * tp) / (2 * tp + fp + fn))


def filter_hits(hits: DataFrame, min_identity: float = 0.40, min_qcov: float = 0.50, min_scov: float = 0.0) -> DataFrame:
    """Hits with at least the given identity, query cover and subject cover (fractions, inclusive).

    A value that a truncated row lacks passes a bound of 0 and no other.
    """
    bounds = {"pident": min_identity, "qcov": min_qcov, "scov": min_scov}
    reached = [F.coalesce(F.col(c) >= bound, F.lit(bound <= 0)) for c, bound in bounds.items()]
    return hits.filter(reached[0] & reached[1] & reached[2])


def best_hit(hits: DataFrame, keys: tuple[str, ...] = ("method", "sample", "read_id")) -> DataFrame:
    """One hit per read: highest bitscore, then family, then subject id, then the other columns.

    A hit without a score is taken only where the read has no other.
    ``min`` over an ordered struct, so each map task already reduces its reads; no window.
    """
    rest = [c for c in hits.columns if c not in {*keys, "bitscore", "family", "subject_id"}]
    lead = [c for c in ("family", "subject_id") if c in hits.columns]
    order = F.struct(F.col("bitscore").isNull().alias("_none"), (-F.col("bitscore")).alias("_neg"), *lead, *rest)
    top = hits.groupBy(*keys).agg(F.min(order).alias("_top"))
    return top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in (*lead, *rest)], (-F.col("_top._neg")).alias("bitscore"))


def label_reads(
    calls: DataFrame, truth: DataFrame, methods: tuple[str, ...] = METHODS, with_score: bool = True
) -> DataFrame:
    """Truth left-joined to the best calls of each method.

    Every truth row is kept once per method; a read without a call gets ``NO_CALL`` and a
    score one below the lowest score among called reads. The join is on ``read_id`` unless
    ``truth`` carries a ``sample``. ``with_score=False`` leaves missing scores null and saves
    the second pass that finds the lowest one.
    """
    on = ["read_id", "sample"] if "sample" in truth.columns else ["read_id"]
    called = calls.select("method", *on, F.col("family").alias("family_called"), "bitscore")
    merged = (
        truth.withColumnRenamed("family", "family_true")
        .withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
        .join(called, ["method", *on], "left")
        .withColumn("family_called", F.coalesce("family_called", F.lit(NO_CALL)))
        .withColumn("genuine", (F.col("label") == "positive") & F.col("overlaps_cds").cast("boolean"))
        .withColumn("correct", F.col("genuine") & (F.col("family_called") == F.col("family_true")))
    )
    if not with_score:
        return merged
    # One row with the lowest score of each method, as a scalar subquery: no join on a two-value key.
    lowest = merged.agg(
        F.struct(*[F.min(F.when(F.col("method") == m, F.col("bitscore"))).alias(m) for m in methods])
    ).scalar()
    floor = F.coalesce(*[F.when(F.col("method") == m, lowest[m] - 1.0) for m in methods], F.lit(-1.0))
    return merged.withColumn("bitscore", F.coalesce("bitscore", floor))


def _counts() -> list[Column]:
    called_own = F.col("family_called") == F.col("family_true")
    return [
        F.count_if(called_own & F.col("genuine")).alias("tp"),
        F.count_if(called_own & ~F.col("genuine")).alias("fp"),
        F.count_if(~called_own & F.col("genuine")).alias("fn"),
    ]


def _rates(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("precision", ratio("tp", F.col("tp") + F.col("fp")))
        .withColumn("recall", ratio("tp", F.col("tp") + F.col("fn")))
        .withColumn("f1", f1_of("tp", "fp", "fn"))
    )


def summarize(labelled: DataFrame, fp_scope: str = "own") -> DataFrame:
    """Precision, recall and F1 per method and truth family.

    ``fp_scope='own'`` counts false positives among the family's own reads only;
    ``'all'`` also charges a family with reads of other families called as it.
    """
    real = labelled.filter(F.col("family_true") != BACKGROUND)
    if fp_scope == "own":
        return _rates(real.groupBy("method", F.col("family_true").alias("family")).agg(*_counts()))
    # A called read counts for two families at most: its own and the one it was called as.
    same = F.col("family_called") == F.col("family_true")
    own = F.struct(
        F.col("family_true").alias("family"),
        (same & F.col("genuine")).alias("tp"),
        (same & ~F.col("genuine")).alias("fp"),
        (~same & F.col("genuine")).alias("fn"),
        F.lit(True).alias("listed"),
    )
    other = F.struct(
        F.col("family_called").alias("family"), F.lit(False).alias("tp"), (~same).alias("fp"), F.lit(False).alias("fn"),
        F.lit(False).alias("listed"),
    )
    both = labelled.select("method", F.explode(F.array(own, other)).alias("e")).select("method", "e.*")
    totals = both.groupBy("method", "family").agg(
        *[F.count_if(c).alias(c) for c in ("tp", "fp", "fn")], F.max("listed").alias("_listed")
    )
    return _rates(totals.filter(F.col("_listed") & (F.col("family") != BACKGROUND)).drop("_listed"))


def summarize_by_length(labelled: DataFrame, bucket: int = 50) -> DataFrame:
    """The same rates by read-length bucket, labelled like ``100-149bp``."""
    start = (F.floor(F.col("read_length") / bucket) * bucket).cast("int")
    rows = labelled.filter(F.col("family_true") != BACKGROUND).withColumn("_start", start)
    out = _rates(rows.groupBy("method", F.col("family_true").alias("family"), "_start").agg(*_counts()))
    name = F.concat(F.col("_start").cast("string"), F.lit("-"), (F.col("_start") + (bucket - 1)).cast("string"), F.lit("bp"))
    return out.withColumn("read_length_bucket", name).drop("_start")


def grouped_metrics(labelled: DataFrame, bucket: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ``summarize``, ``summarize_by_length`` and ``background_fpr`` give, from one aggregation
    with grouping sets: a single pass over the labelled reads, of which only the counts are kept."""
    start = (F.floor(F.col("read_length") / bucket) * bucket).cast("int")
    rows = labelled.withColumn("family", F.col("family_true")).withColumn("_start", start)
    called = F.count_if(F.col("family_called") != NO_CALL).alias("n_called")
    counts = rows.groupingSets([["method", "family"], ["method", "family", "_start"]], "method", "family", "_start").agg(
        F.grouping("_start").alias("_total"), F.count(F.lit(1)).alias("n"), called, *_counts()
    )
    counts = materialize(counts)
    real, total = F.col("family") != BACKGROUND, F.col("_total") == 1
    summary = _rates(counts.filter(real & total).select("method", "family", "tp", "fp", "fn"))
    name = F.concat(F.col("_start").cast("string"), F.lit("-"), (F.col("_start") + (bucket - 1)).cast("string"), F.lit("bp"))
    by_length = _rates(counts.filter(real & ~total).select("method", "family", name.alias("read_length_bucket"), "tp", "fp", "fn"))
    background = counts.filter(~real & total).select("method", F.col("n").alias("n_background_reads"), F.col("n_called").alias("n_false_positive_calls"))
    return summary, by_length, background.withColumn("background_fpr", ratio("n_false_positive_calls", "n_background_reads"))


def background_fpr(labelled: DataFrame) -> DataFrame:
    """Share of background reads that got any call, per method."""
    return (
        labelled.filter(F.col("family_true") == BACKGROUND)
        .groupBy("method")
        .agg(F.count(F.lit(1)).alias("n_background_reads"), F.count_if(F.col("family_called") != NO_CALL).alias("n_false_positive_calls"))
        .withColumn("background_fpr", ratio("n_false_positive_calls", "n_background_reads"))
    )


def best_threshold(labelled: DataFrame) -> DataFrame:
    """Score threshold with the best F1 per method and called family; the lowest wins a tie.

    Recall is relative to the genuine reads among those called as the family. Families whose
    calls are all true or none true are left out.
    """
    true_call = ((F.col("family_true") == F.col("family_called")) & F.col("genuine")).cast("long")
    keys = ["method", "family"]
    by_score = (
        labelled.filter(~F.col("family_called").isin(NO_CALL, BACKGROUND))
        .groupBy("method", F.col("family_called").alias("family"), "bitscore")
        .agg(F.sum(true_call).alias("t"), F.sum(1 - true_call).alias("f"))
    )
    sweep = running_totals(by_score, keys, "bitscore", ["t", "f"], descending=True).filter("tot_t > 0 and tot_f > 0")
    f1 = F.coalesce(f1_of("cum_t", "cum_f", F.col("tot_t") - F.col("cum_t")), F.lit(0.0))
    # Fewer points remain per family than scores; min over the struct = best F1, lowest threshold.
    best = sweep.groupBy(*keys).agg(
        F.min(F.struct((-f1).alias("neg_f1"), "bitscore", "cum_t", "cum_f", "tot_t")).alias("b")
    )
    out = best.select(
        *keys,
        F.col("b.bitscore").alias("best_threshold"),
        F.col("b.cum_t").alias("tp"),
        F.col("b.cum_f").alias("fp"),
        (F.col("b.tot_t") - F.col("b.cum_t")).alias("fn"),
    )
    return (
        out.withColumn("precision", ratio("tp", F.col("tp") + F.col("fp")))
        .withColumn("recall", ratio("tp", F.col("tp") + F.col("fn")))
        .withColumn("f1", F.coalesce(f1_of("tp", "fp", "fn"), F.lit(0.0)))
    )


def curve_points(labelled: DataFrame) -> DataFrame:
    """Cumulative counts per method at each distinct score, highest first.

    Empty for a method whose reads are all correct or all incorrect.
    """
    hit = F.col("correct").cast("long")
    by_score = labelled.groupBy("method", "bitscore").agg(F.sum(hit).alias("t"), F.sum(1 - hit).alias("f"))
    return running_totals(by_score, ["method"], "bitscore", ["t", "f"], descending=True).filter("tot_t > 0 and tot_f > 0")


def roc_curve(labelled: DataFrame) -> DataFrame:
    return curve_points(labelled).select(
        "method",
        F.col("bitscore").alias("threshold"),
        (F.col("cum_f") / F.col("tot_f")).alias("fpr"),
        (F.col("cum_t") / F.col("tot_t")).alias("tpr"),
    )


def pr_curve(labelled: DataFrame) -> DataFrame:
    return curve_points(labelled).select(
        "method",
        F.col("bitscore").alias("threshold"),
        ratio("cum_t", F.col("cum_t") + F.col("cum_f")).alias("precision"),
        (F.col("cum_t") / F.col("tot_t")).alias("recall"),
    )


def roc_auc(labelled: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids.

    Each point knows its own increment, so the previous point is ``cum - own`` and no lag over
    the whole curve is needed; the area stays an exact integer until the last division.
    """
    twice = F.col("f") * (2 * F.col("cum_t") - F.col("t"))
    area = F.sum(twice.cast("decimal(38,0)")).cast("double")
    return (
        curve_points(labelled)
        .groupBy("method")
        .agg((area / (2.0 * F.max("tot_t") * F.max("tot_f"))).alias("roc_auc"))
    )


def pr_auc(labelled: DataFrame) -> DataFrame:
    """Area under the precision-recall curve by trapezoids, starting at (recall 0, precision 1)."""
    before_t, before_n = F.col("cum_t") - F.col("t"), F.col("cum_t") - F.col("t") + F.col("cum_f") - F.col("f")
    here = F.col("cum_t") / (F.col("cum_t") + F.col("cum_f"))
    before = F.when(before_n > 0, before_t / before_n).otherwise(F.lit(1.0))
    slab = F.col("t") / F.col("tot_t") * (here + before) / 2
    return curve_points(labelled).groupBy("method").agg(F.sum(slab).alias("pr_auc"))


def compare_recall(truth: DataFrame, calls: DataFrame, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """True/false positives and misses per method and target family, cross-family calls included.

    One pass: every read adds to its own family and, when called as another, to that one too.
    """
    genuine = truth.select("read_id", "family", F.lit("positive").alias("label"), F.lit(1).alias("overlaps_cds"))
    labelled = label_reads(calls, genuine, methods, with_score=False)
    return summarize(labelled, fp_scope="all").drop("f1")


def panel_summary(summary: DataFrame) -> DataFrame:
    """Read-volume-weighted panel metrics: counts pooled over families."""
    pooled = summary.groupBy("method").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return _rates(pooled)


def compare_releases(new: DataFrame, old: DataFrame) -> DataFrame:
    """Per method: families whose F1 improved or worsened between two releases, and by how much."""
    pair = new.select("method", "family", F.coalesce("f1", F.lit(0.0)).alias("_new")).join(
        old.select("method", "family", F.coalesce("f1", F.lit(0.0)).alias("_old")), ["method", "family"]
    )
    delta = F.col("_new") - F.col("_old")
    return pair.groupBy("method").agg(
        F.count_if(delta > 0).alias("n_improved"),
        F.coalesce(F.sum(F.when(delta > 0, delta)), F.lit(0.0)).alias("sum_improved"),
        F.count_if(delta < 0).alias("n_worsened"),
        F.coalesce(F.sum(F.when(delta < 0, delta)), F.lit(0.0)).alias("sum_worsened"),
    )


def cascade_config(
    summary: DataFrame, best: DataFrame, precision_threshold: float = 0.95, first: str = "search", second: str = "profile"
) -> DataFrame:
    """Families whose first-method precision is too low and that have a second-method threshold."""
    low = F.col("precision") < precision_threshold
    paired = (
        summary.filter(F.col("method") == first)
        .select("family", "precision")
        .join(best.filter(F.col("method") == second).select("family", "best_threshold"), "family", "left")
    )
    flagged = F.coalesce(low & F.col("best_threshold").isNotNull(), F.lit(False))
    return paired.select(
        "family",
        "precision",
        F.when(flagged, "yes").otherwise("no").alias("needs_check"),
        F.when(flagged, F.col("best_threshold")).alias("short_read_threshold"),
    )


def apply_cascade(calls: DataFrame, config: DataFrame, other_hits: DataFrame) -> DataFrame:
    """Keep a flagged family's call only when the other method scores that family high enough."""
    # At most one row per family: stored, so the plan knows its size and the calls stay in place.
    flagged = materialize(config.filter(F.col("needs_check") == "yes").select("family", "short_read_threshold"))
    second = (
        other_hits.groupBy("sample", "read_id", "family").agg(F.max("bitscore").alias("_second"))
    )
    return (
        calls.join(flagged, "family", "left")
        .join(second, ["sample", "read_id", "family"], "left")
        .filter(F.col("short_read_threshold").isNull() | (F.col("_second") >= F.col("short_read_threshold")))
        .select(*calls.columns)
    )


def gene_counts(calls: DataFrame) -> DataFrame:
    """Reads called per sample and family."""
    return calls.groupBy("sample", "family").agg(F.count(F.lit(1)).alias("n_reads"))
