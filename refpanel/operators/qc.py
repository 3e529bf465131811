"""Quality control of the selected sets: purity, length, domain evidence, curated additions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.functions import extra_id
from refpanel.operators.metrics import ratio
from refpanel.operators.select import capped_sample, fusion_pairs
from refpanel.session import materialize

PURITY_THRESHOLD = 70.0
LENGTH_RATIO = 1.5
MIN_SEQUENCES = 5
INTRINSIC_MIN = 0.5
FOREIGN_MAX = 0.1


def negative_purity(negatives: DataFrame, hits: DataFrame, threshold: float = PURITY_THRESHOLD) -> DataFrame:
    """Highest identity of each negative to a positive of its family; at or above ``threshold`` it is flagged.

    ``hits(family, accession, pident)``; a negative without a hit has identity 0.
    """
    top = hits.groupBy("family", "accession").agg(F.max("pident").alias("max_pident"))
    return (
        negatives.join(top, ["family", "accession"], "left")
        .withColumn("max_pident", F.coalesce("max_pident", F.lit(0.0)))
        .withColumn("flagged", F.col("max_pident") >= threshold)
    )


def purity_manifest(checked: DataFrame, threshold: float = PURITY_THRESHOLD) -> DataFrame:
    return checked.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~F.col("flagged")).alias("n_kept"),
        F.count_if(F.col("flagged")).alias("n_flagged"),
        F.lit(threshold).alias("threshold_pident"),
    )


def family_medians(seqs: DataFrame, families: DataFrame | None = None, min_sequences: int = MIN_SEQUENCES) -> DataFrame:
    """Exact median length per family and label (at least ``min_sequences`` rows), with negative overrides.

    The rows collapse to a histogram of lengths first, so the last step sees one row per
    distinct length however large the family is.
    """
    lengths = seqs.groupBy("family", "label", "length").agg(F.count(F.lit(1)).alias("_c"))
    out = lengths.groupBy("family", "label").agg(
        F.sum("_c").alias("n"), F.expr("percentile(length, 0.5D, _c)").alias("median_length")
    )
    out = out.filter(F.col("n") >= min_sequences)
    if families is None:
        return out.withColumn("median_source", F.lit("computed"))
    pinned = families.select("family", F.lit("negative").alias("label"), "negative_median_override").filter(
        F.col("negative_median_override").isNotNull()
    )
    return out.join(pinned, ["family", "label"], "left").select(
        "family", "label", "n",
        F.coalesce(F.col("negative_median_override").cast("double"), "median_length").alias("median_length"),
        F.when(F.col("negative_median_override").isNotNull(), "override").otherwise("computed").alias("median_source"),
    )


def _with_marker(seqs: DataFrame, families: DataFrame, domains: DataFrame) -> DataFrame:
    """Add ``fusion_partner``, ``fusion_marker`` and ``has_marker`` (null without a declared marker)."""
    config = families.filter(F.col("fusion_partner").isNotNull()).select("family", "fusion_partner", "fusion_marker")
    carriers = (
        domains.select("accession", F.explode("domains").alias("fusion_marker"))
        .join(config.select("fusion_marker").distinct(), "fusion_marker", "left_semi")
        .distinct()
        .withColumn("_carries", F.lit(True))
    )
    marked = seqs.join(config, "family", "left").join(carriers, ["accession", "fusion_marker"], "left")
    return marked.withColumn(
        "has_marker", F.when(F.col("fusion_marker").isNotNull(), F.coalesce("_carries", F.lit(False)))
    ).drop("_carries")


def domain_prefilter(seqs: DataFrame, families: DataFrame, domains: DataFrame) -> DataFrame:
    """Add ``contaminant``: a negative of a fusion family that carries the family's marker domain."""
    marked = _with_marker(seqs, families, domains)
    return marked.withColumn(
        "contaminant", (F.col("label") == "negative") & F.coalesce("has_marker", F.lit(False))
    )


def length_outliers(
    seqs: DataFrame,
    families: DataFrame,
    domains: DataFrame | None = None,
    max_ratio: float = LENGTH_RATIO,
    min_sequences: int = MIN_SEQUENCES,
) -> DataFrame:
    """Add ``outcome`` to every sequence: kept, flagged, fusion, contaminant or too_few.

    A length in ``[median/ratio, median*ratio]`` is kept. Outside it, a positive of a family
    with a fusion partner whose length fits the summed medians the same way is a fusion,
    provided it carries the marker when there is evidence. Families may set their own ratio
    in ``length_max_ratio``.
    """
    if domains is None:
        config = families.select("family", "fusion_partner", "fusion_marker")
        rows = seqs.join(config, "family", "left").withColumn("has_marker", F.lit(None).cast("boolean")).withColumn(
            "contaminant", F.lit(False)
        )
    else:
        rows = domain_prefilter(seqs, families, domains)
    medians = family_medians(rows.filter(~F.col("contaminant")), families, min_sequences)
    partner = medians.filter(F.col("label") == "positive").select(
        F.col("family").alias("fusion_partner"), F.col("median_length").alias("_partner")
    )
    own_ratio = "length_max_ratio" in families.columns
    limits = (
        medians.join(
            families.select("family", F.col("fusion_partner"), *(["length_max_ratio"] if own_ratio else [])), "family", "left"
        )
        .join(partner, "fusion_partner", "left")
        .select(
            "family", "label", "median_length", "median_source",
            (F.coalesce("length_max_ratio", F.lit(max_ratio)) if own_ratio else F.lit(max_ratio)).alias("max_ratio"),
            F.when(F.col("label") == "positive", F.col("median_length") + F.col("_partner")).alias("_fused"),
        )
    )
    # One row per family and label: stored, so the plan knows how small it is and the sequences stay.
    rows = rows.join(materialize(limits), ["family", "label"], "left")

    def inside(center):
        return (F.col("length") >= F.col(center) / F.col("max_ratio")) & (F.col("length") <= F.col(center) * F.col("max_ratio"))

    outcome = (
        F.when(F.col("contaminant"), "contaminant")
        .when(F.col("median_length").isNull(), "too_few")
        .when(inside("median_length"), "kept")
        .when(F.coalesce(inside("_fused"), F.lit(False)) & F.coalesce("has_marker", F.lit(True)), "fusion")
        .otherwise("flagged")
    )
    return rows.withColumn("outcome", outcome).select(*seqs.columns, "median_length", "median_source", "max_ratio", "outcome")


def length_manifest(classified: DataFrame) -> DataFrame:
    """Counts per family and label of each outcome."""
    def n(*outcomes):
        return F.count_if(F.col("outcome").isin(*outcomes))

    return (
        classified.filter(F.col("outcome") != "too_few")
        .groupBy("family", "label")
        .agg(
            n("kept", "flagged", "fusion").alias("n_total"),
            n("kept").alias("n_kept"),
            n("flagged").alias("n_flagged"),
            n("fusion").alias("n_fusion_candidates"),
            n("contaminant").alias("n_contaminants"),
            F.max("median_length").alias("median_length"),
            F.max("median_source").alias("median_source"),
            F.max("max_ratio").alias("max_ratio"),
        )
    )


def domain_fractions(positives: DataFrame, domains: DataFrame, max_ratio: float = LENGTH_RATIO) -> DataFrame:
    """Share of each family's typical-length positives that carry each domain."""
    medians = materialize(family_medians(positives, min_sequences=1).select("family", "label", "median_length"))
    typical = positives.join(medians, ["family", "label"]).filter(
        (F.col("length") >= F.col("median_length") / max_ratio) & (F.col("length") <= F.col("median_length") * max_ratio)
    )
    known = typical.select("family", "accession").join(domains, "accession")
    # The total rides along as the count of a null domain: one pass, one shuffle.
    counted = (
        known.select("family", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("domains"))).alias("domain"))
        .groupBy("family", "domain")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counted.filter(F.col("domain").isNull()).select("family", F.col("n").alias("n_total"))
    return (
        counted.filter(F.col("domain").isNotNull())
        .join(total, "family")
        .select("family", "domain", F.col("n").alias("n_carriers"), "n_total", ratio("n", "n_total").alias("fraction"))
    )


def fusion_domain_pair(
    families: DataFrame, fractions: DataFrame, intrinsic_min: float = INTRINSIC_MIN, foreign_max: float = FOREIGN_MAX
) -> DataFrame:
    """Per fusion pair, a domain proper to each side and foreign to the other; the alphabetically first wins.

    Candidates of a family are its fusion marker and its anchor domains.
    """
    blank = F.array().cast("array<string>")
    candidates = families.select(
        "family",
        F.explode(
            F.array_distinct(
                F.filter(F.concat(F.array("fusion_marker"), F.coalesce("neg_pfam", blank)), lambda d: d.isNotNull())
            )
        ).alias("domain"),
    )
    pairs = fusion_pairs(families)
    sides = pairs.select("fam_a", "fam_b", F.col("fam_a").alias("own"), F.col("fam_b").alias("other")).unionByName(
        pairs.select("fam_a", "fam_b", F.col("fam_b").alias("own"), F.col("fam_a").alias("other"))
    )
    share = fractions.select("family", "domain", "fraction")
    seen = share.select(F.col("family").alias("other")).distinct()
    verified = (
        sides.join(candidates.withColumnRenamed("family", "own"), "own")
        .join(share.withColumnRenamed("family", "own").withColumnRenamed("fraction", "_own"), ["own", "domain"])
        .join(seen, "other", "left_semi")
        .join(share.withColumnRenamed("family", "other").withColumnRenamed("fraction", "_other"), ["other", "domain"], "left")
        .filter((F.col("_own") >= intrinsic_min) & (F.coalesce("_other", F.lit(0.0)) <= foreign_max))
    )
    side_a = verified.filter(F.col("own") == F.col("fam_a")).groupBy("fam_a", "fam_b").agg(F.min("domain").alias("domain_a"))
    side_b = verified.filter(F.col("own") == F.col("fam_b")).select("fam_a", "fam_b", F.col("domain").alias("_d"))
    return (
        side_a.join(side_b, ["fam_a", "fam_b"])
        .filter(F.col("_d") != F.col("domain_a"))
        .groupBy("fam_a", "fam_b", "domain_a")
        .agg(F.min("_d").alias("domain_b"))
    )


def add_extra_positives(positives: DataFrame, extra: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Study records whose id the family does not have yet, and the merge manifest.

    ``extra(family, ord, header, seq)``. The first of several records with one id wins. Families
    without a positive set are skipped. ``family`` stays the real family; the study tag is a column.
    """
    known = extra.withColumn("accession", extra_id("header")).join(
        positives.select("family").distinct(), "family", "left_semi"
    )
    one = known.groupBy("family", "accession").agg(F.min(F.struct("ord", "seq")).alias("_r"), F.count(F.lit(1)).alias("_n"))
    have = positives.select("family", "accession").distinct().withColumn("_have", F.lit(True))
    judged = one.join(have, ["family", "accession"], "left")
    added = judged.filter(F.col("_have").isNull()).select(
        "family",
        F.lit("positive").alias("label"),
        F.concat("family", F.lit("_study")).alias("source_tag"),
        "accession",
        F.lit("unknown").alias("organism"),
        F.col("_r.seq").alias("seq"),
        F.length("_r.seq").alias("length"),
    )
    manifest = judged.groupBy("family").agg(
        F.sum("_n").alias("n_extra_total"), F.count_if(F.col("_have").isNull()).alias("n_appended")
    ).withColumn("n_already_present", F.col("n_extra_total") - F.col("n_appended"))
    return added, manifest


def worst_examples(classified: DataFrame) -> DataFrame:
    """The flagged sequence farthest from its median, per family and label."""
    far = F.abs(F.col("length") - F.col("median_length"))
    worst = classified.filter(F.col("outcome") == "flagged").groupBy("family", "label").agg(
        F.min(F.struct((-far).alias("neg"), "accession", "length")).alias("w")
    )
    return worst.select("family", "label", F.col("w.accession").alias("accession"), F.col("w.length").alias("length"), (-F.col("w.neg")).alias("deviation"))


def worst_impurity(checked: DataFrame) -> DataFrame:
    """The flagged negative with the highest identity, per family."""
    worst = checked.filter("flagged").groupBy("family").agg(F.min(F.struct((-F.col("max_pident")).alias("neg"), "accession")).alias("w"))
    return worst.select("family", F.col("w.accession").alias("accession"), (-F.col("w.neg")).alias("max_pident"))


def fusion_screen(medians: DataFrame, min_ratio: float = 2.0) -> DataFrame:
    """Families whose negatives are typically much longer than their positives: undeclared fusions."""
    sides = medians.groupBy("family").agg(
        *[F.max(F.when(F.col("label") == s, F.col("median_length"))).alias(f"{s}_median") for s in ("positive", "negative")]
    )
    return sides.withColumn("length_ratio", ratio("negative_median", "positive_median")).withColumn(
        "suspect", F.coalesce(F.col("length_ratio") >= min_ratio, F.lit(False))
    )


def median_stability(seqs: DataFrame, small: int, large: int, tolerance: float = 0.025, seed=42) -> DataFrame:
    """Median length of a small and a large capped sample, flagged when it moves more than ``tolerance``."""
    groups = materialize(seqs.select("family", "label").distinct())

    def at(cap: int, name: str) -> DataFrame:
        sample = capped_sample(seqs, groups.withColumn("max_n", F.lit(cap)), seed)
        return family_medians(sample).select("family", "label", F.col("median_length").alias(name))

    both = at(small, "small_median").join(at(large, "large_median"), ["family", "label"])
    moved = F.abs(F.col("small_median") - F.col("large_median")) / F.col("large_median")
    return both.withColumn("shift", moved).withColumn("unstable", F.col("shift") > tolerance)
