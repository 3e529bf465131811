"""Consolidation of the QC manifests into one row per family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.operators.metrics import ratio

FLAG_FRACTION = 0.10
# Statuses that need no review on the scorecard.
CLEAN_STATUSES = ("clean_separation", "clean_separation_no_negative_hits")


def qc_scorecard(
    families: DataFrame,
    purity: DataFrame,
    lengths: DataFrame,
    cutoffs: DataFrame,
    flag_fraction: float = FLAG_FRACTION,
    clean_statuses: tuple[str, ...] = CLEAN_STATUSES,
) -> DataFrame:
    """Flagged fractions, cutoff status and the reasons for review (strictly above ``flag_fraction``).

    ``purity(family, n_total, n_flagged)``, ``lengths(family, label, n_total, n_flagged)``,
    ``cutoffs(family, cutoff, status)``. All inputs have at most two rows per family.
    """
    by_label = lengths.groupBy("family").agg(
        *[
            F.max(F.when(F.col("label") == label, F.col(c))).alias(f"{short}_length_{c[2:]}")
            for label, short in (("positive", "pos"), ("negative", "neg"))
            for c in ("n_flagged", "n_total")
        ]
    )
    card = (
        families.select("family")
        .join(purity.select("family", F.col("n_flagged").alias("neg_purity_flagged"), F.col("n_total").alias("neg_purity_total")), "family", "left")
        .join(by_label, "family", "left")
        .join(cutoffs.select("family", "cutoff", "status"), "family", "left")
    )

    def reason(name: str):
        known = F.col(f"{name}_total").isNotNull()
        share = F.coalesce(ratio(f"{name}_flagged", f"{name}_total"), F.lit(0.0))
        text = F.concat(F.lit(f"{name}="), F.bround(share * 100).cast("int").cast("string"), F.lit("%"))
        return F.when(known & (share > flag_fraction), text)

    status = F.when(
        (F.coalesce("status", F.lit("")) != "") & ~F.col("status").isin(*clean_statuses),
        F.concat(F.lit("hmm_status="), F.col("status")),
    )
    reasons = F.concat_ws(";", reason("neg_purity"), reason("pos_length"), reason("neg_length"), status)
    return card.withColumn("review_reasons", reasons).withColumn(
        "review_needed", F.when(F.col("review_reasons") != "", "yes").otherwise("no")
    )
