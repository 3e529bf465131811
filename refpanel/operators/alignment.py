"""Alignment columns: occupancy, trimming, profiles and profile scoring.

``alignment(family, accession, aligned)``; rows shorter than the widest one of their family
count as gaps beyond their end, so no padding is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refpanel.functions import residues
from refpanel.operators.metrics import ratio
from refpanel.operators.similarity import MAX_EVALUE, similarity_join
from refpanel.session import materialize

GAP = "-"
GAP_THRESHOLD = 0.8
PSEUDOCOUNT = 1.0


def _cells(alignment: DataFrame) -> DataFrame:
    return alignment.select("family", "accession", F.posexplode(residues("aligned")).alias("col", "residue"))


def column_occupancy(alignment: DataFrame) -> DataFrame:
    """Non-gap share of every alignment column; ``n_rows`` is the number of sequences of the family."""
    rows = alignment.groupBy("family").agg(F.count(F.lit(1)).alias("n_rows"))
    filled = _cells(alignment).groupBy("family", "col").agg(F.count_if(F.col("residue") != GAP).alias("n_filled"))
    return filled.join(rows, "family").withColumn("occupancy", ratio("n_filled", "n_rows"))


def trim_alignment(alignment: DataFrame, families: DataFrame | None = None, default_gt: float = GAP_THRESHOLD) -> DataFrame:
    """Rows with only the columns whose occupancy reaches the family's ``trim_gt``.

    Families with fewer than 2 sequences are left out. A family's columns become one array of
    flags (as long as the alignment is wide) that each row is zipped with: rows never meet.
    """
    occupancy = column_occupancy(alignment).filter("n_rows >= 2")
    limit = F.lit(default_gt)
    if families is not None:
        occupancy = occupancy.join(families.select("family", "trim_gt"), "family", "left")
        limit = F.coalesce("trim_gt", limit)
    keep = F.col("occupancy") >= limit
    flags = occupancy.groupBy("family").agg(
        F.array_sort(F.collect_list(F.struct("col", keep.alias("keep")))).alias("_f"),
        F.coalesce(F.max(F.when(keep, F.col("col"))) + 1, F.lit(0)).alias("_width"),
    )
    # Nothing is kept beyond the last kept column, so neither mask nor rows go further.
    mask = flags.select("family", "_width", F.transform(F.slice("_f", 1, F.col("_width")), lambda f: f["keep"]).alias("_mask"))
    kept = F.zip_with(F.slice(residues("aligned"), 1, F.col("_width")), "_mask", lambda x, keep: F.when(keep, F.coalesce(x, F.lit(GAP))))
    # One mask per family: stored, so the plan knows its size and the rows keep their partitioning.
    return alignment.join(materialize(mask), "family").select("family", "accession", F.array_join(kept, "").alias("trimmed"))


def build_profile(alignment: DataFrame, pseudocount: float = PSEUDOCOUNT) -> DataFrame:
    """Log-odds (bits) per family, column and residue against the residue's overall share.

    ``alignment(family, accession, aligned)``, normally trimmed.
    """
    cells = _cells(alignment).filter(F.col("residue") != GAP)
    # The cells are counted once; everything else reads the counts.
    counts = materialize(cells.groupBy("family", "col", "residue").agg(F.count(F.lit(1)).alias("n")))
    depth = Window.partitionBy("family", "col")  # as many rows as the alphabet has letters
    # As many rows as the alphabet has letters.
    shares = materialize(counts.groupBy("residue").agg(F.sum("n").alias("_r")))
    shares = shares.select("residue", (F.col("_r").cast("double") / F.sum("_r").over(Window.partitionBy())).alias("bg"))
    odds = (F.col("n") + pseudocount * F.col("bg")) / (F.col("depth") + pseudocount) / F.col("bg")
    return (
        counts.withColumn("depth", F.sum("n").over(depth))
        .join(shares, "residue")
        .select("family", "col", "residue", "n", "depth", F.log2(odds).alias("log_odds"))
    )


def residue_columns(alignment: DataFrame) -> DataFrame:
    """Alignment column of every residue: ``(family, accession, idx, col)``, gaps skipped."""
    filled = F.filter(
        F.transform(residues("aligned"), lambda x, i: F.struct(x.alias("x"), i.alias("col"))), lambda s: s["x"] != GAP
    )
    return alignment.select("family", "accession", F.posexplode(filled).alias("idx", "cell")).select(
        "family", "accession", "idx", F.col("cell.col").alias("col")
    )


def profile_scan(
    queries: DataFrame, alignment: DataFrame, profile: DataFrame, k: int = 5, containment: int | None = None, max_evalue: float | None = MAX_EVALUE
) -> DataFrame:
    """Score of each query against each family's profile on its best seeded diagonal.

    The query's best train member of a family gives the diagonal; every query residue of the
    seeded span maps through that member to an alignment column and adds its log-odds. Columns
    or residues the profile does not hold add nothing. ``max_evalue`` and ``containment`` are those
    of ``similarity_join``.
    """
    members = alignment.select("family", "accession", F.replace("aligned", F.lit(GAP), F.lit("")).alias("seq"))
    hits = materialize(similarity_join(queries.select("accession", "seq"), members, k, max_evalue, containment, same_family=False))
    spans = hits.join(queries.select("accession", "seq"), "accession").select(
        "accession",
        "family",
        "subject_id",
        "diag",
        "q_start",
        F.posexplode(F.slice(residues("seq"), F.col("q_start") + 1, F.col("span"))).alias("off", "residue"),
    )
    # Only members that are the best of some query are cut into residues.
    chosen = hits.select("family", F.col("subject_id").alias("accession")).distinct()
    hit_rows = alignment.join(chosen, ["family", "accession"], "left_semi")
    mapped = spans.select(
        "family", F.col("accession").alias("query_id"), F.col("subject_id").alias("accession"), "residue",
        (F.col("q_start") + F.col("off") - F.col("diag")).cast("int").alias("idx"),
    ).join(residue_columns(hit_rows), ["family", "accession", "idx"])
    return (
        mapped.join(profile.select("family", "col", "residue", "log_odds"), ["family", "col", "residue"])
        .groupBy("family", "query_id")
        .agg(F.sum("log_odds").alias("score"), F.count(F.lit(1)).alias("n_scored"))
    )
