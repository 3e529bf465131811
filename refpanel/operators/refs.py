"""Assembly of the searchable reference table: train positives, decoys, fused references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REF_COLUMNS = ["family", "accession", "organism", "seq"]


def decoy_refs(split: DataFrame, families: DataFrame) -> DataFrame:
    """Train negatives of decoy families as ``<family>_decoy``, minus train positives of any family."""
    train = split.filter("split = 'train'")
    used = train.filter("label = 'positive'").select("accession").distinct()
    decoys = families.filter(F.col("decoy_from_negatives")).select("family")
    return (
        train.filter("label = 'negative'")
        .join(decoys, "family", "left_semi")
        .join(used, "accession", "left_anti")
        .withColumn("family", F.concat("family", F.lit("_decoy")))
        .select(*REF_COLUMNS)
    )


def select_fused(catalogue: DataFrame, pair_domains: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """Catalogue rows with both verified domains of a pair, by an equi-join on the first domain.

    With ``families`` a row lies in the taxon of the pair's first family, where that names one."""
    if families is not None:
        pair_domains = pair_domains.join(families.select(F.col("family").alias("fam_a"), "taxonomy_id"), "fam_a", "left")
    offered = catalogue.withColumn("domain_a", F.explode(F.array_distinct("domains")))
    return (
        offered.join(pair_domains, "domain_a")
        .filter(F.array_contains("domains", F.col("domain_b")))
        .filter(F.lit(True) if families is None else F.col("taxonomy_id").isNull() | F.array_contains("lineage", F.col("taxonomy_id")))
        .select("fam_a", "fam_b", *catalogue.columns)
    )


def fusion_refs(pairs: DataFrame, candidates: DataFrame, dedicated: DataFrame) -> DataFrame:
    """Fused references ``A_B_fused``: candidates of A, then of B, then the dedicated selection.

    The first source wins per accession. ``candidates(family, accession, organism, seq)``,
    ``dedicated(fam_a, fam_b, accession, organism, seq)``.
    """
    keys = ["fam_a", "fam_b"]
    body = ["accession", "organism", "seq"]
    from_a = pairs.join(candidates.withColumnRenamed("family", "fam_a"), "fam_a").select(*keys, *body, F.lit(0).alias("_prio"))
    from_b = pairs.join(candidates.withColumnRenamed("family", "fam_b"), "fam_b").select(*keys, *body, F.lit(1).alias("_prio"))
    extra = dedicated.select(*keys, *body, F.lit(2).alias("_prio"))
    first = (
        from_a.unionByName(from_b)
        .unionByName(extra)
        .groupBy(*keys, "accession")
        .agg(F.min(F.struct("_prio", "organism", "seq")).alias("r"))
    )
    return first.select(
        F.concat("fam_a", F.lit("_"), "fam_b", F.lit("_fused")).alias("family"),
        "accession",
        F.col("r.organism").alias("organism"),
        F.col("r.seq").alias("seq"),
    )


def assemble_refs(split: DataFrame, decoys: DataFrame, fused: DataFrame) -> DataFrame:
    """Train positives, all decoys and all fused references; never a test row."""
    positives = split.filter("split = 'train' and label = 'positive'").select(*REF_COLUMNS)
    return (
        positives.withColumn("kind", F.lit("positive"))
        .unionByName(decoys.select(*REF_COLUMNS).withColumn("kind", F.lit("decoy")))
        .unionByName(fused.select(*REF_COLUMNS).withColumn("kind", F.lit("fused")))
    )
