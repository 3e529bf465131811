"""Selection of positives and hard negatives from a catalogue, and config audits.

``families`` is the config table: one row per family with the columns of
``refpanel.sources.families.FAMILY_SCHEMA``. ``catalogue(accession, gene_names, domains,
lineage, organism, seq or length)`` is the big table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refpanel.functions import seeded_key
from refpanel.session import materialize

OVERSAMPLE = 5
PAGE = 500
SALTS = 64


def _none(col: str) -> Column:
    return F.coalesce(F.size(col), F.lit(0)) <= 0


def _terms(genes: str, domains: str) -> Column:
    blank = F.array().cast("array<string>")
    return F.concat(
        F.transform(F.coalesce(genes, blank), lambda g: F.concat(F.lit("gene:"), g)),
        F.transform(F.coalesce(domains, blank), lambda d: F.concat(F.lit("domain:"), d)),
    )


def select_sequences(catalogue: DataFrame, families: DataFrame, label: str) -> DataFrame:
    """Catalogue rows of each family for one label.

    Positive: any of ``pos_genes`` or ``pos_pfam``. Negative: any of ``neg_pfam`` (the anchor),
    any of ``neg_genes`` if given, none of ``exclude_genes`` and ``exclude_pfam``, and not the
    fusion marker of a family that declares a partner. Both: inside ``taxonomy_id`` if given.

    The any-of test runs as an equi-join on exploded terms, never as families x catalogue.
    """
    if label == "positive":
        wanted = families.withColumn("_term", F.explode(_terms("pos_genes", "pos_pfam")))
    elif label == "negative":
        wanted = families.withColumn("_term", F.explode(_terms(F.array().cast("array<string>"), "neg_pfam")))
    else:
        raise ValueError(f"label must be positive or negative, not {label!r}")
    rules = ["neg_genes", "exclude_genes", "exclude_pfam", "taxonomy_id", "fusion_partner", "fusion_marker"]
    wanted = wanted.select("family", "_term", *rules)
    offered = catalogue.withColumn("_term", F.explode(F.array_distinct(_terms("gene_names", "domains"))))
    blank = F.array().cast("array<string>")
    # A row without gene names or domains is a row with none: unnamed loci are usual negatives.
    genes, domains = F.coalesce("gene_names", blank), F.coalesce("domains", blank)
    inside = F.array_contains(F.coalesce("lineage", F.array().cast("array<int>")), F.col("taxonomy_id"))
    keep = F.col("taxonomy_id").isNull() | inside
    if label == "negative":
        marker = F.col("fusion_partner").isNotNull() & F.col("fusion_marker").isNotNull()
        keep = (
            keep
            & (_none("neg_genes") | F.arrays_overlap(genes, F.coalesce("neg_genes", blank)))
            & ~F.arrays_overlap(genes, F.coalesce("exclude_genes", blank))
            & ~F.arrays_overlap(domains, F.coalesce("exclude_pfam", blank))
            & ~F.when(marker, F.array_contains(domains, F.col("fusion_marker"))).otherwise(F.lit(False))
        )
    return (
        offered.join(wanted, "_term")
        .filter(keep)
        .select("family", F.lit(label).alias("label"), *catalogue.columns)
        .dropDuplicates(["family", "accession"])
    )


def capped_sample(seqs: DataFrame, caps: DataFrame, seed=42) -> DataFrame:
    """Bounded oversample per family and label.

    ``caps(family, label, max_n)``; a null cap or no row keeps all. Otherwise the first
    ``5 * max_n`` accessions in order (rounded up to pages of 500) are candidates and ``max_n``
    of them are drawn in seeded order. Only keys pass the windows; each is cut per salt before
    the family meets in one task, so that task sees at most ``SALTS * candidates`` rows.
    """
    keyed = seqs.join(caps.select("family", "label", "max_n"), ["family", "label"], "left")
    n_cand = F.ceil(F.col("max_n") * OVERSAMPLE / PAGE) * PAGE
    group = ["family", "label"]
    rows = keyed.filter(F.col("max_n").isNotNull()).select(*group, "accession", "max_n").withColumn(
        "_salt", F.pmod(F.xxhash64("accession"), F.lit(SALTS))
    )
    first = Window.partitionBy(*group, "_salt").orderBy("accession")
    second = Window.partitionBy(*group).orderBy("accession")
    drawn = Window.partitionBy(*group).orderBy("_key", "accession")
    picked = (
        rows.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= n_cand)
        .withColumn("_rn", F.row_number().over(second))
        .filter(F.col("_rn") <= n_cand)
        .withColumn("_key", seeded_key(seed, "family", "label", "accession"))
        .withColumn("_rn", F.row_number().over(drawn))
        .filter(F.col("_rn") <= F.col("max_n"))
        .select(*group, "accession")
    )
    # At most the caps: stored, so the plan knows how few they are and the sequences stay in place.
    drawn_keys = materialize(picked.distinct().withColumn("_drawn", F.lit(True)))
    return keyed.join(drawn_keys, [*group, "accession"], "left").filter("max_n IS NULL OR _drawn").select(*seqs.columns)


def fetch_manifest(seqs: DataFrame) -> DataFrame:
    """Counts and organism/genus diversity per family and label."""
    from refpanel.functions import genus_of

    return seqs.withColumn("_genus", genus_of("organism")).groupBy("family", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("organism").alias("n_organisms"),
        F.count_distinct("_genus").alias("n_genera"),
    )


def fusion_pairs(families: DataFrame) -> DataFrame:
    """Declared fusion pairs whose partner exists, unordered and unique."""
    partner = families.select(F.col("family").alias("fusion_partner"))
    both = families.select("family", "fusion_partner").join(partner, "fusion_partner", "left_semi")
    return both.select(
        F.least("family", "fusion_partner").alias("fam_a"), F.greatest("family", "fusion_partner").alias("fam_b")
    ).distinct()


def shared_models(families: DataFrame) -> DataFrame:
    """Curated models claimed by more than one family."""
    return (
        families.filter(F.col("curated_model").isNotNull())
        .groupBy("curated_model")
        .agg(F.count(F.lit(1)).alias("n_families"), F.array_join(F.array_sort(F.collect_list("family")), ",").alias("families"))
        .filter("n_families > 1")
    )


def check_unique_models(families: DataFrame) -> None:
    """Raise when two families claim the same curated model."""
    bad = shared_models(families).collect()  # at most as many rows as the config
    if bad:
        raise ValueError("curated model shared by families: " + "; ".join(f"{r.curated_model}: {r.families}" for r in bad))


def sibling_exclusion_audit(families: DataFrame) -> DataFrame:
    """Per family, gene symbols of same-anchor siblings that its negatives do not exclude.

    The symbols of an anchor domain are gathered and sorted once and each family subtracts its own
    and its excluded ones in one pass, which keeps their order; no family pairs are formed. What is
    written is a list per family as long as its anchor has symbols. The families are spread over all
    tasks, however few the anchors are.
    """
    blank = F.array().cast("array<string>")
    tasks = int(families.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    anchored = families.withColumn("anchor", F.explode("neg_pfam"))
    symbols = F.sort_array(F.collect_set("_g"))
    known = anchored.withColumn("_g", F.explode("pos_genes")).groupBy("anchor").agg(symbols.alias("_all"))
    own = F.concat(F.coalesce("exclude_genes", blank), F.coalesce("pos_genes", blank))
    # Exploding a single list keeps it from being computed once for each column that reads it.
    missing = F.explode(F.array(F.array_except("_all", own))).alias("_missing")
    return (
        anchored.repartition(tasks, "family").join(F.broadcast(known), "anchor")
        .select("family", "anchor", missing)
        .filter(F.size("_missing") > 0)
        .select("family", "anchor", F.array_join("_missing", ",").alias("missing_genes"), F.size("_missing").alias("n_missing"))
    )


def excluded_families(families: DataFrame, mode: str) -> DataFrame:
    """Family names never reported: ``profile`` drops annotate-only families and decoys, ``annotate`` only decoys."""
    decoys = families.filter(F.col("decoy_from_negatives")).select(F.concat("family", F.lit("_decoy")).alias("family"))
    if mode == "annotate":
        return decoys
    if mode != "profile":
        raise ValueError(f"mode must be profile or annotate, not {mode!r}")
    return families.filter(F.col("scope") == "annotate_only").select("family").unionByName(decoys)


def apply_scope(calls: DataFrame, families: DataFrame, mode: str) -> DataFrame:
    """Calls without the families excluded in ``mode``."""
    return calls.join(excluded_families(families, mode), "family", "left_anti")
