"""Building one release: select, check, de-duplicate, split, calibrate, assemble."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.operators import alignment as aln
from refpanel.operators import calibrate, qc, refs, scorecard, select, similarity, split
from refpanel.operators.cluster import cluster_greedy
from refpanel.session import materialize
from refpanel.sources.tables import write_release

#: Searches that feed a calibration keep weak hits too, since cutoffs lie among them.
CALIBRATION_EVALUE = 10.0


@dataclass
class Release:
    """The tables of a release; each is lazy except the materialised ``split``."""

    name: str
    sequences: DataFrame
    split: DataFrame
    purity: DataFrame
    lengths: DataFrame
    refs: DataFrame
    cutoffs: DataFrame
    scorecard: DataFrame
    profile_excluded: DataFrame
    annotate_excluded: DataFrame
    profile: DataFrame | None = None
    extra_manifest: DataFrame | None = None

    def write(self, path: str) -> None:
        """Write every table under ``path``, partitioned by release."""
        for field, df in vars(self).items():
            if isinstance(df, DataFrame):
                write_release(df, f"{path}/{field}", self.name)


def _selected(catalogue: DataFrame, families: DataFrame, max_positive: int | None, max_negative: int | None, seed) -> DataFrame:
    """The raw snapshot of a release: both labels selected from the catalogue, within their caps."""
    chosen = select.select_sequences(catalogue, families, "positive").unionByName(
        select.select_sequences(catalogue, families, "negative")
    )
    caps = families.select("family", F.lit("positive").alias("label"), F.coalesce("max_positive", F.lit(max_positive).cast("int")).alias("max_n")).unionByName(
        families.select("family", F.lit("negative").alias("label"), F.coalesce("max_negative", F.lit(max_negative).cast("int")).alias("max_n"))
    )
    columns = ["family", "label", "accession", "organism", "seq"]
    return materialize(select.capped_sample(chosen, caps, seed).select(*columns).withColumn("length", F.length("seq")))


def build_release(
    catalogue: DataFrame,
    families: DataFrame,
    name: str,
    extra: DataFrame | None = None,
    alignment: DataFrame | None = None,
    max_positive: int | None = None,
    max_negative: int | None = None,
    split_mode: str = "random",
    seed=42,
    k: int = 5,
    min_identity: float = 0.90,
    use_domains: bool = True,
    raw: DataFrame | None = None,
) -> Release:
    """One release from a catalogue ``(accession, gene_names, domains, lineage, organism, seq)``.

    Cutoffs come from each family's own search scores: held-out positives and negatives against
    the assembled references (percentile policy). ``alignment`` (aligned train positives) adds
    trimmed profiles. A subset of families is just another ``families`` table and ``name``.
    ``raw``, the stored ``sequences`` of an earlier run, takes the place of the selection: derived
    tables are always made anew from it, so other thresholds give what a fresh run would.
    """
    if split_mode not in ("random", "taxonomy"):
        raise ValueError(f"split_mode must be random or taxonomy, not {split_mode!r}")
    select.check_unique_models(families)
    if raw is None:
        raw = _selected(catalogue, families, max_positive, max_negative, seed)
    columns = ["family", "label", "accession", "organism", "seq", "length"]
    raw = raw.select(*columns).join(families.select("family"), "family", "left_semi")
    negatives = raw.filter("label = 'negative'")
    positives = raw.filter("label = 'positive'")
    hits = similarity.similarity_join(negatives, positives, k)
    checked = materialize(qc.negative_purity(negatives, hits))
    pure = positives.unionByName(checked.filter("not flagged").select(*raw.columns))

    domains = catalogue.select("accession", "domains") if use_domains else None
    classified = materialize(qc.length_outliers(pure, families, domains))
    kept = classified.filter(F.col("outcome").isin("kept", "too_few")).select(*raw.columns)
    manifest = None
    if extra is not None:
        added, manifest = qc.add_extra_positives(kept.filter("label = 'positive'"), extra)
        kept = kept.unionByName(added.select(*raw.columns))
    clusters = cluster_greedy(kept, min_identity)
    unique = materialize(kept.join(
        clusters.filter("accession = representative").select("family", "label", "accession"), ["family", "label", "accession"], "left_semi"
    ))
    make = split.split_random if split_mode == "random" else split.split_by_genus
    parts = materialize(make(unique, seed=seed))

    pairs = select.fusion_pairs(families)
    candidates = classified.filter(F.col("outcome").isin("fusion", "contaminant"))
    fractions = qc.domain_fractions(positives, catalogue.select("accession", "domains"))
    dedicated = refs.select_fused(catalogue, qc.fusion_domain_pair(families, fractions), families)
    searchable = materialize(
        refs.assemble_refs(parts, refs.decoy_refs(parts, families), refs.fusion_refs(pairs, candidates, dedicated))
    )

    # Negatives are scored whole, split or not; a family without test positives scores all it has.
    tested = parts.filter("label = 'positive' and split = 'test'").select(*raw.columns)
    untested = unique.filter("label = 'positive'").join(materialize(tested.select("family").distinct()), "family", "left_anti")
    queries = tested.unionByName(untested.select(*raw.columns)).unionByName(unique.filter("label = 'negative'").select(*raw.columns))
    found = similarity.similarity_join(queries.select("family", "accession", "seq"), searchable, k, CALIBRATION_EVALUE)
    scores = calibrate.restricted_best(
        queries.select("family", "label", F.col("accession").alias("query_id")),
        found.select("family", F.col("accession").alias("query_id"), "bitscore"),
    )
    cutoffs = materialize(calibrate.calibrate(scores, "percentile", families))
    purity = qc.purity_manifest(checked)
    lengths = qc.length_manifest(classified)
    profile = None
    if alignment is not None:
        trimmed = aln.trim_alignment(alignment, families).withColumnRenamed("trimmed", "aligned")
        profile = aln.build_profile(trimmed)
    return Release(
        name, raw, parts, purity, lengths, searchable, cutoffs,
        scorecard.qc_scorecard(families, purity, lengths, cutoffs),
        select.excluded_families(families, "profile"),
        select.excluded_families(families, "annotate"),
        profile, manifest,
    )
