"""Benchmark of search methods on reads with known truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.operators import metrics as m
from refpanel.operators.alignment import build_profile, profile_scan, trim_alignment
from refpanel.operators.reads import read_truth, translate_orfs, with_background
from refpanel.operators.seed_index import indexed_search
from refpanel.operators.similarity import MAX_EVALUE, similarity_join
from refpanel.session import materialize


def _with_read(found: DataFrame, orfs: DataFrame, orf_col: str) -> DataFrame:
    return found.join(orfs.select(F.col("orf_id").alias(orf_col), "read_id"), orf_col)


def search_reads(
    orfs: DataFrame, refs: DataFrame | None, sample: str = "all", k: int = 5, max_evalue: float = MAX_EVALUE, index: tuple[str, str] | None = None
) -> DataFrame:
    """Hits of ``orfs (orf_id, read_id, aa)`` on protein references, one per reading frame and family.

    ``index`` names the folder and the release of a seed index over all families, searched in
    place of ``refs``; its own k-mer length holds.
    """
    wanted = orfs.select(F.col("orf_id").alias("accession"), F.col("aa").alias("seq"))
    found = indexed_search(wanted, *index, max_evalue) if index else similarity_join(wanted, refs, k, max_evalue, same_family=False)
    return _with_read(found, orfs, "accession").select(
        F.lit("search").alias("method"), F.lit(sample).alias("sample"), "read_id", "subject_id", "family",
        (F.col("pident") / 100).alias("pident"), "qcov", "scov", "bitscore",
    )


def profile_reads(orfs: DataFrame, alignment: DataFrame, profile: DataFrame, sample: str = "all", k: int = 5) -> DataFrame:
    """Hits of ``orfs`` on family profiles; they carry a score and no identity or cover."""
    found = profile_scan(orfs.select(F.col("orf_id").alias("accession"), F.col("aa").alias("seq")), alignment, profile, k)
    none = F.lit(None).cast("double")
    return _with_read(found, orfs, "query_id").select(
        F.lit("profile").alias("method"), F.lit(sample).alias("sample"), "read_id", F.col("family").alias("subject_id"), "family",
        none.alias("pident"), none.alias("qcov"), none.alias("scov"), F.col("score").alias("bitscore"),
    )


def benchmark_reads(
    reads: DataFrame,
    contigs: DataFrame,
    refs: DataFrame,
    alignment: DataFrame | None = None,
    background: DataFrame | None = None,
    families: DataFrame | None = None,
    min_aa: int = 32,
    k: int = 5,
    **filters,
) -> dict[str, DataFrame]:
    """The benchmark from reads on: truth by location, translation, both searches, metric tables.

    ``reads(read_id, seq)`` were cut from ``contigs``; ``background(read_id, seq)`` come from
    elsewhere. ``refs(family, accession, seq)`` are searched; ``alignment`` of the train positives,
    trimmed by ``families``, gives the profiles. ``filters`` are those of ``run_benchmark``.
    """
    truth, every = read_truth(reads, contigs), reads.select("read_id", "seq")
    if background is not None:
        truth, every = with_background(truth, background), every.unionByName(background.select("read_id", "seq"))
    orfs = materialize(translate_orfs(every, min_aa))
    hits = search_reads(orfs, refs, k=k)
    if alignment is not None:
        trimmed = trim_alignment(alignment, families).withColumnRenamed("trimmed", "aligned")
        hits = hits.unionByName(profile_reads(orfs, trimmed, build_profile(trimmed), k=k))
    return run_benchmark(materialize(hits), materialize(truth), **filters)


def run_benchmark(
    hits: DataFrame,
    truth: DataFrame,
    min_identity: float = 0.40,
    min_qcov: float = 0.50,
    min_scov: float = 0.0,
    precision_threshold: float = 0.95,
    length_bucket: int = 50,
) -> dict[str, DataFrame]:
    """All metric tables from the hits of both methods and the read truth.

    Cover and identity filters apply to the search method; profile hits carry scores only.
    The labelled reads feed every table, so they are materialised once.
    """
    search = m.filter_hits(hits.filter("method = 'search'"), min_identity, min_qcov, min_scov)
    calls = m.best_hit(search.unionByName(hits.filter("method <> 'search'")))
    labelled = materialize(m.label_reads(calls, truth))
    summary, by_length, background = m.grouped_metrics(labelled, length_bucket)
    best = materialize(m.best_threshold(labelled))
    return {
        "summary": summary,
        "best_threshold": best,
        "by_length": by_length,
        "background": background,
        "roc_auc": m.roc_auc(labelled),
        "pr_auc": m.pr_auc(labelled),
        "cascade": m.cascade_config(summary, best, precision_threshold),
        "panel": m.panel_summary(summary),
    }
