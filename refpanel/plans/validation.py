"""Recall on reads of an annotated genome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.operators import metrics as m
from refpanel.operators import regions as rg


def validate_genome(headers: DataFrame, orf_map: DataFrame, reads: DataFrame, hits: DataFrame, read_length: int = 150, min_bp: int = 20) -> DataFrame:
    """Recall and precision per family and method on reads whose ids carry their coordinates.

    Regions come from the confirmed ORFs, in family order; reads with other ids are left out.
    """
    found, _ = rg.extract_regions(headers, orf_map)
    # A handful of confirmed target genes; families in name order, as written by the extractor.
    regions = found.withColumn("ord", F.col("family"))
    placed = rg.parse_read_coords(reads.select("read_id"), read_length).filter("parsed").select("read_id", "contig", "start", "end")
    truth = rg.overlap_regions(placed, regions, min_bp)
    return m.compare_recall(truth, m.best_hit(hits, keys=("method", "read_id")))
