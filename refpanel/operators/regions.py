"""Genomic regions: gene-caller headers, read coordinates, range join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = 1000
READ_LENGTH = 150
MIN_OVERLAP = 20
COORDINATES = r"^(.+)_(\d+)_(\d+)_\d+:\d+:\d+_\d+:\d+:\d+_[0-9a-f]+/([12])$"


def extract_regions(headers: DataFrame, orf_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions of confirmed ORFs from gene-caller headers, and the confirmed families not found.

    ``headers(header)`` like ``contig_n # start # end # strand # attrs``; ``orf_map(family, orf_id)``.
    The last header wins for a repeated family (by start).
    """
    fields = F.split("header", "#")
    parsed = headers.select(
        F.split(F.trim(fields[0]), "\\s+")[0].alias("orf_id"),
        F.trim(fields[1]).cast("int").alias("start"),
        F.trim(fields[2]).cast("int").alias("end"),
    )
    found = parsed.join(orf_map, "orf_id").select(
        "family", F.regexp_replace("orf_id", "_[^_]*$", "").alias("contig"), "start", "end"
    )
    one = found.groupBy("family").agg(F.max(F.struct("start", "end", "contig")).alias("r"))
    regions = one.select("family", F.col("r.contig").alias("contig"), F.col("r.start").alias("start"), F.col("r.end").alias("end"))
    missing = orf_map.join(regions, "family", "left_anti").select("family").distinct()
    return regions, missing


def parse_read_coords(reads: DataFrame, read_length: int = READ_LENGTH) -> DataFrame:
    """Contig, start and end (1-based inclusive) from ids with embedded coordinates.

    ``parsed`` is false for other ids. The mate picks which of the two starts applies.
    """
    part = lambda i: F.regexp_extract("read_id", COORDINATES, i)
    parsed = F.col("read_id").rlike(COORDINATES)
    start = F.when(part(4) == "1", part(2)).otherwise(part(3))
    return (
        reads.withColumn("parsed", parsed)
        .withColumn("contig", F.when(parsed, part(1)))
        .withColumn("start", F.when(parsed, start).cast("long"))
        .withColumn("end", F.col("start") + (read_length - 1))
    )


def overlap_regions(reads: DataFrame, regions: DataFrame, min_bp: int = MIN_OVERLAP, bin_size: int = BIN) -> DataFrame:
    """Add ``family``: the first region (by ``ord``) each read overlaps by ``min_bp``, else ``background``.

    ``reads(read_id, contig, start, end)``, ``regions(family, contig, start, end, ord)``, 1-based
    inclusive. Both sides are cut into bins, so a long contig spreads over its bins; a pair
    is compared only in the first bin the two share. Read ids are unique.
    """
    def binned(df: DataFrame) -> DataFrame:
        span = F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("end") / bin_size))
        return df.withColumn("_bin", F.explode(span))

    r = binned(regions.select(F.col("family").alias("_family"), "contig", F.col("start").alias("_rs"), F.col("end").alias("_re"), "ord", "start", "end")).drop("start", "end")
    # The comparison belongs to the join condition, so reads without a region stay in.
    near = (
        (F.col("a.contig") == F.col("b.contig"))
        & (F.col("a._bin") == F.col("b._bin"))
        & (F.col("a._bin") == F.floor(F.greatest("a.start", "b._rs") / bin_size))
        & (F.least("a.end", "b._re") - F.greatest("a.start", "b._rs") + 1 >= min_bp)
    )
    # A plan counts regions as they are before they are cut into bins, so it would broadcast many more rows than it knows.
    matched = binned(reads).alias("a").join(r.alias("b").hint("merge"), near, "left")
    return (
        matched.groupBy(*[F.col(f"a.{c}") for c in reads.columns])
        .agg(F.min(F.when(F.col("b.ord").isNotNull(), F.struct("b.ord", "b._family"))).alias("m"))
        .select(*reads.columns, F.coalesce("m._family", F.lit("background")).alias("family"))
    )
