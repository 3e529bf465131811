"""Scans of search results: headerless hit tables and profile-search tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refpanel.functions import orf_to_read, read_family

# Column order of a headerless hit table, and their types.
HIT_COLUMNS = "qseqid string, sseqid string, pident double, qcov double, scov double, length int, evalue double, bitscore double"


def read_hits_tsv(spark: SparkSession, path, suffix: str = ".blastx.tsv") -> DataFrame:
    """Hits of headerless 8-column files; missing trailing columns are null, empty files give no rows.

    The sample is the file name without ``suffix``; the family is the subject up to its first ``|``.
    Identity and covers stand in the file as percent and are returned as fractions, the unit of all
    hit tables here.
    """
    raw = spark.read.schema(HIT_COLUMNS).csv(path, sep="\t", mode="PERMISSIVE", enforceSchema=True)
    name = F.regexp_extract("_metadata.file_name", "^(.*?)" + suffix.replace(".", "\\.") + "$", 1)
    return raw.select(
        F.lit("search").alias("method"),
        name.alias("sample"),
        F.col("qseqid").alias("read_id"),
        F.col("sseqid").alias("subject_id"),
        read_family("sseqid").alias("family"),
        *[(F.col(c) / 100).alias(c) for c in ("pident", "qcov", "scov")],
        F.col("length").alias("aln_length"),
        "evalue", "bitscore",
    )


def read_tblout(spark: SparkSession, path, suffix: str = ".hmmscan.tblout") -> DataFrame:
    """Hits of whitespace-separated profile-search tables: fields 0 (family), 2 (query), 5 (score).

    Comment and blank lines are skipped; an ORF query is mapped back to its read.
    """
    fields = F.split(F.trim("value"), "\\s+")
    name = F.regexp_extract("_metadata.file_name", "^(.*?)" + suffix.replace(".", "\\.") + "$", 1)
    return (
        spark.read.text(path)
        .filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
        .select(
            F.lit("profile").alias("method"),
            name.alias("sample"),
            fields[2].alias("query_id"),
            orf_to_read(fields[2]).alias("read_id"),
            fields[0].alias("family"),
            fields[5].cast("double").alias("bitscore"),
        )
    )
