"""Headered TSV tables, id lists, and release-partitioned parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_manifest(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """A headered TSV table; blank cells are null. Columns are strings unless ``schema`` is given."""
    reader = spark.read.option("header", True).option("sep", "\t")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_domains(spark: SparkSession, path) -> DataFrame:
    """``(accession, domains)`` from a TSV whose second column is a ``;``-joined list."""
    raw = read_manifest(spark, path, "accession string, pfam_domains string")
    listed = F.filter(F.split(F.coalesce("pfam_domains", F.lit("")), ";"), lambda d: d != "")
    return raw.select("accession", listed.alias("domains"))


def _in_order(df: DataFrame) -> DataFrame:
    """Rows in the order of the config, where the table carries it."""
    return df.orderBy("ord") if "ord" in df.columns else df


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Headered TSV, in config order if there is an ``ord``; array columns are joined by ``;``."""
    df = _in_order(df)
    flat = [F.array_join(n, ";").alias(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes]
    df.select(*flat).write.mode(mode).option("header", True).csv(path, sep="\t")


def write_id_list(df: DataFrame, path: str, column: str = "family", mode: str = "error") -> None:
    """One value per line, in config order if there is an ``ord``."""
    _in_order(df).select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_release(df: DataFrame, path: str, release: str) -> None:
    """Write a table of one release; other releases under ``path`` stay as they are."""
    (
        df.withColumn("release", F.lit(release))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("release")
        .parquet(path)
    )


def derived_partition(spark: SparkSession, path: str, release: str) -> DataFrame:
    """One release of a table written by ``write_release`` (a pruned partition scan)."""
    return spark.read.parquet(path).filter(F.col("release") == release)
