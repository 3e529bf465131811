"""FASTA scan and sink."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refpanel.functions import header_accession, organism_of

WRAP = 60
_EMPTY = "header string, seq string, file string"


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """``(header, seq, file)`` of FASTA files; a path without files gives no rows.

    Records are the text between ``\\n>`` marks, so files split across tasks at record borders.
    """
    try:
        raw = spark.read.text(path, lineSep="\n>").select("value", F.col("_metadata.file_path").alias("file"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _EMPTY)
    record = F.regexp_replace("value", "^>", "")
    header = F.regexp_replace(F.split_part(record, F.lit("\n"), F.lit(1)), "\\r$", "")
    body = F.when(F.instr(record, "\n") > 0, F.regexp_replace(F.regexp_replace(record, "^[^\\n]*\\n", ""), "\\s", ""))
    return (
        raw.filter(F.trim("value") != "")
        .select(header.alias("header"), F.coalesce(body, F.lit("")).alias("seq"), "file")
    )


def retag(raw: DataFrame, tag: str | None = None) -> DataFrame:
    """Add ``tag``, ``accession``, ``organism`` and the rebuilt ``tagged`` header.

    ``tag`` names the tag; without it the table's ``tag`` column is used.
    """
    tagged = raw if tag is None else raw.withColumn("tag", F.lit(tag))
    parts = F.split("header", "\\|")
    accession = F.when(F.size(parts) >= 2, header_accession("header")).otherwise(F.trim(parts[0]))
    return (
        tagged.withColumn("accession", accession)
        .withColumn("organism", organism_of("header"))
        .withColumn("tagged", F.concat_ws("|", "tag", "accession", "organism"))
    )


def write_fasta(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write ``header`` and ``seq`` as FASTA, 60 residues a line."""
    wrapped = F.regexp_replace("seq", f"(.{{{WRAP}}})(?=.)", "$1\n")
    df.select(F.concat(F.lit(">"), "header", F.lit("\n"), wrapped).alias("value")).write.mode(mode).text(path)
