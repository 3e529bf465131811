"""FASTQ scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = r"([^/]+)_R([12])\.fastq(?:\.gz)?$"
# An id line and a sequence line at the very end of a piece. An empty sequence leaves a line break
# there, as does the end of the file after the last quality line; what stands before tells them
# apart: nothing (first read), separator and quality, or the rest of a quality that begins with +.
_READ = r"(?s)(?:^|\n)@(\S+)[^\n]*\n([^\n]+)\z"
_EMPTY = r"(?s)^(?:[^\n]*\n[^\n]*\n|[^\n]+\n)?@(\S+)[^\n]*\n\z"


def read_fastq(spark: SparkSession, path) -> DataFrame:
    """``(sample, mate, read_id, seq, read_length)`` of plain or gzipped four-line FASTQ files.

    The text is cut before every ``+`` that starts a line. Such a ``+`` is either the separator
    line, and then the two lines before it are id and sequence; or the first quality sign, and
    then the piece before it is a bare separator without a line break. So the last two lines of
    a piece, if the first of them starts with ``@``, are a read: no line numbers are needed and
    plain files split across tasks. Reads of length 0 are kept. Sample and mate come from the file
    name.
    """
    pieces = spark.read.text(path, lineSep="\n+").select(
        F.regexp_replace("value", "\r", "").alias("value"), F.col("_metadata.file_path").alias("file")
    )
    full = F.col("value").rlike(_READ)
    read_id = F.when(full, F.regexp_extract("value", _READ, 1)).otherwise(F.regexp_extract("value", _EMPTY, 1))
    return pieces.filter(full | F.col("value").rlike(_EMPTY)).select(
        F.regexp_extract("file", _NAME, 1).alias("sample"),
        F.regexp_extract("file", _NAME, 2).cast("int").alias("mate"),
        read_id.alias("read_id"),
        F.regexp_extract("value", _READ, 2).alias("seq"),
        F.length(F.regexp_extract("value", _READ, 2)).alias("read_length"),
    )


def paired_samples(reads: DataFrame) -> DataFrame:
    """Reads of samples that have both mates; a sample with only one file is skipped."""
    both = reads.select("sample", "mate").distinct().groupBy("sample").agg(F.count(F.lit(1)).alias("n")).filter("n = 2")
    return reads.join(both.select("sample"), "sample", "left_semi")
