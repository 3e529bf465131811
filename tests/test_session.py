"""Stored tables: what they take of the disk."""

from pyspark.sql import functions as F

from refpanel.session import materialize


def test_stored_tables_are_packed_with_zstd(spark):
    texts = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("seq"))
    stored = materialize(texts)
    assert stored.count() == 2000 and stored.exceptAll(texts).isEmpty()
    assert all(".zstd." in f for f in stored.inputFiles())
