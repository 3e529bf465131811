"""Training-data pipeline over ``documents``: the stages in order, each written and read again.

All but the last stage return the columns of ``documents``. Rows are judged by themselves: ids may
be null or repeat. Empty tables go through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refpanel.llm import decontaminate, near_dedup, pieces, sanitise, toxicity
from refpanel.llm.common import discard, scratch, ship_code, store, table

#: SQL cannot express the toxicity model, the min-max hashes or the tokenizer; the tests compare
#: the stages with plain versions.
ORACLE_SQL = None
#: Words of a shingle in the near-duplicate stage.
SHINGLE_WORDS = 4


def _free(docs: DataFrame) -> str:
    """A name that no column of ``docs`` has."""
    name = "_row"
    while name in map(str.lower, docs.columns):
        name += "_"
    return name


def _content() -> Column:
    """Digest of id and text. Rows that share it get the same verdict from anything that reads the
    text alone."""
    part = lambda c: F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("null"))
    return F.sha2(F.concat_ws(":", part("doc_id"), part("text")), 256)


def _without(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not among those of ``dropped``, without the key."""
    gone = store(dropped.select(F.col(key)).distinct(), "dropped")
    return docs.join(gone, key, "left_anti").drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    ship_code(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (four-word shingles, as for ``op3``) stays, one with
    the smallest id (null is the largest)."""
    ship_code(spark)
    key, columns = _free(docs), docs.columns
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("n"))
    docs = store(docs.withColumn(key, row), "rows")  # stored: the numbers must not change
    return _without(docs, key, near_dedup.near_duplicates(docs, SHINGLE_WORDS, id_col=key).filter("NOT kept")).select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which test windows cover 5 % or more go."""
    key = _free(docs)
    docs = docs.withColumn(key, _content())
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), slop=0, id_col=key)
    return _without(docs, key, found.filter("contaminated"))


def sanitise_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced; ``n_chars`` follows the text."""
    done = sanitise.sanitise(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digest of the text they decode to."""
    ship_code(spark)
    found = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal-data", sanitise_texts),
    ("encoding", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage stored for itself goes as soon as its output is written, and
    so does the output of the stage before."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs = store(stage(spark, docs, sf_dir), name, keep=True)
        if last is not None:
            discard(last)
        last = docs
    return docs
