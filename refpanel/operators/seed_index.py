"""A seed index of reference sequences that is kept on disk, refreshed by release and searched in place.

The index is a folder with four tables. ``seeds`` holds the first position of every k-mer of every
distinct sequence, bucketed by the columns that a search joins on, so a search moves its queries
to the buckets and leaves the index where it is. ``sequences`` holds the distinct sequences, by
the same batches, and numbers them. ``members`` says which sequences a release has, ``settings`` how the
index was made. A release adds one batch with only those sequences that no earlier batch has.

There is a seed for almost every letter, so a seed is few bytes: it names its sequence by number, and
numbers and positions are stored as differences to the row before. Seeds move to their buckets in
``ROUNDS`` rounds, each of some of the sequences, so that shuffle files of one round are on disk at a time.

A batch counts once its name stands in ``batches``, which is written last: what a broken run left
behind is never read, and the run can simply be repeated.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refpanel.operators.similarity import MAX_EVALUE, align_pairs, best_hits, by_sequence, distinct_sequences, kmer_rows
from refpanel.session import discard, local_table, materialize, shuffles_removed

#: Rounds in which the seeds of a batch move, and letters from which there are several.
ROUNDS = 16
ROUND_LETTERS = 4_000_000
_SEEDS = "family STRING, n BIGINT, kmer STRING, pos INT, batch STRING"
_SEQUENCES = "family STRING, digest STRING, seq STRING, batch STRING, n BIGINT"
# How seeds are written: differences of numbers need the second page format, and no dictionary in their way.
_STORED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#n": "false", "parquet.enable.dictionary#pos": "false"}
_MEMBERS = "family STRING, accession STRING, digest STRING, release STRING"
_BATCHES = "batch STRING, release STRING"
_SETTINGS = "k INT, same_family BOOLEAN, buckets INT"


def create_seed_index(spark: SparkSession, folder: str, k: int = 5, same_family: bool = True, buckets: int | None = None) -> None:
    """An empty index in the new ``folder``, which all machines reach.

    With ``same_family`` searches meet references of the query's family only. ``buckets``
    (by default the session's shuffle partitions) is the parallelism of later searches.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([(k, same_family, buckets)], _SETTINGS).coalesce(1).write.parquet(f"{folder}/settings")
    for name, schema in (("members", _MEMBERS), ("batches", _BATCHES), ("sequences", _SEQUENCES)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}/start=0")


def _settings(spark: SparkSession, folder: str):
    return spark.read.schema(_SETTINGS).parquet(f"{folder}/settings").first()


def _key(settings) -> list[str]:
    return ["family", "kmer"] if settings.same_family else ["kmer"]


def _seed_table(spark: SparkSession, folder: str, settings) -> str:
    """Name of the bucketed seed table in this session's catalogue; its data are in ``folder``."""
    name = f"seeds_{hashlib.md5(folder.encode()).hexdigest()}"
    key, options = ", ".join(_key(settings)), ", ".join(f"'{k}'='{v}'" for k, v in _STORED.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_SEEDS}) USING parquet OPTIONS ({options}) PARTITIONED BY (batch) "
        f"CLUSTERED BY ({key}) SORTED BY ({key}, n) INTO {settings.buckets} BUCKETS LOCATION '{folder}/seeds'"
    )
    return name


def _stored(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/{name}")


def _batches(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished batches, one for each release written."""
    return sorted(r.batch for r in _stored(spark, folder, "batches", _BATCHES).collect())


def _of_finished(rows: DataFrame, batches: list[str]) -> DataFrame:
    return rows.filter(F.col("batch").isin(batches)) if batches else rows.filter(F.lit(False))


def add_release(refs: DataFrame, folder: str, release: str) -> None:
    """Adds ``refs(family, accession, seq)`` to the index as ``release``.

    Null sequences have no seeds and are left out; other columns are ignored. Sequences of
    earlier releases are not indexed again. A release that is there already raises.
    """
    spark = refs.sparkSession
    settings = _settings(spark, folder)
    if release in {r.release for r in _stored(spark, folder, "batches", _BATCHES).collect()}:
        raise ValueError(f"the index has release {release} already")
    batches, batch = _batches(spark, folder), uuid.uuid4().hex
    rows = refs.filter("family IS NOT NULL AND seq IS NOT NULL").select("family", "accession", "seq", F.md5("seq").alias("digest"))
    known = _of_finished(_stored(spark, folder, "sequences", _SEQUENCES), batches).select("family", "digest")
    with shuffles_removed(spark):
        new = rows.join(known, ["family", "digest"], "left_anti").groupBy("family", "digest").agg(F.first("seq").alias("seq"))
        stored = materialize(new.withColumn("_id", F.monotonically_increasing_id()))
        new = _numbered(stored).withColumn("batch", F.lit(batch)).select("family", "digest", "seq", "batch", "n")
        new.write.option("compression", "zstd").parquet(f"{folder}/sequences/{batch}")
        discard(stored)
        new = _of_finished(_stored(spark, folder, "sequences", _SEQUENCES), [batch])
        _add_seeds(new, batch, _seed_table(spark, folder, settings), settings)
    named = rows.withColumn("release", F.lit(release)).select("family", "accession", "digest", "release")
    named.write.parquet(f"{folder}/members/{batch}")
    local_table(spark, [(batch, release)], spark.createDataFrame([], _BATCHES).schema).coalesce(1).write.parquet(f"{folder}/batches/{batch}")


def _numbered(stored: DataFrame) -> DataFrame:
    """``stored(_id)`` with numbers ``n`` from 0 with few gaps, from ids that tell parts and rows in them."""
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    parts = stored.agg(F.max(part)).first()[0] or 0
    return stored.withColumn("n", row * (parts + 1) + part).drop("_id")


def _add_seeds(new: DataFrame, batch: str, table: str, settings) -> None:
    """Writes the first positions of every k-mer of ``new(family, seq, n)`` of a batch to their buckets."""
    last, letters = new.agg(F.max("n"), F.sum(F.length("seq"))).first()
    rounds = max(1, min(ROUNDS, (letters or 0) // ROUND_LETTERS))
    size = -(-((last or 0) + 1) // rounds)
    for k in range(rounds):
        mine = new.filter((F.col("n") >= k * size) & (F.col("n") < (k + 1) * size))
        seeds = kmer_rows(by_sequence(mine, ["family", "n"]), ["family", "n"], settings.k)
        seeds = seeds.groupBy("family", "n", "kmer").agg(F.min("pos").alias("pos"))
        # One writer for each bucket, so that a bucket is one file in each round.
        seeds = seeds.repartition(settings.buckets, *_key(settings)).withColumn("batch", F.lit(batch))
        seeds.select("family", "n", "kmer", "pos", "batch").write.insertInto(table)


def release_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """``(family, r_id, kmer, r_pos)`` of all finished batches, in their buckets."""
    name = _seed_table(spark, folder, _settings(spark, folder))
    spark.catalog.recoverPartitions(name)  # batches that other sessions added
    rows = _of_finished(spark.table(name), _batches(spark, folder))
    return rows.select("family", F.struct("family", "batch", "n").alias("r_id"), "kmer", F.col("pos").alias("r_pos"))


def indexed_search(queries: DataFrame, folder: str, release: str, max_evalue: float | None = MAX_EVALUE) -> DataFrame:
    """What ``similarity_join`` gives for ``queries`` and the references of ``release``, from the index.

    Copies among the references stand under their lowest accession. An unknown release raises.
    """
    spark = queries.sparkSession
    settings = _settings(spark, folder)
    mine = {r.batch for r in _stored(spark, folder, "batches", _BATCHES).filter(F.col("release") == release).collect()}
    if not mine:
        raise ValueError(f"the index has no release {release}")
    group = ["family"] if settings.same_family else []
    q, members = distinct_sequences(queries.select(*group, "accession", "seq"), group, settings.k)
    held = spark.read.schema(_MEMBERS).parquet(*(f"{folder}/members/{b}" for b in mine))
    # The lowest accession of a sequence; sequences of other releases drop out here.
    held = materialize(held.groupBy("family", "digest").agg(F.min("accession").alias("subject_id")))
    sequences = _of_finished(_stored(spark, folder, "sequences", _SEQUENCES), _batches(spark, folder))
    refs = sequences.join(held, ["family", "digest"], "left_semi").select("family", F.struct("family", "batch", "n").alias("id"), "seq")
    totals = refs.groupBy(*group).agg(F.sum(F.length("seq")).cast("long").alias("total"))
    if settings.same_family:
        refs = refs.join(materialize(totals), "family")
    else:
        refs = refs.drop("family").withColumn("total", F.lit(totals.first()["total"] or 0).cast("long"))
    seeds = release_seeds(spark, folder)
    seeds = seeds if settings.same_family else seeds.drop("family")
    target = [F.col("q_id"), F.col("r_id.family")]
    hits = align_pairs(None, q, refs, group, settings.k, max_evalue, target, ref_seeds=seeds)
    named = sequences.select("family", "digest", F.struct("family", "batch", "n").alias("r_id")).join(held, ["family", "digest"]).select("r_id", "subject_id")
    hits = hits.withColumn("family", F.col("r_id.family")).join(named, "r_id")
    return best_hits(hits, members, group)
