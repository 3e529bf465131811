"""Round trips through the reference's file formats, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from refpanel import sources
from refpanel.operators.sketches import merged_manifest, release_sketches
from refpanel.session import checkpoint_root
from refpanel.workload import standins as s

QUERIES = {}
SQL: dict[str, str] = {}


def _folder(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def fasta_roundtrip(spark, d):
    """Documents written as wrapped FASTA and scanned back."""
    docs = s.documents(spark, d).select(
        F.concat(F.col("lang"), F.lit("|"), F.col("doc_id").cast("string"), F.lit("|"), F.col("source")).alias("header"),
        F.regexp_replace(F.lower("text"), "[^a-z]", "").alias("seq"),
    )
    path = _folder(spark)
    sources.write_fasta(docs, path)
    return sources.read_fasta(spark, path).select("header", F.length("seq").alias("n"), F.md5("seq").alias("digest"))


def fastq_scan(spark, d):
    """Conversation turns written as FASTQ text and scanned back."""
    path = f"{_folder(spark)}/talk_R1.fastq"
    seq = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), s.DNA_FROM, s.DNA_TO)
    name = F.concat(F.lit("@t"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit(" extra"))
    rows = s.table(spark, d, "conversations").select(name.alias("n"), F.concat(F.lit("A"), seq).alias("s"))
    # Quality signs start with @ or + in turn, the two that could be taken for another line.
    sign = F.when(F.length("s") % 2 == 0, "@").otherwise("+")
    text = F.concat_ws("\n", "n", "s", F.lit("+"), F.concat(sign, F.repeat(F.lit("I"), F.length("s") - 1)))
    rows.select(text.alias("value")).write.text(path)
    return sources.read_fastq(spark, path).select("read_id", "read_length", F.md5("seq").alias("digest"))


def paired_samples(spark, d):
    """Conversation turns as reads: a conversation is a sample, odd and even turns are its mates."""
    turns = s.table(spark, d, "conversations")
    rows = turns.select(F.col("conv_id").cast("string").alias("sample"), (F.col("turn") % 2 + 1).cast("int").alias("mate"), F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("read_id"))
    return sources.paired_samples(rows)


def hits_scan(spark, d):
    """Line items written as headerless hit files and scanned back."""
    path = _folder(spark)
    hits = s.hits(spark, d).filter("method = 'search'")
    rows = hits.select("read_id", F.concat("family", F.lit("|"), "subject_id"), *[F.col(c) * 100 for c in ("pident", "qcov", "scov")], F.lit(50), F.lit(0.001), "bitscore")
    rows.write.csv(path, sep="\t")
    return sources.read_hits_tsv(spark, path).select("read_id", "subject_id", "family", "pident", "qcov", "scov", "bitscore")


def tblout_scan(spark, d):
    """Line items written as whitespace-separated profile tables and scanned back."""
    path = _folder(spark)
    line = s.table(spark, d, "lineitem")
    orf = F.concat(F.col("l_orderkey").cast("string"), F.lit("/1_"), F.col("l_linenumber").cast("string"), F.lit("_2_3"))
    row = F.concat_ws("  ", F.concat(F.lit("fam"), F.col("l_suppkey").cast("string")), F.lit("-"), orf, F.lit("-"), F.lit("1e-5"), F.col("l_extendedprice").cast("string"), F.lit("0.1"))
    line.select(F.explode(F.array(F.lit("# a comment line"), row, F.lit(""))).alias("value")).write.text(path)
    return sources.read_tblout(spark, path).select("read_id", "family", "bitscore")


def manifest_scan(spark, d):
    """Part domains written as a headered TSV with joined lists and scanned back."""
    path = _folder(spark)
    sources.write_tsv(s.domains(spark, d).withColumnRenamed("domains", "pfam_domains"), path)
    return sources.read_domains(spark, path).select("accession", F.array_join("domains", ",").alias("domains"))


def release_partitions(spark, d):
    """Two releases written under one path, the first written twice; the first is read back."""
    path = _folder(spark)
    suppliers = s.table(spark, d, "supplier")
    sources.write_release(suppliers.withColumn("n", F.lit(1)), path, "v1")
    sources.write_release(suppliers.withColumn("n", F.lit(2)), path, "v2")
    sources.write_release(suppliers.withColumn("n", F.lit(3)), path, "v1")
    return sources.derived_partition(spark, path, "v1").select("s_suppkey", "n", "release")


def diversity_merged(spark, d):
    """Documents as three releases that store their sketches; what those say together, held against
    the exact numbers: within 5 % of the distinct organisms and 3 % of the ranks around the median."""
    path, seqs = _folder(spark), s.doc_sequences(spark, d)
    for k in range(3):
        sources.write_release(release_sketches(seqs.filter(F.col("accession").cast("long") % 3 == k)), path, f"r{k}")
    merged = merged_manifest(spark.read.parquet(path))
    share = lambda c: F.avg(c.cast("int"))
    exact = seqs.join(merged, ["family", "label"]).groupBy("family", "label", "n", "n_organisms").agg(
        F.countDistinct("organism").alias("o"),
        F.least(share(F.col("length") <= F.col("median_length")), share(F.col("length") >= F.col("median_length"))).alias("side"),
    )
    near = F.abs(F.col("n_organisms") - F.col("o")) <= F.greatest(F.lit(1.0), 0.05 * F.col("o"))
    return exact.select("family", "label", "n", near.alias("organisms_close"), (F.col("side") >= 0.47).alias("median_close"))


for _fn in (fasta_roundtrip, fastq_scan, paired_samples, hits_scan, tblout_scan, manifest_scan, release_partitions, diversity_merged):
    QUERIES[_fn.__name__] = _fn

_DNA = f"translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{s.DNA_FROM}', '{s.DNA_TO}')"
SQL["fasta_roundtrip"] = """SELECT lang || '|' || doc_id || '|' || source AS header, CAST(length(z) AS INTEGER) AS n, md5(z) AS digest
FROM (SELECT *, regexp_replace(lower(text), '[^a-z]', '', 'g') AS z FROM documents)"""
SQL["fastq_scan"] = f"SELECT 't' || conv_id || '_' || turn AS read_id, CAST(length(z) AS INTEGER) AS read_length, md5(z) AS digest FROM (SELECT *, 'A' || {_DNA} AS z FROM conversations)"
SQL["hits_scan"] = f"WITH {s.HITS} SELECT read_id, family || '|' || subject_id AS subject_id, family, (pident * 100) / 100 AS pident, (qcov * 100) / 100 AS qcov, (scov * 100) / 100 AS scov, bitscore FROM hits WHERE method = 'search'"
SQL["tblout_scan"] = "SELECT l_orderkey || '/1' AS read_id, 'fam' || l_suppkey AS family, l_extendedprice AS bitscore FROM lineitem"
SQL["manifest_scan"] = "SELECT CAST(p_partkey AS VARCHAR) AS accession, replace(p_name, ' ', ',') AS domains FROM part"
SQL["diversity_merged"] = f"WITH {s.DOC_SEQS} SELECT family, label, count(*) AS n, TRUE AS organisms_close, TRUE AS median_close FROM seqs GROUP BY 1, 2"
SQL["release_partitions"] = "SELECT s_suppkey, 3 AS n, 'v1' AS release FROM supplier"
SQL["paired_samples"] = """WITH r AS (SELECT CAST(conv_id AS VARCHAR) AS sample, CAST(turn % 2 + 1 AS INTEGER) AS mate, conv_id || '_' || turn AS read_id FROM conversations)
SELECT * FROM r WHERE sample IN (SELECT sample FROM r GROUP BY 1 HAVING count(DISTINCT mate) = 2)"""
