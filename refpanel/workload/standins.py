"""Operator inputs derived from the shared test tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refpanel.sources.families import families_table

TYPES = ["STANDARD", "LARGE", "SMALL", "MEDIUM", "PROMO", "ECONOMY"]
DNA_FROM = "abcdefghijklmnopqrstuvwxyz"
DNA_TO = "ACGTACGTACGTACGTACGTACGTAC"

# Family config for the part-based inputs: a parameter of the queries, like any config.
PART_FAMILIES = [
    dict(family="STANDARD", pos_genes=["STANDARD"], neg_pfam=["ring", "bolt"], exclude_genes=["STANDARD", "LARGE"], taxonomy_id=2, fusion_partner="LARGE", fusion_marker="gear", decoy_from_negatives=True, curated_model="M1"),
    dict(family="LARGE", pos_genes=["LARGE"], neg_pfam=["ring"], exclude_genes=["LARGE"], fusion_partner="STANDARD", fusion_marker="rod", scope="annotate_only", max_negative=50),
    dict(family="SMALL", pos_genes=["SMALL"], neg_pfam=["plate"], neg_genes=["PROMO", "ECONOMY"], exclude_genes=["SMALL"], taxonomy_id=1, negative_median_override=31, decoy_from_negatives=True, max_positive=40),
    dict(family="MEDIUM", pos_genes=["MEDIUM"], neg_pfam=["gizmo"], exclude_genes=["MEDIUM", "SMALL"], exclude_pfam=["hot"], max_positive=100, max_negative=30, trim_gt=0.6),
    dict(family="PROMO", pos_pfam=["widget"], neg_pfam=["anvil"], exclude_pfam=["blue"], fusion_partner="ECONOMY", fusion_marker="anvil", curated_model="M2", length_max_ratio=2.0),
    dict(family="ECONOMY", pos_genes=["ECONOMY"], pos_pfam=["rod"], neg_pfam=["rod", "cold"], exclude_genes=["ECONOMY"], fusion_partner="missing", scope="annotate_only"),
]
LANG_FAMILIES = [
    dict(family="en", decoy_from_negatives=True, trim_gt=0.6),
    dict(family="de", decoy_from_negatives=True),
    dict(family="fr", trim_gt=0.5),
    dict(family="es"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, list):
        return "[" + ", ".join(f"'{v}'" for v in value) + "]"
    return f"'{value}'" if isinstance(value, str) else repr(value)


def config_sql(entries: list[dict]) -> str:
    """The config as a SQL ``VALUES`` table named ``families``."""
    columns = {
        "family": "VARCHAR", "pos_genes": "VARCHAR[]", "pos_pfam": "VARCHAR[]", "neg_pfam": "VARCHAR[]", "neg_genes": "VARCHAR[]",
        "exclude_genes": "VARCHAR[]", "exclude_pfam": "VARCHAR[]", "taxonomy_id": "INTEGER", "scope": "VARCHAR",
        "decoy_from_negatives": "BOOLEAN", "trim_gt": "DOUBLE", "curated_model": "VARCHAR", "fusion_partner": "VARCHAR",
        "fusion_marker": "VARCHAR", "max_positive": "INTEGER", "max_negative": "INTEGER", "negative_median_override": "DOUBLE",
        "length_max_ratio": "DOUBLE",
    }
    rows = []
    for e in entries:
        e = {"decoy_from_negatives": False, **e}
        rows.append("(" + ", ".join(f"CAST({_literal(e.get(c))} AS {t})" for c, t in columns.items()) + ")")
    return f"families({', '.join(columns)}) AS (VALUES {', '.join(rows)})"


def part_families(spark) -> DataFrame:
    return families_table(spark, PART_FAMILIES)


def lang_families(spark) -> DataFrame:
    return families_table(spark, LANG_FAMILIES)


# --- hits, truth, scores -------------------------------------------------------------------


def hits(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    line = table(spark, sf_dir, "lineitem")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("l_returnflag") == "R", "profile").otherwise("search").alias("method"),
        F.col("l_linestatus").alias("sample"),
        F.col("l_orderkey").cast("string").alias("read_id"),
        F.col("l_partkey").cast("string").alias("subject_id"),
        F.col("p_type").alias("family"),
        (1 - F.col("l_discount")).alias("pident"),
        (F.col("l_quantity") / 50).alias("qcov"),
        F.col("l_tax").alias("scov"),
        F.col("l_extendedprice").alias("bitscore"),
    )


HITS = """hits AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'profile' ELSE 'search' END AS method, l_linestatus AS sample,
         CAST(l_orderkey AS VARCHAR) AS read_id, CAST(l_partkey AS VARCHAR) AS subject_id, p_type AS family,
         1 - l_discount AS pident, l_quantity / 50 AS qcov, l_tax AS scov, l_extendedprice AS bitscore
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def truth(spark, sf_dir) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    family = F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("o_custkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("read_id"),
        F.when(urgent, "background").otherwise(family).alias("family"),
        F.when(urgent | (F.col("o_orderstatus") == "P"), "negative").otherwise("positive").alias("label"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), 0).otherwise(1).alias("overlaps_cds"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("read_length"),
    )


TRUTH = f"""truth AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS read_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'background' ELSE {_literal(TYPES)}[o_custkey % 6 + 1] END AS family,
         CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' THEN 'negative' ELSE 'positive' END AS label,
         CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 0 ELSE 1 END AS overlaps_cds,
         CAST(floor(o_totalprice / 1000) AS INTEGER) AS read_length
  FROM orders)"""

BEST = """best AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY method, sample, read_id
                                 ORDER BY bitscore DESC, family, subject_id, pident, qcov, scov) AS rn FROM hits) WHERE rn = 1)"""

LABELLED = """merged AS (
  SELECT m.method, t.read_id, t.family AS family_true, t.label, t.overlaps_cds, t.read_length,
         coalesce(b.family, 'NO_CALL') AS family_called, b.bitscore AS raw_score,
         t.label = 'positive' AND t.overlaps_cds = 1 AS genuine
  FROM truth t CROSS JOIN (VALUES ('search'), ('profile')) m(method)
  LEFT JOIN best b ON b.method = m.method AND b.read_id = t.read_id),
labelled AS (
  SELECT * EXCLUDE raw_score, genuine AND family_called = family_true AS correct,
         coalesce(raw_score, min(raw_score) OVER (PARTITION BY method) - 1.0) AS bitscore
  FROM merged)"""

COUNTS = """count(*) FILTER (family_called = family_true AND genuine) AS tp,
         count(*) FILTER (family_called = family_true AND NOT genuine) AS fp,
         count(*) FILTER (family_called <> family_true AND genuine) AS fn"""
RATES = """CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS "precision",
         CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CASE WHEN tp > 0 THEN CAST(2.0 AS DOUBLE) * tp / (2 * tp + fp + fn) END AS f1"""


def scores(spark, sf_dir) -> DataFrame:
    """Events as scores: ``click`` is shifted apart, ``signup`` has few negatives, ``view`` has none."""
    kind, value = F.col("event_type"), F.col("value")
    positive = (
        F.when(kind == "view", F.lit(True)).when(kind == "signup", value <= 250).otherwise(F.col("user_id") % 3 != 0)
    )
    return table(spark, sf_dir, "events").select(
        kind.alias("family"),
        F.when(positive, "positive").otherwise("negative").alias("label"),
        F.col("event_id").cast("string").alias("query_id"),
        F.when((kind == "click") & positive, value + 1000).otherwise(value).alias("score"),
    )


SCORES = """scores AS (
  SELECT family, label, query_id, CASE WHEN family = 'click' AND label = 'positive' THEN value + 1000 ELSE value END AS score
  FROM (SELECT event_type AS family, value, CAST(event_id AS VARCHAR) AS query_id,
               CASE WHEN event_type = 'view' THEN 'positive'
                    WHEN event_type = 'signup' THEN CASE WHEN value <= 250 THEN 'positive' ELSE 'negative' END
                    WHEN user_id % 3 <> 0 THEN 'positive' ELSE 'negative' END AS label
        FROM events))"""

# --- sequences -----------------------------------------------------------------------------


def catalogue(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("accession"),
        F.array("p_type").alias("gene_names"),
        F.split("p_name", " ").alias("domains"),
        F.array(F.col("p_size") % 5).cast("array<int>").alias("lineage"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("organism"),
        F.col("p_name").alias("seq"),
        F.col("p_size").cast("int").alias("length"),
    )


CATALOGUE = """catalogue AS (
  SELECT CAST(p_partkey AS VARCHAR) AS accession, [p_type] AS gene_names, string_split(p_name, ' ') AS domains,
         [CAST(p_size % 5 AS INTEGER)] AS lineage, replace(p_name, ' ', '_') AS organism, p_name AS seq, p_size AS length
  FROM part)"""


def part_sequences(spark, sf_dir) -> DataFrame:
    """Parts as labelled sequences of the six part families."""
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("family"),
        F.when(F.col("p_partkey") % 3 == 0, "negative").otherwise("positive").alias("label"),
        F.col("p_partkey").cast("string").alias("accession"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("organism"),
        F.col("p_name").alias("seq"),
        F.col("p_size").cast("int").alias("length"),
    )


PART_SEQS = """seqs AS (
  SELECT p_type AS family, CASE WHEN p_partkey % 3 = 0 THEN 'negative' ELSE 'positive' END AS label,
         CAST(p_partkey AS VARCHAR) AS accession, replace(p_name, ' ', '_') AS organism, p_name AS seq, p_size AS length
  FROM part)"""


def domains(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("accession"), F.split("p_name", " ").alias("domains"))


DOMAINS = "domains AS (SELECT CAST(p_partkey AS VARCHAR) AS accession, string_split(p_name, ' ') AS domains FROM part)"


def doc_sequences(spark, sf_dir) -> DataFrame:
    """Documents as labelled sequences, whole texts."""
    return documents(spark, sf_dir).select(
        F.col("lang").alias("family"),
        F.when(F.col("doc_id") % 3 == 0, "negative").otherwise("positive").alias("label"),
        F.col("doc_id").cast("string").alias("accession"),
        F.concat("source", F.lit("_s"), (F.col("doc_id") % 3).cast("string")).alias("organism"),
        F.col("text").alias("seq"),
        F.length("text").alias("length"),
    )


DOC_SEQS = """seqs AS (
  SELECT lang AS family, CASE WHEN doc_id % 3 = 0 THEN 'negative' ELSE 'positive' END AS label,
         CAST(doc_id AS VARCHAR) AS accession, source || '_s' || CAST(doc_id % 3 AS VARCHAR) AS organism,
         text AS seq, length(text) AS length
  FROM documents)"""


def panel(spark, sf_dir) -> DataFrame:
    """Suppliers as a family config that grows with the data."""
    key = F.col("s_suppkey")
    partner = F.when(key % 2 == 0, key + 1).otherwise(key - 1)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("family"),
        F.array(F.concat(F.lit("g"), key.cast("string")), F.concat(F.lit("g"), key.cast("string"), F.lit("x"))).alias("pos_genes"),
        F.array(F.concat(F.lit("PF"), F.col("s_nationkey").cast("string"))).alias("neg_pfam"),
        F.when(key % 2 == 0, F.array(F.concat(F.lit("g"), (key + 25).cast("string")))).alias("exclude_genes"),
        F.when(key % 5 == 0, "annotate_only").alias("scope"),
        (key % 7 == 0).alias("decoy_from_negatives"),
        F.when(key % 4 == 0, F.concat(F.lit("PF"), F.col("s_nationkey").cast("string"))).alias("curated_model"),
        F.when(key % 3 == 0, F.concat(F.lit("Supplier#"), F.lpad(partner.cast("string"), 9, "0"))).alias("fusion_partner"),
        key.cast("int").alias("ord"),
    )


PANEL = """panel AS (
  SELECT s_name AS family, ['g' || s_suppkey, 'g' || s_suppkey || 'x'] AS pos_genes, ['PF' || s_nationkey] AS neg_pfam,
         CASE WHEN s_suppkey % 2 = 0 THEN ['g' || (s_suppkey + 25)] END AS exclude_genes,
         CASE WHEN s_suppkey % 5 = 0 THEN 'annotate_only' END AS scope, s_suppkey % 7 = 0 AS decoy_from_negatives,
         CASE WHEN s_suppkey % 4 = 0 THEN 'PF' || s_nationkey END AS curated_model,
         CASE WHEN s_suppkey % 3 = 0 THEN 'Supplier#' || lpad(CAST(CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey + 1 ELSE s_suppkey - 1 END AS VARCHAR), 9, '0') END AS fusion_partner,
         s_suppkey AS ord
  FROM supplier)"""

# --- reads ---------------------------------------------------------------------------------


def contigs(spark, sf_dir) -> DataFrame:
    """Documents as contigs: their letters a-z mapped to nucleotides, whole texts."""
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return documents(spark, sf_dir).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("contig_id"),
        F.col("lang").alias("family"),
        F.when(F.col("doc_id") % 3 == 0, "negative").otherwise("positive").alias("label"),
        F.col("doc_id").cast("string").alias("accession"),
        F.translate(letters, DNA_FROM, DNA_TO).alias("seq"),
    )


CONTIGS = f"""contigs AS (
  SELECT 'c' || CAST(doc_id AS VARCHAR) AS contig_id, lang AS family,
         CASE WHEN doc_id % 3 = 0 THEN 'negative' ELSE 'positive' END AS label, CAST(doc_id AS VARCHAR) AS accession,
         translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{DNA_FROM}', '{DNA_TO}') AS seq
  FROM documents)"""

TILES = """tiles AS (
  SELECT contig_id, family, label, accession, s AS start, l AS read_length, substr(seq, CAST(s + 1 AS BIGINT), l) AS fwd
  FROM (SELECT *, unnest(generate_series(0, length(seq) - l, 120)) AS s
        FROM contigs CROSS JOIN (VALUES (100), (150)) lens(l) WHERE length(seq) >= l)),
reads AS (
  SELECT contig_id || '_' || start || '_' || read_length || '/' || mate AS read_id, mate,
         CASE WHEN mate = 1 THEN fwd ELSE reverse(translate(fwd, 'ACGTNacgtn', 'TGCANtgcan')) END AS seq,
         read_length, contig_id, CAST(start AS INTEGER) AS start, CAST(start + read_length AS INTEGER) AS "end"
  FROM tiles CROSS JOIN (VALUES (1), (2)) mates(mate))"""


def region_reads(spark, sf_dir) -> DataFrame:
    """Events as reads: contig = user, start = seconds since 2024, 150 long."""
    start = (F.unix_seconds(F.col("ts").cast("timestamp")) - 1704067200).cast("long")
    return table(spark, sf_dir, "events").filter("event_type <> 'error'").select(
        F.col("event_id").cast("string").alias("read_id"),
        F.col("user_id").cast("string").alias("contig"),
        (start + 1).alias("start"),
        (start + 150).alias("end"),
    )


def regions(spark, sf_dir) -> DataFrame:
    start = (F.unix_seconds(F.col("ts").cast("timestamp")) - 1704067200).cast("long")
    return table(spark, sf_dir, "events").filter("event_type = 'error'").select(
        F.concat(F.lit("f"), (F.col("event_id") % 7).cast("string")).alias("family"),
        F.col("user_id").cast("string").alias("contig"),
        F.greatest(F.lit(1), start - 3000).cast("long").alias("start"),
        (start + 3000).alias("end"),
        F.col("event_id").alias("ord"),
    )


REGION_READS = """reads AS (
  SELECT CAST(event_id AS VARCHAR) AS read_id, CAST(user_id AS VARCHAR) AS contig,
         CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + 1 AS start, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + 150 AS "end"
  FROM events WHERE event_type <> 'error')"""
REGIONS = """regions AS (
  SELECT 'f' || (event_id % 7) AS family, CAST(user_id AS VARCHAR) AS contig,
         greatest(1, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 - 3000) AS start,
         CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + 3000 AS "end", event_id AS ord
  FROM events WHERE event_type = 'error')"""


def alignment(spark, sf_dir) -> DataFrame:
    """Documents as aligned rows: spaces are gaps, whole texts."""
    return documents(spark, sf_dir).select(
        F.col("lang").alias("family"),
        F.col("doc_id").cast("string").alias("accession"),
        F.replace("text", F.lit(" "), F.lit("-")).alias("aligned"),
    )


ALIGNMENT = "alignment AS (SELECT lang AS family, CAST(doc_id AS VARCHAR) AS accession, replace(text, ' ', '-') AS aligned FROM documents)"
