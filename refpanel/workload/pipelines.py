"""Whole runs over the shared test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from refpanel.plans import build_release, run_benchmark, validate_genome
from refpanel.sources.families import families_table
from refpanel.workload import standins as s
from refpanel.workload.scoring import SQL as _SCORING_SQL

QUERIES = {}
SQL: dict[str, str] = {}

# Config of the release run: languages as families, documents as the catalogue.
_RELEASE_FAMILIES = [
    dict(family="en", pos_genes=["en"], neg_pfam=["d0", "d1"], exclude_genes=["en", "es"], decoy_from_negatives=True, fusion_partner="de", fusion_marker="d7"),
    dict(family="de", pos_genes=["de"], neg_pfam=["d2"], exclude_genes=["de"], fusion_partner="en", fusion_marker="d8"),
    dict(family="fr", pos_genes=["fr"], neg_pfam=["d3", "d4"], exclude_genes=["fr"], scope="annotate_only"),
    dict(family="es", pos_genes=["es"], neg_pfam=["d5"], exclude_genes=["es"], decoy_from_negatives=True),
]


def _release(spark, d):
    catalogue = s.documents(spark, d).select(
        F.col("doc_id").cast("string").alias("accession"),
        F.array("lang").alias("gene_names"),
        F.array(F.concat(F.lit("d"), (F.col("doc_id") % 10).cast("string"))).alias("domains"),
        F.array(F.lit(2)).alias("lineage"),
        F.concat("source", F.lit("_s"), (F.col("doc_id") % 3).cast("string")).alias("organism"),
        F.col("text").alias("seq"),
    )
    return build_release(catalogue, families_table(spark, _RELEASE_FAMILIES), "r1", k=16)


def release_scorecard(spark, d):
    return _release(spark, d).scorecard


def _benchmark(table: str, *filters: float):
    def run(spark, d):
        return run_benchmark(s.hits(spark, d), s.truth(spark, d), *filters)[table]

    return run


def genome_validation(spark, d):
    """Events as reads of a genome: contig = user, coordinates in the id; lineitems as hits."""
    e, text = F.col("event_id"), lambda c: c.cast("string")
    start = (F.unix_seconds(F.col("ts").cast("timestamp")) - 1704067200).cast("long")
    events = s.table(spark, d, "events")
    read_id = F.concat(F.lit("u"), text(F.col("user_id")), F.lit("_"), text(start + 1), F.lit("_"), text(start + 1), F.lit("_0:0:0_0:0:0_"), F.lower(F.hex(e)), F.lit("/1"))
    reads = events.select(read_id.alias("read_id"))
    # The last error event of each user is that user's confirmed target gene.
    genes = events.filter("event_type = 'error'").groupBy("user_id").agg(F.max(start).alias("at"))
    orf = F.concat(F.lit("u"), text(F.col("user_id")), F.lit("_1"))
    headers = genes.select(F.concat(orf, F.lit(" # "), text(F.greatest(F.lit(1), F.col("at") - 40000)), F.lit(" # "), text(F.col("at") + 40000), F.lit(" # 1 # ID=1")).alias("header"))
    orf_map = genes.select(F.concat(F.lit("f"), text(F.col("user_id"))).alias("family"), orf.alias("orf_id"))
    called = events.filter("value > 20").select(
        F.when(F.col("event_id") % 2 == 0, "search").otherwise("profile").alias("method"),
        read_id.alias("read_id"),
        F.concat(F.lit("f"), text(F.col("user_id"))).alias("family"),
        F.col("value").alias("bitscore"),
    )
    return validate_genome(headers, orf_map, reads, called)


QUERIES["release_scorecard"] = release_scorecard
# The benchmark filters search hits first; the rest is what the single queries say.
for _table, _single in (("summary", "summary"), ("by_length", "summary_by_length"), ("background", "background_fpr")):
    QUERIES[f"benchmark_{_table}"] = _benchmark(_table)
    SQL[f"benchmark_{_table}"] = _SCORING_SQL[_single].replace(s.HITS, f"""{s.HITS.replace("hits AS", "every_hit AS", 1)},
hits AS (SELECT * FROM every_hit WHERE method <> 'search' OR pident >= 0.40 AND qcov >= 0.50 AND scov >= 0.0)""")
# The cascade is set from every hit.
QUERIES["benchmark_cascade"] = _benchmark("cascade", 0.0, 0.0, 0.0)
SQL["benchmark_cascade"] = _SCORING_SQL["cascade_config"]
QUERIES["genome_validation"] = genome_validation
SQL["genome_validation"] = """WITH e AS (
  SELECT *, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS st FROM events),
g AS (SELECT user_id, greatest(1, max(st) - 40000) AS rs, max(st) + 40000 AS re FROM e WHERE event_type = 'error' GROUP BY 1),
t AS (SELECT event_id, e.user_id, CASE WHEN least(st + 150, re) - greatest(st + 1, rs) + 1 >= 20 THEN 'f' || e.user_id ELSE 'background' END AS family FROM e LEFT JOIN g ON g.user_id = e.user_id),
lab AS (SELECT m.method, t.family AS tf, CASE WHEN e.value > 20 AND (e.event_id % 2 = 0) = (m.method = 'search') THEN 'f' || e.user_id ELSE 'NO_CALL' END AS cf
  FROM t JOIN e USING (event_id) CROSS JOIN (VALUES ('search'), ('profile')) m(method)),
own AS (SELECT method, tf AS family, count(*) FILTER (cf = tf) AS tp, count(*) FILTER (cf <> tf) AS fn FROM lab WHERE tf <> 'background' GROUP BY 1, 2),
oth AS (SELECT method, cf AS family, count(*) AS fp FROM lab WHERE cf <> tf GROUP BY 1, 2)
SELECT method, family, tp, coalesce(fp, 0) AS fp, fn, CASE WHEN tp + coalesce(fp, 0) > 0 THEN CAST(tp AS DOUBLE) / (tp + coalesce(fp, 0)) END AS "precision",
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall FROM own LEFT JOIN oth USING (method, family)"""
