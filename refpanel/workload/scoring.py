"""Queries on hits, truth and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from refpanel.functions import orf_to_read
from refpanel.operators import calibrate as cal
from refpanel.operators import metrics as m
from refpanel.operators.scorecard import qc_scorecard
from refpanel.operators.select import apply_scope
from refpanel.workload import standins as s
from refpanel.workload.register import registrar

SQL: dict[str, str] = {}
QUERIES = {}

query = registrar(QUERIES, SQL)


def _labelled(spark, d, with_score=True):
    return m.label_reads(m.best_hit(s.hits(spark, d)), s.truth(spark, d), with_score=with_score)


_BASE = f"WITH {s.HITS}, {s.TRUTH}, {s.BEST}, {s.LABELLED}"
_SUMMARY = f"""counts AS (
  SELECT method, family_true AS family, {s.COUNTS}
  FROM labelled WHERE family_true <> 'background' GROUP BY 1, 2),
summary AS (SELECT method, family, tp, fp, fn, {s.RATES} FROM counts)"""
_SWEEP = f"""byscore AS (
  SELECT method, family_called AS family, bitscore, count(*) FILTER (family_true = family_called AND genuine) AS t,
         count(*) FILTER (NOT (family_true = family_called AND genuine)) AS f
  FROM labelled WHERE family_called NOT IN ('NO_CALL', 'background') GROUP BY 1, 2, 3),
cum AS (
  SELECT method, family, bitscore, sum(t) OVER w AS tp, sum(f) OVER w AS fp,
         sum(t) OVER (PARTITION BY method, family) AS pos, sum(f) OVER (PARTITION BY method, family) AS neg
  FROM byscore WINDOW w AS (PARTITION BY method, family ORDER BY bitscore DESC)),
ranked AS (
  SELECT *, CASE WHEN tp > 0 THEN CAST(2.0 AS DOUBLE) * tp / (tp + fp + pos) ELSE 0 END AS f1 FROM cum WHERE pos > 0 AND neg > 0),
best_thr AS (
  SELECT method, family, bitscore AS best_threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(pos - tp AS BIGINT) AS fn,
         CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS "precision", CAST(tp AS DOUBLE) / CAST(pos AS DOUBLE) AS recall, f1
  FROM (SELECT *, row_number() OVER (PARTITION BY method, family ORDER BY f1 DESC, bitscore) AS rn FROM ranked) WHERE rn = 1)"""


@query("hit_filter", f"WITH {s.HITS} SELECT * FROM hits WHERE pident >= 0.92 AND qcov >= 0.5 AND scov >= 0.02")
def hit_filter(spark, d):
    return m.filter_hits(s.hits(spark, d), 0.92, 0.5, 0.02)


@query("best_hit", f"WITH {s.HITS}, {s.BEST} SELECT * FROM best")
def best_hit(spark, d):
    return m.best_hit(s.hits(spark, d))


@query("label_reads", f"{_BASE} SELECT method, read_id, family_true, family_called, genuine, correct, bitscore, read_length FROM labelled")
def label_reads(spark, d):
    return _labelled(spark, d).select("method", "read_id", "family_true", "family_called", "genuine", "correct", "bitscore", "read_length")


@query("summary", f"{_BASE}, {_SUMMARY} SELECT * FROM summary")
def summary(spark, d):
    return m.summarize(_labelled(spark, d, False))


_ALL = f"""own AS (
  SELECT method, family_true AS family, count(*) FILTER (family_called = family_true AND genuine) AS tp,
         count(*) FILTER (family_called = family_true AND NOT genuine) AS fp_own,
         count(*) FILTER (family_called <> family_true AND genuine) AS fn
  FROM labelled WHERE family_true <> 'background' GROUP BY 1, 2),
other AS (SELECT method, family_called AS family, count(*) AS fp_other FROM labelled WHERE family_called <> family_true GROUP BY 1, 2),
counts AS (SELECT method, family, tp, fp_own + coalesce(fp_other, 0) AS fp, fn FROM own LEFT JOIN other USING (method, family))"""


@query("summary_cross_family", f"{_BASE}, {_ALL} SELECT method, family, tp, fp, fn, {s.RATES} FROM counts")
def summary_cross_family(spark, d):
    return m.summarize(_labelled(spark, d, False), fp_scope="all")


@query("summary_by_length", f"""{_BASE}, counts AS (
  SELECT method, family_true AS family, CAST(floor(read_length / 50) * 50 AS INTEGER) AS b, {s.COUNTS}
  FROM labelled WHERE family_true <> 'background' GROUP BY 1, 2, 3)
SELECT method, family, tp, fp, fn, {s.RATES}, b || '-' || (b + 49) || 'bp' AS read_length_bucket FROM counts""")
def summary_by_length(spark, d):
    return m.summarize_by_length(_labelled(spark, d, False))


@query("background_fpr", f"""{_BASE} SELECT method, count(*) AS n_background_reads,
  count(*) FILTER (family_called <> 'NO_CALL') AS n_false_positive_calls,
  CAST(count(*) FILTER (family_called <> 'NO_CALL') AS DOUBLE) / count(*) AS background_fpr
FROM labelled WHERE family_true = 'background' GROUP BY 1""")
def background_fpr(spark, d):
    return m.background_fpr(_labelled(spark, d, False))


@query("compare_recall", f"""WITH {s.HITS}, {s.TRUTH}, best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY method, read_id ORDER BY bitscore DESC, family, subject_id, sample, pident, qcov, scov) AS rn FROM hits) WHERE rn = 1),
labelled AS (
  SELECT m.method, t.family AS family_true, coalesce(b.family, 'NO_CALL') AS family_called, TRUE AS genuine
  FROM truth t CROSS JOIN (VALUES ('search'), ('profile')) m(method) LEFT JOIN best b ON b.method = m.method AND b.read_id = t.read_id),
{_ALL}
SELECT method, family, tp, fp, fn, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS "precision",
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall FROM counts""")
def compare_recall(spark, d):
    calls = m.best_hit(s.hits(spark, d), keys=("method", "read_id"))
    return m.compare_recall(s.truth(spark, d), calls)


@query("panel_summary", f"""{_BASE}, {_SUMMARY}, counts2 AS (
  SELECT method, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM summary GROUP BY 1)
SELECT method, tp, fp, fn, {s.RATES} FROM counts2""")
def panel_summary(spark, d):
    return m.panel_summary(m.summarize(_labelled(spark, d, False)))


def _release_sql(where: str, tag: str) -> str:
    return f"""h{tag} AS (SELECT * FROM hits {where}),
b{tag} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY method, sample, read_id ORDER BY bitscore DESC, family, subject_id, pident, qcov, scov) AS rn FROM h{tag}) WHERE rn = 1),
s{tag} AS (
  SELECT m.method, t.family, CASE WHEN count(*) FILTER (b.family = t.family AND t.label = 'positive' AND t.overlaps_cds = 1) > 0
         THEN CAST(2.0 AS DOUBLE) * count(*) FILTER (b.family = t.family AND t.label = 'positive' AND t.overlaps_cds = 1)
              / (count(*) FILTER (b.family = t.family) + count(*) FILTER (t.label = 'positive' AND t.overlaps_cds = 1)) ELSE 0 END AS f1
  FROM truth t CROSS JOIN (VALUES ('search'), ('profile')) m(method)
  LEFT JOIN b{tag} b ON b.method = m.method AND b.read_id = t.read_id WHERE t.family <> 'background' GROUP BY 1, 2)"""


@query("compare_releases", f"""WITH {s.HITS}, {s.TRUTH}, {_release_sql('', '1')}, {_release_sql('WHERE pident >= 0.93 AND qcov >= 0.3 AND scov >= 0.0', '2')}
SELECT method, count(*) FILTER (s2.f1 > s1.f1) AS n_improved, round(coalesce(sum(s2.f1 - s1.f1) FILTER (s2.f1 > s1.f1), 0), 9) AS sum_improved,
       count(*) FILTER (s2.f1 < s1.f1) AS n_worsened, round(coalesce(sum(s2.f1 - s1.f1) FILTER (s2.f1 < s1.f1), 0), 9) AS sum_worsened
FROM s1 JOIN s2 USING (method, family) GROUP BY 1""")
def compare_releases(spark, d):
    old = m.summarize(_labelled(spark, d, False))
    kept = m.filter_hits(s.hits(spark, d), 0.93, 0.3, 0.0)
    new = m.summarize(m.label_reads(m.best_hit(kept), s.truth(spark, d), with_score=False))
    out = m.compare_releases(new, old)
    return out.withColumn("sum_improved", F.round("sum_improved", 9)).withColumn("sum_worsened", F.round("sum_worsened", 9))


@query("gene_counts", f"WITH {s.HITS}, {s.BEST} SELECT sample, family, count(*) AS n_reads FROM best WHERE method = 'search' AND family NOT IN ('LARGE', 'ECONOMY') GROUP BY 1, 2")
def gene_counts(spark, d):
    calls = m.best_hit(s.hits(spark, d).filter("method = 'search'"))
    return m.gene_counts(apply_scope(calls, s.part_families(spark), "profile"))


@query("scope_exclusion", f"WITH {s.HITS}, {s.BEST} SELECT method, sample, read_id, family, bitscore FROM best WHERE family NOT IN ('LARGE', 'ECONOMY', 'STANDARD_decoy', 'SMALL_decoy')")
def scope_exclusion(spark, d):
    calls = apply_scope(m.best_hit(s.hits(spark, d)), s.part_families(spark), "profile")
    return calls.select("method", "sample", "read_id", "family", "bitscore")


@query("best_threshold", f"{_BASE}, {_SWEEP} SELECT * FROM best_thr")
def best_threshold(spark, d):
    return m.best_threshold(_labelled(spark, d, False))


_CASCADE = f"""{_BASE}, {_SUMMARY}, {_SWEEP}, cascade AS (
  SELECT s.family, s."precision", CASE WHEN s."precision" < 0.95 AND b.best_threshold IS NOT NULL THEN 'yes' ELSE 'no' END AS needs_check,
         CASE WHEN s."precision" < 0.95 AND b.best_threshold IS NOT NULL THEN b.best_threshold END AS short_read_threshold
  FROM summary s LEFT JOIN best_thr b ON b.family = s.family AND b.method = 'profile' WHERE s.method = 'search')"""


@query("cascade_config", f"{_CASCADE} SELECT * FROM cascade")
def cascade_config(spark, d):
    labelled = _labelled(spark, d, False)
    return m.cascade_config(m.summarize(labelled), m.best_threshold(labelled))


@query("cascade_apply", f"""{_CASCADE}, second AS (SELECT sample, read_id, family, max(bitscore) AS z FROM hits WHERE method = 'profile' GROUP BY 1, 2, 3)
SELECT b.sample, b.read_id, b.family, b.bitscore FROM best b JOIN cascade c USING (family) LEFT JOIN second USING (sample, read_id, family)
WHERE b.method = 'search' AND (c.needs_check = 'no' OR z >= c.short_read_threshold)""")
def cascade_apply(spark, d):
    calls = m.best_hit(s.hits(spark, d).filter("method = 'search'"))
    kept = m.apply_cascade(calls, cascade_config(spark, d), s.hits(spark, d).filter("method = 'profile'"))
    return kept.select("sample", "read_id", "family", "bitscore")


_CURVE = """pts AS (SELECT method, bitscore, count(*) FILTER (correct) AS t, count(*) FILTER (NOT correct) AS f FROM labelled GROUP BY 1, 2),
curve AS (SELECT *, sum(t) OVER w AS ct, sum(f) OVER w AS cf, sum(t) OVER (PARTITION BY method) AS p, sum(f) OVER (PARTITION BY method) AS n
  FROM pts WINDOW w AS (PARTITION BY method ORDER BY bitscore DESC))"""


@query("roc_curve", f"{_BASE}, {_CURVE} SELECT method, bitscore AS threshold, CAST(cf AS DOUBLE) / CAST(n AS DOUBLE) AS fpr, CAST(ct AS DOUBLE) / CAST(p AS DOUBLE) AS tpr FROM curve WHERE p > 0 AND n > 0")
def roc_curve(spark, d):
    return m.roc_curve(_labelled(spark, d))


@query("pr_curve", f'{_BASE}, {_CURVE} SELECT method, bitscore AS threshold, CAST(ct AS DOUBLE) / CAST(ct + cf AS DOUBLE) AS "precision", CAST(ct AS DOUBLE) / CAST(p AS DOUBLE) AS recall FROM curve WHERE p > 0 AND n > 0')
def pr_curve(spark, d):
    return m.pr_curve(_labelled(spark, d))


@query("roc_auc", f"{_BASE}, {_CURVE} SELECT method, round(CAST(sum(f * (2 * ct - t)) AS DOUBLE) / (2.0 * max(p) * max(n)), 9) AS roc_auc FROM curve WHERE p > 0 AND n > 0 GROUP BY 1")
def roc_auc(spark, d):
    return m.roc_auc(_labelled(spark, d)).withColumn("roc_auc", F.round("roc_auc", 9))


@query("pr_auc", f"""{_BASE}, {_CURVE}, slabs AS (
  SELECT method, CAST(t AS DOUBLE) / CAST(p AS DOUBLE) * (CAST(ct AS DOUBLE) / CAST(ct + cf AS DOUBLE)
    + CASE WHEN ct - t + cf - f > 0 THEN CAST(ct - t AS DOUBLE) / CAST(ct - t + cf - f AS DOUBLE) ELSE 1.0 END) / 2 AS a FROM curve WHERE p > 0 AND n > 0)
SELECT method, round(sum(a), 9) AS pr_auc FROM slabs GROUP BY 1""")
def pr_auc(spark, d):
    return m.pr_auc(_labelled(spark, d)).withColumn("pr_auc", F.round("pr_auc", 9))


@query("orf_to_read", "SELECT l_orderkey || '/' || (l_linenumber % 2 + 1) || '_' || l_partkey || '_' || l_suppkey || '_' || l_linenumber AS orf_id, l_orderkey || '/' || (l_linenumber % 2 + 1) AS read_id FROM lineitem")
def orf_ids(spark, d):
    line = s.table(spark, d, "lineitem")
    mate = (F.col("l_linenumber") % 2 + 1).cast("string")
    orf = F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), mate, *[x for c in ("l_partkey", "l_suppkey", "l_linenumber") for x in (F.lit("_"), F.col(c).cast("string"))])
    return line.select(orf.alias("orf_id")).withColumn("read_id", orf_to_read("orf_id"))


# --- calibration ---------------------------------------------------------------------------

_F1 = """fs AS (SELECT family, score, count(*) FILTER (label = 'positive') AS p, count(*) FILTER (label = 'negative') AS n FROM scores GROUP BY 1, 2),
fc AS (SELECT family, score, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY family) AS pos
  FROM fs WINDOW w AS (PARTITION BY family ORDER BY score DESC)),
ff AS (SELECT *, CASE WHEN tp > 0 THEN CAST(2.0 AS DOUBLE) * tp / (tp + fp + pos) ELSE 0 END AS f1 FROM fc),
f1best AS (SELECT family, score AS cutoff, f1 FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY f1 DESC, score) AS rn FROM ff) WHERE rn = 1),
stats AS (SELECT family, count(*) FILTER (label = 'positive') AS n_positive, count(*) FILTER (label = 'negative') AS n_negative,
  min(score) FILTER (label = 'positive') AS min_positive, max(score) FILTER (label = 'negative') AS max_negative FROM scores GROUP BY 1)"""


@query("f1_sweep", f"WITH {s.SCORES}, {_F1} SELECT * FROM f1best")
def f1_sweep(spark, d):
    return cal.f1_sweep(s.scores(spark, d))


_F1_POLICY = """SELECT family,
  CASE WHEN n_positive = 0 THEN 0 WHEN n_negative = 0 THEN greatest(min_positive - 1.0, 0.0) WHEN max_negative < min_positive THEN (max_negative + min_positive) / 2.0
       WHEN n_negative < 30 THEN max_negative + 1.0 ELSE cutoff END AS cutoff,
  CASE WHEN n_positive = 0 THEN 'no_positive_scores' WHEN n_negative = 0 THEN 'no_negatives_available' WHEN max_negative < min_positive THEN 'clean_separation'
       WHEN n_negative < 30 THEN 'insufficient_negative_data' ELSE 'overlapping_distributions_f1_calibrated' END AS status,
  CASE WHEN n_positive = 0 OR n_negative = 0 THEN NULL WHEN max_negative < min_positive THEN 1.0 WHEN n_negative < 30 THEN NULL ELSE f1 END AS f1,
  n_positive, n_negative, min_positive, max_negative FROM stats JOIN f1best USING (family)"""


@query("calibrate_f1", f"WITH {s.SCORES}, {_F1} {_F1_POLICY}")
def calibrate_f1(spark, d):
    return cal.calibrate(s.scores(spark, d), "f1")


@query("calibrate_percentile", f"""WITH {s.SCORES}, {_F1}, tail AS (SELECT family, quantile_cont(score, 0.99) AS q FROM scores WHERE label = 'negative' GROUP BY 1)
SELECT family, CASE WHEN n_positive = 0 THEN 0 WHEN n_negative = 0 THEN greatest(min_positive - 1.0, 0.0) WHEN max_negative < min_positive THEN (max_negative + min_positive) / 2.0 ELSE round(q, 9) END AS cutoff,
  CASE WHEN n_positive = 0 THEN 'no_positive_scores' WHEN n_negative = 0 THEN 'no_negatives_available' WHEN max_negative < min_positive THEN 'clean_separation' ELSE 'overlapping_distributions_review_needed' END AS status,
  n_positive, n_negative, min_positive, max_negative FROM stats LEFT JOIN tail USING (family)""")
def calibrate_percentile(spark, d):
    return cal.calibrate(s.scores(spark, d), "percentile").withColumn("cutoff", F.round("cutoff", 9))


@query("curated_cutoff", f"""WITH {s.SCORES}, {_F1}, curated(family, cut) AS (VALUES ('click', 500.0), ('error', 40.0), ('purchase', 20.0), ('signup', NULL), ('view', NULL)),
tested AS (SELECT family, CAST(max(cut) AS DOUBLE) AS cutoff, count(*) FILTER (label = 'positive') AS n_positive, count(*) FILTER (label = 'negative') AS n_negative,
    count(*) FILTER (label = 'positive' AND score < cut) AS below, count(*) FILTER (label = 'negative' AND score >= cut) AS above,
    min(score) FILTER (label = 'positive') AS min_positive, max(score) FILTER (label = 'negative') AS max_negative
  FROM scores JOIN curated USING (family) WHERE cut IS NOT NULL GROUP BY 1)
SELECT family, cutoff, CASE WHEN below = 0 AND above = 0 THEN 'pfam_ga_clean' ELSE 'pfam_ga_review_needed' END AS status,
  CASE WHEN n_positive - below > 0 THEN CAST(2.0 AS DOUBLE) * (n_positive - below) / (2 * (n_positive - below) + above + below) END AS f1,
  n_positive, n_negative, min_positive, max_negative FROM tested
UNION ALL SELECT * FROM ({_F1_POLICY}) WHERE family IN ('signup', 'view')""")
def curated_cutoff(spark, d):
    fixed = [("click", 500.0), ("error", 40.0), ("purchase", 20.0), ("signup", None), ("view", None)]
    return cal.check_curated_cutoff(s.scores(spark, d), spark.createDataFrame(fixed, "family string, cutoff double"))


@query("restricted_best", f"""WITH {s.HITS}, {s.TRUTH}, own AS (SELECT family, read_id, max(bitscore) AS score FROM hits GROUP BY 1, 2)
SELECT t.family, t.label, t.read_id AS query_id, coalesce(score, 0.0) AS score FROM truth t LEFT JOIN own USING (family, read_id)""")
def restricted_best(spark, d):
    queries = s.truth(spark, d).select("family", "label", F.col("read_id").alias("query_id"))
    return cal.restricted_best(queries, s.hits(spark, d).withColumnRenamed("read_id", "query_id"))


_CARD_FAMILIES = ["click", "error", "purchase", "signup", "view", "absent"]


@query("qc_scorecard", f"""WITH {s.SCORES}, {_F1}, families AS (SELECT unnest({s._literal(_CARD_FAMILIES)}) AS family),
purity AS (SELECT family, count(*) AS n_total, count(*) FILTER (score > 100) AS n_flagged FROM scores WHERE label = 'negative' GROUP BY 1),
lengths AS (SELECT family, count(*) FILTER (label = 'positive') AS pt, count(*) FILTER (label = 'positive' AND score > 60) AS pf,
  count(*) FILTER (label = 'negative') AS nt, count(*) FILTER (label = 'negative' AND score > 150) AS nf FROM scores GROUP BY 1),
cutoffs AS ({_F1_POLICY}),
card AS (SELECT family, p.n_flagged AS neg_purity_flagged, p.n_total AS neg_purity_total,
    CASE WHEN pt > 0 THEN pf END AS pos_length_flagged, CASE WHEN pt > 0 THEN pt END AS pos_length_total,
    CASE WHEN nt > 0 THEN nf END AS neg_length_flagged, CASE WHEN nt > 0 THEN nt END AS neg_length_total, cutoff, status
  FROM families LEFT JOIN purity p USING (family) LEFT JOIN lengths USING (family) LEFT JOIN cutoffs USING (family)),
why AS (SELECT *, concat_ws(';',
    CASE WHEN neg_purity_flagged / CAST(neg_purity_total AS DOUBLE) > 0.10 THEN 'neg_purity=' || CAST(round_even(neg_purity_flagged / CAST(neg_purity_total AS DOUBLE) * 100, 0) AS INTEGER) || '%' END,
    CASE WHEN pos_length_flagged / CAST(pos_length_total AS DOUBLE) > 0.10 THEN 'pos_length=' || CAST(round_even(pos_length_flagged / CAST(pos_length_total AS DOUBLE) * 100, 0) AS INTEGER) || '%' END,
    CASE WHEN neg_length_flagged / CAST(neg_length_total AS DOUBLE) > 0.10 THEN 'neg_length=' || CAST(round_even(neg_length_flagged / CAST(neg_length_total AS DOUBLE) * 100, 0) AS INTEGER) || '%' END,
    CASE WHEN status NOT IN ('clean_separation', 'clean_separation_no_negative_hits') THEN 'hmm_status=' || status END) AS review_reasons FROM card)
SELECT *, CASE WHEN review_reasons <> '' THEN 'yes' ELSE 'no' END AS review_needed FROM why""")
def scorecard(spark, d):
    scores = s.scores(spark, d)
    families = spark.createDataFrame([(f,) for f in _CARD_FAMILIES], "family string")
    purity = scores.filter("label = 'negative'").groupBy("family").agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("score") > 100).alias("n_flagged"))
    limit = F.when(F.col("label") == "positive", 60).otherwise(150)
    lengths = scores.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("score") > limit).alias("n_flagged"))
    return qc_scorecard(families, purity, lengths, cal.calibrate(scores, "f1"))
