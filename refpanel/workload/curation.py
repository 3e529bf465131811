"""Queries on selection, QC, splits and reference assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from refpanel.functions import genus_of
from refpanel.operators import qc, refs, split
from refpanel.operators import select as sel
from refpanel.sources.families import subset_families
from refpanel.sources.fasta import retag
from refpanel.workload import standins as s
from refpanel.workload.register import registrar

SQL: dict[str, str] = {}
QUERIES = {}

query = registrar(QUERIES, SQL)


_FAMILIES = s.config_sql(s.PART_FAMILIES)
_GROUPS = ["family", "label"]


@query("family_subset", f"WITH {s.PANEL} SELECT family, ord FROM panel WHERE family IN ('Supplier#000000003', 'Supplier#000000001', 'Supplier#000000008')")
def family_subset(spark, d):
    names = [f"Supplier#00000000{i}" for i in (3, 1, 8)]
    return subset_families(s.panel(spark, d), names).select("family", "ord")


_SELECT = f"""WITH {_FAMILIES}, {s.CATALOGUE},
pos AS (SELECT f.family, 'positive' AS label, c.accession, c.organism, c.length FROM families f, catalogue c
  WHERE (list_has_any(c.gene_names, coalesce(f.pos_genes, [])) OR list_has_any(c.domains, coalesce(f.pos_pfam, [])))
    AND (f.taxonomy_id IS NULL OR list_contains(c.lineage, f.taxonomy_id))),
neg AS (SELECT f.family, 'negative' AS label, c.accession, c.organism, c.length FROM families f, catalogue c
  WHERE list_has_any(c.domains, coalesce(f.neg_pfam, [])) AND (f.neg_genes IS NULL OR list_has_any(c.gene_names, f.neg_genes))
    AND NOT list_has_any(c.gene_names, coalesce(f.exclude_genes, [])) AND NOT list_has_any(c.domains, coalesce(f.exclude_pfam, []))
    AND NOT (f.fusion_partner IS NOT NULL AND f.fusion_marker IS NOT NULL AND list_contains(c.domains, f.fusion_marker))
    AND (f.taxonomy_id IS NULL OR list_contains(c.lineage, f.taxonomy_id)))"""


@query("catalogue_select", f"{_SELECT} SELECT * FROM pos UNION ALL SELECT * FROM neg")
def catalogue_select(spark, d):
    cat, fam = s.catalogue(spark, d), s.part_families(spark)
    both = sel.select_sequences(cat, fam, "positive").unionByName(sel.select_sequences(cat, fam, "negative"))
    return both.select("family", "label", "accession", "organism", "length")


@query("capped_sample", f"""{_SELECT}, seqs AS (SELECT * FROM pos UNION ALL SELECT * FROM neg),
capped AS (SELECT s.*, CASE WHEN label = 'positive' THEN max_positive ELSE coalesce(max_negative, 150) END AS cap FROM seqs s JOIN families USING (family)),
cand AS (SELECT *, row_number() OVER (PARTITION BY family, label ORDER BY accession) AS rn FROM capped),
drawn AS (SELECT *, row_number() OVER (PARTITION BY family, label ORDER BY md5('42:' || family || ':' || label || ':' || accession), accession) AS rd
  FROM cand WHERE cap IS NULL OR rn <= ceil(cap * 5 / 500.0) * 500)
SELECT family, label, accession FROM drawn WHERE cap IS NULL OR rd <= cap""")
def capped_sample(spark, d):
    cat, fam = s.catalogue(spark, d), s.part_families(spark)
    both = sel.select_sequences(cat, fam, "positive").unionByName(sel.select_sequences(cat, fam, "negative"))
    caps = fam.select("family", F.lit("positive").alias("label"), F.col("max_positive").alias("max_n")).unionByName(
        fam.select("family", F.lit("negative").alias("label"), F.coalesce("max_negative", F.lit(150)).alias("max_n"))
    )
    return sel.capped_sample(both, caps).select("family", "label", "accession")


@query("diversity", f"""WITH {s.DOC_SEQS} SELECT family, label, count(*) AS n, count(DISTINCT organism) AS n_organisms,
  count(DISTINCT CASE WHEN organism = '' THEN 'unknown' ELSE split_part(organism, '_', 1) END) AS n_genera FROM seqs GROUP BY 1, 2""")
def diversity(spark, d):
    return sel.fetch_manifest(s.doc_sequences(spark, d))


_HEADERS = """headers AS (
  SELECT CASE p_partkey % 3 WHEN 0 THEN 'sp|' || p_partkey || '|' || p_type || ' protein OS=' || p_name || ' OX=' || p_size
                            WHEN 1 THEN 'tr|' || p_partkey || '|x OS=' || p_name ELSE p_type || p_partkey END AS header FROM part)"""


@query("retag", f"""WITH {_HEADERS} SELECT header,
  CASE WHEN contains(header, '|') THEN split_part(header, '|', 2) ELSE header END AS accession,
  CASE WHEN contains(header, 'OS=') AND contains(header, 'OX=') THEN replace(trim(regexp_extract(header, 'OS=(.*?)OX=', 1)), ' ', '_')
       WHEN contains(header, 'OS=') THEN regexp_extract(header, 'OS=(\\S+)', 1) ELSE 'unknown' END AS organism,
  'fam|' || accession || '|' || organism AS tagged FROM headers""")
def retag_query(spark, d):
    key = F.col("p_partkey").cast("string")
    header = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("sp|"), key, F.lit("|"), "p_type", F.lit(" protein OS="), "p_name", F.lit(" OX="), F.col("p_size").cast("string")))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("tr|"), key, F.lit("|x OS="), "p_name"))
        .otherwise(F.concat("p_type", key))
    )
    return retag(s.table(spark, d, "part").select(header.alias("header")), "fam").select("header", "accession", "organism", "tagged")


@query("genus", f"WITH {s.DOC_SEQS} SELECT accession, CASE WHEN organism = '' THEN 'unknown' ELSE split_part(organism, '_', 1) END AS genus FROM seqs")
def genus(spark, d):
    return s.doc_sequences(spark, d).select("accession", genus_of("organism").alias("genus"))


@query("fusion_pairs", f"WITH {s.PANEL} SELECT DISTINCT least(p.family, p.fusion_partner) AS fam_a, greatest(p.family, p.fusion_partner) AS fam_b FROM panel p WHERE p.fusion_partner IN (SELECT family FROM panel)")
def fusion_pairs(spark, d):
    return sel.fusion_pairs(s.panel(spark, d))


@query("dup_model_check", f"WITH {s.PANEL} SELECT curated_model, count(*) AS n_families, string_agg(family, ',' ORDER BY family) AS families FROM panel WHERE curated_model IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dup_model_check(spark, d):
    return sel.shared_models(s.panel(spark, d))


@query("sibling_audit", f"""WITH {s.PANEL}, a AS (SELECT *, unnest(neg_pfam) AS anchor FROM panel),
genes AS (SELECT DISTINCT anchor, unnest(pos_genes) AS g FROM a),
miss AS (SELECT a.family, a.anchor, g.g FROM a JOIN genes g USING (anchor) WHERE NOT list_contains(a.pos_genes, g.g) AND NOT list_contains(coalesce(a.exclude_genes, []), g.g))
SELECT family, anchor, string_agg(g, ',' ORDER BY g) AS missing_genes, CAST(count(*) AS INTEGER) AS n_missing FROM miss GROUP BY 1, 2""")
def sibling_audit(spark, d):
    return sel.sibling_exclusion_audit(s.panel(spark, d))


@query("scope_lists", f"""WITH {s.PANEL} SELECT 'profile' AS mode, family FROM panel WHERE scope = 'annotate_only'
UNION ALL SELECT 'profile', family || '_decoy' FROM panel WHERE decoy_from_negatives UNION ALL SELECT 'annotate', family || '_decoy' FROM panel WHERE decoy_from_negatives""")
def scope_lists(spark, d):
    panel = s.panel(spark, d)
    one = lambda mode: sel.excluded_families(panel, mode).select(F.lit(mode).alias("mode"), "family")
    return one("profile").unionByName(one("annotate"))


# --- QC ------------------------------------------------------------------------------------

_MEDIANS = """med AS (
  SELECT family, label, count(*) AS n, CASE WHEN label = 'negative' AND any_value(o) IS NOT NULL THEN any_value(o) ELSE quantile_cont(CAST(length AS DOUBLE), 0.5) END AS median_length,
         CASE WHEN label = 'negative' AND any_value(o) IS NOT NULL THEN 'override' ELSE 'computed' END AS median_source
  FROM (SELECT r.*, f.negative_median_override AS o FROM {rows} r LEFT JOIN families f USING (family)) GROUP BY 1, 2 HAVING count(*) >= 5)"""


@query("family_medians", f"WITH {_FAMILIES}, {s.PART_SEQS}, {_MEDIANS.format(rows='seqs')} SELECT * FROM med")
def family_medians(spark, d):
    return qc.family_medians(s.part_sequences(spark, d), s.part_families(spark))


_PREFILTER = """marked AS (
  SELECT s.*, f.fusion_partner, f.fusion_marker, f.length_max_ratio,
         CASE WHEN f.fusion_partner IS NOT NULL AND f.fusion_marker IS NOT NULL THEN coalesce(list_contains(d.domains, f.fusion_marker), FALSE) END AS has_marker
  FROM seqs s LEFT JOIN families f USING (family) LEFT JOIN domains d USING (accession)),
pre AS (SELECT *, label = 'negative' AND coalesce(has_marker, FALSE) AS contaminant FROM marked)"""


@query("domain_prefilter", f"WITH {_FAMILIES}, {s.PART_SEQS}, {s.DOMAINS}, {_PREFILTER} SELECT family, label, accession, has_marker, contaminant FROM pre")
def domain_prefilter(spark, d):
    out = qc.domain_prefilter(s.part_sequences(spark, d), s.part_families(spark), s.domains(spark, d))
    return out.select("family", "label", "accession", "has_marker", "contaminant")


_OUTLIERS = f"""{_PREFILTER},
clean AS (SELECT * FROM pre WHERE NOT contaminant), {_MEDIANS.format(rows='clean')},
lim AS (SELECT p.*, m.median_length, m.median_source, coalesce(p.length_max_ratio, 1.5) AS r,
    CASE WHEN p.label = 'positive' THEN m.median_length + pm.median_length END AS fused
  FROM pre p LEFT JOIN med m ON m.family = p.family AND m.label = p.label LEFT JOIN med pm ON pm.family = p.fusion_partner AND pm.label = 'positive'),
classified AS (SELECT family, label, accession, organism, seq, length, median_length, median_source, CASE WHEN median_length IS NOT NULL THEN r END AS max_ratio,
    CASE WHEN contaminant THEN 'contaminant' WHEN median_length IS NULL THEN 'too_few'
         WHEN length >= median_length / r AND length <= median_length * r THEN 'kept'
         WHEN fused IS NOT NULL AND length >= fused / r AND length <= fused * r AND coalesce(has_marker, TRUE) THEN 'fusion' ELSE 'flagged' END AS outcome FROM lim)"""
_OUTLIERS = f"WITH {_FAMILIES}, {s.PART_SEQS}, {s.DOMAINS}, {_OUTLIERS}"


def _classified(spark, d):
    return qc.length_outliers(s.part_sequences(spark, d), s.part_families(spark), s.domains(spark, d))


@query("length_outliers", f"{_OUTLIERS} SELECT * FROM classified")
def length_outliers(spark, d):
    return _classified(spark, d)


@query("length_manifest", f"""{_OUTLIERS} SELECT family, label, count(*) FILTER (outcome IN ('kept', 'flagged', 'fusion')) AS n_total,
  count(*) FILTER (outcome = 'kept') AS n_kept, count(*) FILTER (outcome = 'flagged') AS n_flagged, count(*) FILTER (outcome = 'fusion') AS n_fusion_candidates,
  count(*) FILTER (outcome = 'contaminant') AS n_contaminants, max(median_length) AS median_length, max(median_source) AS median_source, max(max_ratio) AS max_ratio
FROM classified WHERE outcome <> 'too_few' GROUP BY 1, 2""")
def length_manifest(spark, d):
    return qc.length_manifest(_classified(spark, d))


@query("worst_examples", f"""{_OUTLIERS} SELECT family, label, accession, length, deviation FROM (
  SELECT *, abs(length - median_length) AS deviation, row_number() OVER (PARTITION BY family, label ORDER BY abs(length - median_length) DESC, accession) AS rn
  FROM classified WHERE outcome = 'flagged') WHERE rn = 1""")
def worst_examples(spark, d):
    return qc.worst_examples(_classified(spark, d))


@query("fusion_screen", f"""WITH {_FAMILIES}, {s.PART_SEQS}, {_MEDIANS.format(rows='seqs')},
p AS (SELECT family, max(median_length) FILTER (label = 'positive') AS positive_median, max(median_length) FILTER (label = 'negative') AS negative_median FROM med GROUP BY 1)
SELECT *, negative_median / positive_median AS length_ratio, coalesce(negative_median / positive_median >= 1.1, FALSE) AS suspect FROM p""")
def fusion_screen(spark, d):
    return qc.fusion_screen(qc.family_medians(s.part_sequences(spark, d), s.part_families(spark)), 1.1)


_STABLE = """m{n} AS (
  SELECT family, label, quantile_cont(CAST(length AS DOUBLE), 0.5) AS m{n} FROM (
    SELECT *, row_number() OVER (PARTITION BY family, label ORDER BY md5('42:' || family || ':' || label || ':' || accession), accession) AS rd FROM (
      SELECT *, row_number() OVER (PARTITION BY family, label ORDER BY accession) AS rn FROM seqs) WHERE rn <= ceil({n} * 5 / 500.0) * 500)
  WHERE rd <= {n} GROUP BY 1, 2 HAVING count(*) >= 5)"""


@query("median_stability", f"""WITH {s.DOC_SEQS}, {_STABLE.format(n=20)}, {_STABLE.format(n=200)}
SELECT family, label, m20 AS small_median, m200 AS large_median, abs(m20 - m200) / m200 AS shift, abs(m20 - m200) / m200 > 0.025 AS unstable FROM m20 JOIN m200 USING (family, label)""")
def median_stability(spark, d):
    return qc.median_stability(s.doc_sequences(spark, d), 20, 200)


_FRACTIONS = """pm AS (SELECT family, quantile_cont(CAST(length AS DOUBLE), 0.5) AS m FROM seqs WHERE label = 'positive' GROUP BY 1),
typ AS (SELECT s.family, d.domains FROM seqs s JOIN pm USING (family) JOIN domains d USING (accession) WHERE label = 'positive' AND length >= m / 1.5 AND length <= m * 1.5),
tot AS (SELECT family, count(*) AS n_total FROM typ GROUP BY 1),
frac AS (SELECT family, domain, n_carriers, n_total, CAST(n_carriers AS DOUBLE) / n_total AS fraction
  FROM (SELECT family, domain, count(*) AS n_carriers FROM (SELECT family, unnest(list_distinct(domains)) AS domain FROM typ) GROUP BY 1, 2) JOIN tot USING (family))"""


def _fractions(spark, d):
    positives = s.part_sequences(spark, d).filter("label = 'positive'")
    return qc.domain_fractions(positives, s.domains(spark, d))


@query("domain_fractions", f"WITH {s.PART_SEQS}, {s.DOMAINS}, {_FRACTIONS} SELECT * FROM frac")
def domain_fractions(spark, d):
    return _fractions(spark, d)


_PAIR = f"""{_FRACTIONS},
pairs AS (SELECT DISTINCT least(f.family, f.fusion_partner) AS fam_a, greatest(f.family, f.fusion_partner) AS fam_b FROM families f WHERE f.fusion_partner IN (SELECT family FROM families)),
cand AS (SELECT DISTINCT family, unnest(list_filter(list_concat([fusion_marker], coalesce(neg_pfam, [])), lambda x: x IS NOT NULL)) AS domain FROM families),
sides AS (SELECT fam_a, fam_b, fam_a AS own, fam_b AS other FROM pairs UNION ALL SELECT fam_a, fam_b, fam_b, fam_a FROM pairs),
ver AS (SELECT s.fam_a, s.fam_b, s.own, c.domain FROM sides s JOIN cand c ON c.family = s.own JOIN frac fo ON fo.family = s.own AND fo.domain = c.domain
  LEFT JOIN frac fx ON fx.family = s.other AND fx.domain = c.domain
  WHERE fo.fraction >= 0.05 AND coalesce(fx.fraction, 0) <= 0.2 AND s.other IN (SELECT family FROM frac)),
sa AS (SELECT fam_a, fam_b, min(domain) AS domain_a FROM ver WHERE own = fam_a GROUP BY 1, 2),
pair_domains AS (SELECT sa.fam_a, sa.fam_b, sa.domain_a, min(v.domain) AS domain_b FROM sa JOIN ver v ON v.fam_a = sa.fam_a AND v.fam_b = sa.fam_b AND v.own = sa.fam_b AND v.domain <> sa.domain_a GROUP BY 1, 2, 3)"""


def _pair_domains(spark, d):
    return qc.fusion_domain_pair(s.part_families(spark), _fractions(spark, d), 0.05, 0.2)


@query("fusion_domain_pair", f"WITH {_FAMILIES}, {s.PART_SEQS}, {s.DOMAINS}, {_PAIR} SELECT * FROM pair_domains")
def fusion_domain_pair(spark, d):
    return _pair_domains(spark, d)


_EXTRA = """extra AS (
  SELECT CASE WHEN conv_id % 11 = 0 THEN 'none' ELSE ['en', 'de', 'fr', 'es'][conv_id % 4 + 1] END AS family, conv_id * 1000 + turn AS ord,
         CASE WHEN turn % 2 = 0 THEN 'bin' || turn || '__LT_' || (conv_id % 50) || ' product' ELSE CAST(conv_id * 3 AS VARCHAR) || ' other words' END AS header, text AS seq FROM conversations),
ids AS (SELECT *, CASE WHEN regexp_matches(header, '__[A-Za-z0-9]+_[0-9]+') THEN regexp_extract(header, '__([A-Za-z0-9]+_[0-9]+)', 1) ELSE regexp_extract(header, '(\\S+)', 1) END AS id
  FROM extra WHERE family IN (SELECT family FROM seqs WHERE label = 'positive')),
judged AS (SELECT family, id, count(*) AS n, arg_min(seq, (ord, seq)) AS seq, EXISTS (SELECT 1 FROM seqs s WHERE s.label = 'positive' AND s.family = ids.family AND s.accession = ids.id) AS have FROM ids GROUP BY family, id)"""


def _extra(spark, d):
    conv = F.col("conv_id")
    family = F.when(conv % 11 == 0, "none").otherwise(F.element_at(F.array(*[F.lit(x) for x in ("en", "de", "fr", "es")]), (conv % 4 + 1).cast("int")))
    header = F.when(
        F.col("turn") % 2 == 0, F.concat(F.lit("bin"), F.col("turn").cast("string"), F.lit("__LT_"), (conv % 50).cast("string"), F.lit(" product"))
    ).otherwise(F.concat((conv * 3).cast("string"), F.lit(" other words")))
    extra = s.table(spark, d, "conversations").select(family.alias("family"), (conv * 1000 + F.col("turn")).alias("ord"), header.alias("header"), F.col("text").alias("seq"))
    return qc.add_extra_positives(s.doc_sequences(spark, d).filter("label = 'positive'"), extra)


@query("extra_positives", f"WITH {s.DOC_SEQS}, {_EXTRA} SELECT family, 'positive' AS label, family || '_study' AS source_tag, id AS accession, 'unknown' AS organism, seq, length(seq) AS length FROM judged WHERE NOT have")
def extra_positives(spark, d):
    return _extra(spark, d)[0]


@query("extra_positives_manifest", f"""WITH {s.DOC_SEQS}, {_EXTRA} SELECT family, CAST(sum(n) AS BIGINT) AS n_extra_total, count(*) FILTER (NOT have) AS n_appended,
  CAST(sum(n) - count(*) FILTER (NOT have) AS BIGINT) AS n_already_present FROM judged GROUP BY 1""")
def extra_positives_manifest(spark, d):
    return _extra(spark, d)[1]


# --- splits and references -----------------------------------------------------------------

_SPLIT = """n AS (SELECT *, md5('42:' || family || ':' || label || ':' || accession) AS k, count(*) OVER (PARTITION BY family, label) AS tot FROM seqs),
r AS (SELECT *, row_number() OVER (PARTITION BY family, label ORDER BY k) AS rn FROM n WHERE tot >= 5),
split AS (SELECT family, label, accession, organism, seq, length, CASE WHEN rn <= greatest(1, CAST(floor(tot * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split FROM r)"""


def _split(spark, d):
    return split.split_random(s.doc_sequences(spark, d))


@query("split_random", f"WITH {s.DOC_SEQS}, {_SPLIT} SELECT family, label, accession, split FROM split")
def split_random(spark, d):
    return _split(spark, d).select("family", "label", "accession", "split")


@query("split_genus", f"""WITH {s.DOC_SEQS}, g AS (SELECT *, split_part(organism, '_', 1) AS genus FROM seqs),
c AS (SELECT family, label, genus, count(*) AS n FROM g GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER w AS rk, coalesce(sum(n) OVER (PARTITION BY family, label ORDER BY md5('42:' || family || ':' || label || ':' || genus) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    count(*) OVER (PARTITION BY family, label) AS ng, sum(n) OVER (PARTITION BY family, label) AS tot FROM c WINDOW w AS (PARTITION BY family, label ORDER BY md5('42:' || family || ':' || label || ':' || genus)))
SELECT g.family, g.label, g.accession, CASE WHEN before < greatest(1, floor(tot * 0.2)) AND rk <= ng - 1 THEN 'test' ELSE 'train' END AS split
FROM g JOIN o USING (family, label, genus) WHERE tot >= 5""")
def split_genus(spark, d):
    return split.split_by_genus(s.doc_sequences(spark, d)).select("family", "label", "accession", "split")


_LANGS = s.config_sql(s.LANG_FAMILIES)
_DECOYS = """used AS (SELECT DISTINCT accession FROM split WHERE split = 'train' AND label = 'positive'),
decoys AS (SELECT family || '_decoy' AS family, accession, organism, seq FROM split
  WHERE split = 'train' AND label = 'negative' AND family IN (SELECT family FROM families WHERE decoy_from_negatives) AND accession NOT IN (SELECT accession FROM used))"""


def _decoys(spark, d):
    return refs.decoy_refs(_split(spark, d), s.lang_families(spark))


@query("decoy_refs", f"WITH {_LANGS}, {s.DOC_SEQS}, {_SPLIT}, {_DECOYS} SELECT * FROM decoys")
def decoy_refs(spark, d):
    return _decoys(spark, d)


@query("fusion_select", f"""WITH {_FAMILIES}, {s.PART_SEQS}, {s.DOMAINS}, {s.CATALOGUE}, {_PAIR}
SELECT fam_a, fam_b, accession, organism FROM catalogue c JOIN pair_domains p ON list_contains(c.domains, p.domain_a) AND list_contains(c.domains, p.domain_b)""")
def fusion_select(spark, d):
    return refs.select_fused(s.catalogue(spark, d), _pair_domains(spark, d)).select("fam_a", "fam_b", "accession", "organism")


_FUSED = """fc AS (SELECT family, accession, organism, seq FROM classified WHERE outcome IN ('fusion', 'contaminant')),
fp AS (SELECT DISTINCT least(f.family, f.fusion_partner) AS fam_a, greatest(f.family, f.fusion_partner) AS fam_b FROM families f WHERE f.fusion_partner IN (SELECT family FROM families)),
ded AS (SELECT fam_a, fam_b, accession, organism, seq FROM catalogue JOIN pair_domains ON list_contains(domains, domain_a) AND list_contains(domains, domain_b)),
un AS (SELECT fam_a, fam_b, accession, organism, seq, 0 AS prio FROM fp JOIN fc ON fc.family = fam_a UNION ALL
  SELECT fam_a, fam_b, accession, organism, seq, 1 FROM fp JOIN fc ON fc.family = fam_b UNION ALL SELECT fam_a, fam_b, accession, organism, seq, 2 FROM ded),
fused AS (SELECT fam_a || '_' || fam_b || '_fused' AS family, accession, organism, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY fam_a, fam_b, accession ORDER BY prio, organism, seq) AS rn FROM un) WHERE rn = 1)"""


def _fused(spark, d):
    cand = _classified(spark, d).filter(F.col("outcome").isin("fusion", "contaminant"))
    dedicated = refs.select_fused(s.catalogue(spark, d), _pair_domains(spark, d))
    return refs.fusion_refs(sel.fusion_pairs(s.part_families(spark)), cand, dedicated)


@query("fusion_refs", f"{_OUTLIERS}, {s.CATALOGUE}, {_PAIR}, {_FUSED} SELECT * FROM fused")
def fusion_refs(spark, d):
    return _fused(spark, d)


_REFS = f"""fused AS (SELECT * FROM ({_OUTLIERS}, {s.CATALOGUE}, {_PAIR}, {_FUSED} SELECT * FROM fused)),
all_refs AS (
  SELECT family, accession, organism, seq, 'positive' AS kind FROM split WHERE split = 'train' AND label = 'positive'
  UNION ALL SELECT *, 'decoy' FROM decoys UNION ALL SELECT family, accession, organism, seq, 'fused' FROM fused)"""


def _assembled(spark, d):
    return refs.assemble_refs(_split(spark, d), _decoys(spark, d), _fused(spark, d))


@query("assemble_refs", f"WITH {_LANGS}, {s.DOC_SEQS}, {_SPLIT}, {_DECOYS}, {_REFS} SELECT family, accession, organism, kind, length(seq) AS n FROM all_refs")
def assemble_refs(spark, d):
    return _assembled(spark, d).select("family", "accession", "organism", "kind", F.length("seq").alias("n"))


@query("leakage_check", f"""WITH {_LANGS}, {s.DOC_SEQS}, {_SPLIT}, {_DECOYS}, bn AS (SELECT accession, md5(seq) AS digest FROM split WHERE label = 'negative' AND split = 'test'),
t AS (SELECT DISTINCT family, split, accession, md5(seq) AS digest FROM split),
rf AS (SELECT accession, md5(seq) AS digest FROM split WHERE split = 'train' AND label = 'positive' UNION ALL SELECT accession, md5(seq) FROM decoys)
SELECT 'train_test_accession' AS "check", (SELECT count(*) FROM (SELECT family, accession FROM t WHERE split = 'train' INTERSECT SELECT family, accession FROM t WHERE split = 'test')) AS n
UNION ALL SELECT 'train_test_digest', (SELECT count(*) FROM (SELECT family, digest FROM t WHERE split = 'train' INTERSECT SELECT family, digest FROM t WHERE split = 'test'))
UNION ALL SELECT 'refs_negatives_accession', (SELECT count(*) FROM (SELECT accession FROM rf INTERSECT SELECT accession FROM bn))
UNION ALL SELECT 'refs_negatives_digest', (SELECT count(*) FROM (SELECT digest FROM rf INTERSECT SELECT digest FROM bn))""")
def leakage_check(spark, d):
    parts = _split(spark, d)
    positives = parts.filter("split = 'train' and label = 'positive'").select("accession", "seq")
    searchable = positives.unionByName(_decoys(spark, d).select("accession", "seq"))
    return split.leakage_report(parts, searchable, parts.filter("label = 'negative' and split = 'test'"))
