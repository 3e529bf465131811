"""Queries on sequences: k-mers, similarity, clustering, alignments, reads, regions."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from refpanel.functions import revcomp
from refpanel.functions.sequence import GENETIC_CODE
from refpanel.operators import alignment as aln
from refpanel.operators import qc, reads, regions
from refpanel.operators import seed_index as stored
from refpanel.operators import similarity as sim
from refpanel.operators.cluster import cluster_greedy
from refpanel.session import checkpoint_root
from refpanel.workload import standins as s
from refpanel.workload.register import registrar

SQL: dict[str, str] = {}
QUERIES = {}
K = 16

query = registrar(QUERIES, SQL)


@query("revcomp", f"WITH {s.CONTIGS} SELECT contig_id, md5(reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan'))) AS digest FROM contigs")
def revcomp_query(spark, d):
    return s.contigs(spark, d).select("contig_id", F.md5(revcomp("seq")).alias("digest"))


_KMERS = """{name} AS (SELECT {keys}, kmer, min(pos) AS pos FROM (
  SELECT {keys}, i - 1 AS pos, substr(seq, i, {k}) AS kmer FROM (SELECT {keys}, seq, unnest(generate_series(1, length(seq) - {k} + 1)) AS i FROM {src}))
  GROUP BY ALL)"""


@query("kmers", f"WITH src AS (SELECT item_id, text AS seq FROM benchmark) SELECT item_id, CAST(i - 1 AS INTEGER) AS pos, substr(seq, i, 21) AS kmer FROM (SELECT *, unnest(generate_series(1, length(seq) - 20)) AS i FROM src)")
def kmers_query(spark, d):
    return sim.kmer_rows(s.table(spark, d, "benchmark").select("item_id", F.col("text").alias("seq")), ["item_id"], 21)


@query("seed_index", f"WITH {s.DOC_SEQS}, {_KMERS.format(name='idx', keys='family, accession', k=K, src='seqs')} SELECT family, accession, count(*) AS n_kmers, CAST(sum(pos) AS BIGINT) AS pos_sum, min(kmer) AS first_kmer FROM idx GROUP BY 1, 2")
def seed_index(spark, d):
    index = sim.seed_index(s.doc_sequences(spark, d), K)
    return index.groupBy("family", "accession").agg(
        F.count(F.lit(1)).alias("n_kmers"), F.sum("pos").alias("pos_sum"), F.min("kmer").alias("first_kmer")
    )


_BITS = f"((matches * {sim.MATCH} + (span - matches) * ({sim.MISMATCH})) * CAST('{sim.LAMBDA!r}' AS DOUBLE) - CAST('{math.log(sim.KAPPA)!r}' AS DOUBLE)) / CAST('{math.log(2.0)!r}' AS DOUBLE)"


def similarity_sql(q: str, r: str, same_family: bool, max_evalue: float | None = sim.MAX_EVALUE) -> str:
    """All pairs that share a k-mer, aligned without any filter: the brute-force definition."""
    significant = "" if max_evalue is None else f" WHERE q_len * total * pow(CAST(2.0 AS DOUBLE), -bitscore) <= {max_evalue!r}"
    g = "family, " if same_family else ""
    on = "qk.family = rk.family AND " if same_family else ""
    fam = "qk.family" if same_family else "rk.family"
    return f"""qd AS (SELECT {g}min(accession) AS id, any_value(seq) AS seq FROM {q} GROUP BY {g}md5(seq)),
qm AS (SELECT {g}accession, min(accession) OVER (PARTITION BY {g}md5(seq)) AS id FROM {q}),
rd AS (SELECT family, min(accession) AS id, any_value(seq) AS seq FROM {r} GROUP BY family, md5(seq)),
{_KMERS.format(name='qk', keys=g + 'id', k=K, src='qd')}, {_KMERS.format(name='rk', keys='family, id', k=K, src='rd')},
nq AS (SELECT {g}id, count(*) AS n_kmers FROM qk GROUP BY ALL),
dg AS (SELECT {fam} AS family, qk.id AS qid, rk.id AS rid, qk.pos - rk.pos AS diag, count(*) AS n, min(qk.pos) AS lo, max(qk.pos) AS hi
  FROM qk JOIN rk ON {on}qk.kmer = rk.kmer GROUP BY 1, 2, 3, 4),
bd AS (SELECT family, qid, rid, CAST(sum(n) AS BIGINT) AS shared, arg_min({{'n': n, 'diag': diag, 'lo': lo, 'hi': hi}}, (-n, diag)) AS b FROM dg GROUP BY 1, 2, 3),
al AS (SELECT bd.family, qid, rid, shared, b.n AS seeds, b.diag AS diag, b.lo AS q_start, b.hi - b.lo + {K} AS span, length(qd.seq) AS q_len, length(rd.seq) AS r_len,
    string_split(substr(qd.seq, b.lo + 1, b.hi - b.lo + {K}), '') AS qa, string_split(substr(rd.seq, b.lo - b.diag + 1, b.hi - b.lo + {K}), '') AS ra
  FROM bd JOIN nq ON nq.id = qid {'AND nq.family = bd.family' if same_family else ''} JOIN qd ON qd.id = qid {'AND qd.family = bd.family' if same_family else ''}
  JOIN rd ON rd.id = rid AND rd.family = bd.family),
hit AS (SELECT *, len(list_filter(list_zip(qa, ra), lambda x: x[1] = x[2])) AS matches FROM al),
tot AS (SELECT {"family, " if same_family else ""}CAST(sum(length(seq)) AS BIGINT) AS total FROM rd {"GROUP BY 1" if same_family else ""}),
sb AS (SELECT *, {_BITS} AS bitscore FROM hit),
sc AS (SELECT *, q_len * total * pow(CAST(2.0 AS DOUBLE), -bitscore) AS evalue FROM sb {"JOIN tot USING (family)" if same_family else "CROSS JOIN tot"}{significant}),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family, qid ORDER BY bitscore DESC, rid) AS rn FROM sc) WHERE rn = 1),
sim AS (SELECT t.family, qm.accession, t.rid AS subject_id, CAST(shared AS BIGINT) AS shared, CAST(diag AS INTEGER) AS diag, CAST(q_start AS INTEGER) AS q_start,
    CAST(span AS INTEGER) AS span, CAST(matches AS INTEGER) AS matches, matches * 100.0 / CAST(span AS DOUBLE) AS pident, span / CAST(q_len AS DOUBLE) AS qcov, span / CAST(r_len AS DOUBLE) AS scov, bitscore, evalue
  FROM qm JOIN top t ON qm.id = t.qid {'AND qm.family = t.family' if same_family else ''})"""


_SIM_COLUMNS = ["family", "accession", "subject_id", "shared", "diag", "q_start", "span", "matches", "pident", "qcov", "scov", "bitscore", "evalue"]


def _items(spark, d):
    return s.table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("accession"), F.col("text").alias("seq"))


_ITEMS = "items AS (SELECT CAST(item_id AS VARCHAR) AS accession, text AS seq FROM benchmark)"


# The best hit of every query, significant or not. The E-value of a weak one passes any number, so none is given.
@query("similarity_join", f"WITH {s.DOC_SEQS}, {_ITEMS}, {similarity_sql('items', 'seqs', False, None)} SELECT * REPLACE (CASE WHEN evalue <= 1 THEN round(evalue, 9) END AS evalue) FROM sim")
def similarity_join(spark, d):
    docs = s.doc_sequences(spark, d).select("family", "accession", "seq")
    found = sim.similarity_join(_items(spark, d), docs, K, None, same_family=False).select(*_SIM_COLUMNS)
    return found.withColumn("evalue", F.when(F.col("evalue") <= 1, F.round("evalue", 9)))


# The later of two releases: the first one's rows but for English, and Spanish ones that are new.
_LATER = "later AS (SELECT * FROM seqs WHERE family <> 'en')"


@query("indexed_search", f"WITH {s.DOC_SEQS}, {_LATER}, {_ITEMS}, {similarity_sql('items', 'later', False)} SELECT * REPLACE (round(evalue, 9) AS evalue) FROM sim")
def indexed_search(spark, d):
    docs = s.doc_sequences(spark, d).select("family", "accession", "seq")
    folder = f"{checkpoint_root(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    stored.create_seed_index(spark, folder, K, same_family=False)
    stored.add_release(docs.filter("family <> 'es'"), folder, "v1")
    stored.add_release(docs.filter("family <> 'en'"), folder, "v2")
    return stored.indexed_search(_items(spark, d), folder, "v2").select(*_SIM_COLUMNS).withColumn("evalue", F.round("evalue", 9))


def _purity_sql(max_evalue: float | None) -> str:
    return f"""WITH {s.DOC_SEQS}, negs AS (SELECT family, accession, seq FROM seqs WHERE label = 'negative'), poss AS (SELECT family, accession, seq FROM seqs WHERE label = 'positive'),
{similarity_sql('negs', 'poss', True, max_evalue)},
checked AS (SELECT n.family, n.accession, coalesce(pident, 0.0) AS max_pident, coalesce(pident, 0.0) >= 70.0 AS flagged FROM negs n LEFT JOIN sim USING (family, accession))"""


def _checked(spark, d, max_evalue: float | None):
    seqs = s.doc_sequences(spark, d).select("family", "label", "accession", "seq")
    negatives = seqs.filter("label = 'negative'")
    hits = sim.similarity_join(negatives, seqs.filter("label = 'positive'"), K, max_evalue)
    return qc.negative_purity(negatives, hits)


@query("negative_purity", f"{_purity_sql(None)} SELECT * FROM checked")
def negative_purity(spark, d):
    return _checked(spark, d, None).select("family", "accession", "max_pident", "flagged")


@query("purity_manifest", f"{_purity_sql(None)} SELECT family, count(*) AS n_total, count(*) FILTER (NOT flagged) AS n_kept, count(*) FILTER (flagged) AS n_flagged, CAST(70.0 AS DOUBLE) AS threshold_pident FROM checked GROUP BY 1")
def purity_manifest(spark, d):
    return qc.purity_manifest(_checked(spark, d, None))


@query("worst_impurity", f"""{_purity_sql(sim.MAX_EVALUE)} SELECT family, accession, max_pident FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY max_pident DESC, accession) AS rn FROM checked WHERE flagged) WHERE rn = 1""")
def worst_impurity(spark, d):
    return qc.worst_impurity(_checked(spark, d, sim.MAX_EVALUE))


# Every pair that agrees in a word of eight letters, or shorter ones in short sequences, is compared
# on that diagonal; then one sequence after the other.
_CLUSTER = """nd AS (SELECT *, length(seq) AS len, CAST(floor((1 - CAST(0.9 AS DOUBLE)) * length(seq) + 1e-9) AS BIGINT) AS x FROM (SELECT family, label, min(accession) AS id, any_value(seq) AS seq FROM seqs GROUP BY family, label, md5(seq))),
big AS (SELECT family, label FROM seqs GROUP BY 1, 2 HAVING count(*) >= 5),
nn AS MATERIALIZED (SELECT nd.*, list_max(list_filter(range(1, 9), lambda j: len // j > x)) AS k, row_number() OVER (PARTITION BY family, label ORDER BY len DESC, id) AS n FROM nd JOIN big USING (family, label)),
qw AS (SELECT family, label, n, k, k * (i - 1) AS pos, substr(seq, k * (i - 1) + 1, k) AS w FROM (SELECT *, unnest(range(1, len // k + 1)) AS i FROM nn)),
ks AS (SELECT DISTINCT k FROM nn WHERE k IS NOT NULL),
rw AS (SELECT family, label, n, k, i - 1 AS pos, substr(seq, i, k) AS w FROM (SELECT nn.* EXCLUDE (k), ks.k, unnest(range(1, len - ks.k + 2)) AS i FROM nn CROSS JOIN ks)),
met AS (SELECT qw.family, qw.label, qw.n AS q, rw.n AS r, qw.pos - rw.pos AS diag, count(*) AS c FROM qw JOIN rw ON qw.family = rw.family AND qw.label = rw.label AND qw.k = rw.k AND qw.w = rw.w AND rw.n < qw.n GROUP BY ALL),
al AS (SELECT met.family, met.label, q, r, a.len, string_split(substr(a.seq, greatest(0, diag) + 1, least(a.len, b.len + diag) - greatest(0, diag)), '') AS qa, string_split(substr(b.seq, greatest(0, diag) - diag + 1, least(a.len, b.len + diag) - greatest(0, diag)), '') AS ra
  FROM met JOIN nn a ON a.family = met.family AND a.label = met.label AND a.n = q JOIN nn b ON b.family = met.family AND b.label = met.label AND b.n = r WHERE c >= a.len // a.k - a.x),
near AS MATERIALIZED (SELECT DISTINCT family, label, q, r FROM al WHERE len(list_filter(list_zip(qa, ra), lambda z: z[1] = z[2])) / CAST(len AS DOUBLE) >= 0.9),
before AS MATERIALIZED (SELECT nn.family, nn.label, nn.n, list(r ORDER BY r) FILTER (r IS NOT NULL) AS earlier FROM nn LEFT JOIN near ON near.family = nn.family AND near.label = nn.label AND q = nn.n GROUP BY ALL),
walk(family, label, n, reps, owner) AS (SELECT family, label, 0, CAST([] AS BIGINT[]), CAST(0 AS BIGINT) FROM big
  UNION ALL SELECT w.family, w.label, w.n + 1, CASE WHEN list_has_any(coalesce(b.earlier, []), w.reps) THEN w.reps ELSE list_append(w.reps, w.n + 1) END,
    coalesce(list_min(list_intersect(coalesce(b.earlier, []), w.reps)), w.n + 1) FROM walk w JOIN before b ON b.family = w.family AND b.label = w.label AND b.n = w.n + 1)"""


@query("cluster_greedy", f"""WITH RECURSIVE {s.DOC_SEQS}, {_CLUSTER}
SELECT s.family, s.label, s.accession, coalesce(o.id, s.accession) AS representative FROM seqs s LEFT JOIN nn a ON a.family = s.family AND a.label = s.label AND a.seq = s.seq
LEFT JOIN walk ON walk.family = a.family AND walk.label = a.label AND walk.n = a.n LEFT JOIN nn o ON o.family = a.family AND o.label = a.label AND o.n = walk.owner""")
def cluster(spark, d):
    return cluster_greedy(s.doc_sequences(spark, d))


# --- alignments ----------------------------------------------------------------------------

_OCCUPANCY = """cells AS (SELECT family, accession, unnest(string_split(aligned, '')) AS residue, CAST(generate_subscripts(string_split(aligned, ''), 1) - 1 AS INTEGER) AS col FROM alignment),
depth AS (SELECT family, count(*) AS n_rows FROM alignment GROUP BY 1),
occ AS (SELECT family, col, count(*) FILTER (residue <> '-') AS n_filled, n_rows, CAST(count(*) FILTER (residue <> '-') AS DOUBLE) / n_rows AS occupancy FROM cells JOIN depth USING (family) GROUP BY family, col, n_rows)"""


@query("column_occupancy", f"WITH {s.ALIGNMENT}, {_OCCUPANCY} SELECT * FROM occ")
def column_occupancy(spark, d):
    return aln.column_occupancy(s.alignment(spark, d))


_TRIM = f"""{_OCCUPANCY}, kept AS (SELECT family, list(col ORDER BY col) AS cols FROM occ JOIN families USING (family) WHERE n_rows >= 2 AND occupancy >= coalesce(trim_gt, 0.8) GROUP BY 1),
trimmed AS (SELECT family, accession, coalesce(array_to_string(list_transform(cols, lambda c: coalesce(a[c + 1], '-')), ''), '') AS trimmed
  FROM (SELECT *, string_split(aligned, '') AS a FROM alignment) LEFT JOIN kept USING (family))"""


@query("trim_alignment", f"WITH {s.config_sql(s.LANG_FAMILIES)}, {s.ALIGNMENT}, {_TRIM} SELECT * FROM trimmed")
def trim_alignment(spark, d):
    return aln.trim_alignment(s.alignment(spark, d), s.lang_families(spark))


_PROFILE = """cells AS (SELECT family, unnest(string_split(aligned, '')) AS residue, CAST(generate_subscripts(string_split(aligned, ''), 1) - 1 AS INTEGER) AS col FROM alignment),
cnt AS (SELECT family, col, residue, count(*) AS n FROM cells WHERE residue <> '-' GROUP BY 1, 2, 3),
bg AS (SELECT residue, CAST(sum(n) AS DOUBLE) / CAST((SELECT sum(n) FROM cnt) AS DOUBLE) AS bg FROM cnt GROUP BY 1),
prof AS (SELECT family, col, residue, n, CAST(sum(n) OVER (PARTITION BY family, col) AS BIGINT) AS depth, bg FROM cnt JOIN bg USING (residue))"""


@query("profile_build", f"WITH {s.ALIGNMENT}, {_PROFILE} SELECT family, col, residue, n, depth, round(log2((n + 1.0 * bg) / (depth + 1.0) / bg), 6) AS log_odds FROM prof")
def profile_build(spark, d):
    return aln.build_profile(s.alignment(spark, d)).withColumn("log_odds", F.round("log_odds", 6))


@query("profile_scan", f"""WITH {s.ALIGNMENT}, items AS (SELECT CAST(item_id AS VARCHAR) AS accession, replace(replace(text, ' ', ''), '-', '') AS seq FROM benchmark),
members AS (SELECT family, accession, replace(aligned, '-', '') AS seq FROM alignment), {similarity_sql('items', 'members', False, None)}, {_PROFILE},
fill AS (SELECT family, accession, list_filter(list_transform(string_split(aligned, ''), lambda x, i: CASE WHEN x <> '-' THEN i - 1 END), lambda x: x IS NOT NULL) AS cols FROM alignment),
sp AS (SELECT sim.family, sim.accession, subject_id, q_start, diag, seq, unnest(generate_series(0, span - 1)) AS off FROM sim JOIN items USING (accession)),
mp AS (SELECT sp.family, sp.accession, substr(seq, CAST(q_start + off + 1 AS BIGINT), 1) AS residue, cols[q_start + off - diag + 1] AS col FROM sp JOIN fill ON fill.family = sp.family AND fill.accession = sp.subject_id)
SELECT mp.family, mp.accession AS query_id, round(sum(log2((n + 1.0 * bg) / (depth + 1.0) / bg)), 6) AS score, count(*) AS n_scored
FROM mp JOIN prof p ON p.family = mp.family AND p.col = mp.col AND p.residue = mp.residue GROUP BY 1, 2""")
def profile_scan(spark, d):
    rows = s.alignment(spark, d)
    queries = _items(spark, d).withColumn("seq", F.replace(F.replace("seq", F.lit(" "), F.lit("")), F.lit("-"), F.lit("")))
    return aln.profile_scan(queries, rows, aln.build_profile(rows), K, max_evalue=None).withColumn("score", F.round("score", 6))


# --- reads ---------------------------------------------------------------------------------

LENGTHS, STRIDE = [100, 150], 120


def _tiles(spark, d):
    return reads.tile_reads(s.contigs(spark, d), LENGTHS, STRIDE)


@query("tile_reads", f"WITH {s.CONTIGS}, {s.TILES} SELECT * FROM reads")
def tile_reads(spark, d):
    return _tiles(spark, d)


_ASSIGN = """asg AS (SELECT r.read_id, max_by(c.contig_id, length(c.contig_id)) AS contig_id FROM reads r LEFT JOIN contigs c ON starts_with(r.read_id, c.contig_id) GROUP BY 1)"""


@query("contig_assign", f"WITH {s.CONTIGS}, {s.TILES}, {_ASSIGN} SELECT * FROM asg")
def contig_assign(spark, d):
    return reads.assign_contig(_tiles(spark, d).select("read_id"), s.contigs(spark, d)).select("read_id", "contig_id")


_LOCATE = """probe AS (
  SELECT read_id, contig_id, o, read_length AS n, cseq, i, substr(q, CAST(i + 1 AS BIGINT), 21) AS kmer FROM (
    SELECT r.read_id, r.contig_id, o, r.read_length, c.seq AS cseq, CASE WHEN o = 0 THEN r.seq ELSE reverse(translate(r.seq, 'ACGTNacgtn', 'TGCANtgcan')) END AS q,
           unnest(generate_series(0, r.read_length - 21, greatest(1, (r.read_length - 21) // 8))) AS i
    FROM reads r JOIN contigs c USING (contig_id) CROSS JOIN (VALUES (0), (1)) os(o) WHERE r.read_length >= 21)),
placed AS (SELECT *, length(cseq) - instr(reverse(cseq), reverse(kmer)) - 20 - i AS st FROM probe WHERE instr(cseq, kmer) > 0),
located AS (SELECT read_id, contig_id, n AS read_length, CAST(arg_min(st, (o, i)) AS INTEGER) AS start, CAST(arg_min(st, (o, i)) + n AS INTEGER) AS "end"
  FROM placed WHERE st >= 0 AND st + n <= length(cseq) GROUP BY 1, 2, 3)"""


@query("locate_reads", f'WITH {s.CONTIGS}, {s.TILES}, {_LOCATE} SELECT read_id, contig_id, start, "end" FROM located')
def locate_reads(spark, d):
    return reads.locate_reads(_tiles(spark, d).select("read_id", "contig_id", "seq"), s.contigs(spark, d)).select("read_id", "contig_id", "start", "end")


_CDS = """greatest(0, least("end", length(c.seq) - 300) - greatest(start, 300))"""


@query("cds_overlap", f'WITH {s.CONTIGS}, {s.TILES} SELECT read_id, CAST({_CDS} AS INTEGER) AS overlap_bp, CAST({_CDS} >= 20 AS INTEGER) AS overlaps_cds FROM reads JOIN contigs c USING (contig_id) WHERE length(c.seq) - 300 > 300')
def cds_overlap(spark, d):
    return reads.cds_overlap(_tiles(spark, d), reads.cds_bounds(s.contigs(spark, d))).select("read_id", "overlap_bp", "overlaps_cds")


@query("read_truth", f"""WITH {s.CONTIGS}, {s.TILES}, {_LOCATE} SELECT read_id, c.family, c.label, c.accession, CAST({_CDS} >= 20 AS INTEGER) AS overlaps_cds, CAST({_CDS} AS INTEGER) AS overlap_bp, read_length
FROM located JOIN contigs c USING (contig_id) WHERE length(c.seq) - 300 > 300""")
def read_truth(spark, d):
    return reads.read_truth(_tiles(spark, d).select("read_id", "seq"), s.contigs(spark, d))


@query("background_union", """SELECT CAST(o_orderkey AS VARCHAR) AS read_id, o_orderstatus AS family, 'positive' AS label, CAST(o_custkey AS VARCHAR) AS accession, 1 AS overlaps_cds, 150 AS overlap_bp, 150 AS read_length FROM orders
UNION ALL SELECT conv_id || '_' || turn, 'background', 'negative', '', 0, 0, CAST(length(text) AS INTEGER) FROM conversations""")
def background_union(spark, d):
    truth = s.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("read_id"), F.col("o_orderstatus").alias("family"), F.lit("positive").alias("label"),
        F.col("o_custkey").cast("string").alias("accession"), F.lit(1).alias("overlaps_cds"), F.lit(150).alias("overlap_bp"), F.lit(150).alias("read_length"),
    )
    background = s.table(spark, d, "conversations").select(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("read_id"), F.col("text").alias("seq"))
    return reads.with_background(truth, background)


_ORFS = f"""strands AS (SELECT read_id, f, add_, CASE WHEN add_ = 0 THEN seq ELSE reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan')) END AS q
  FROM reads CROSS JOIN (VALUES (1), (2), (3)) fs(f) CROSS JOIN (VALUES (0), (3)) adds(add_)),
aas AS (SELECT read_id, f, f + add_ AS frame, string_split(array_to_string(list_transform(generate_series(0, (length(q) - f + 1) // 3 - 1),
    lambda i: substr('{GENETIC_CODE}', 16 * (strpos('TCAG', substr(q, f + 3 * i, 1)) - 1) + 4 * (strpos('TCAG', substr(q, f + 3 * i + 1, 1)) - 1) + strpos('TCAG', substr(q, f + 3 * i + 2, 1)), 1)), ''), '*') AS parts FROM strands),
pieces AS (SELECT read_id, f, frame, i, parts[i] AS aa, f + 3 * (i - 1 + coalesce(list_sum(list_transform(parts[:i - 1], lambda x: length(x))), 0)) AS start
  FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i FROM aas)),
orfs AS (SELECT read_id || '_' || CAST(start AS INTEGER) || '_' || frame || '_' || row_number() OVER (PARTITION BY read_id, frame ORDER BY i) AS orf_id, read_id, frame, CAST(start AS INTEGER) AS start, aa
  FROM pieces WHERE length(aa) >= 20)"""


@query("translate_orfs", f"WITH {s.CONTIGS}, {s.TILES}, {_ORFS} SELECT * FROM orfs")
def translate_orfs(spark, d):
    return reads.translate_orfs(_tiles(spark, d).select("read_id", "seq"), min_aa=20)


# --- regions -------------------------------------------------------------------------------


def _coord_reads(spark, d):
    e = F.col("event_id")
    text = lambda c: c.cast("string")
    good = F.concat(F.lit("NC_"), text(F.col("user_id")), F.lit(".3_"), text(e * 7), F.lit("_"), text(e * 7 + 300), F.lit("_0:1:0_2:0:0_"), F.lower(F.hex(e)), F.lit("/"), text(e % 2 + 1))
    return s.table(spark, d, "events").select(F.when(e % 13 == 0, F.concat(F.lit("odd_"), text(e))).otherwise(good).alias("read_id"))


@query("read_coords", """SELECT CASE WHEN event_id % 13 = 0 THEN 'odd_' || event_id ELSE 'NC_' || user_id || '.3_' || (event_id * 7) || '_' || (event_id * 7 + 300) || '_0:1:0_2:0:0_' || printf('%x', event_id) || '/' || (event_id % 2 + 1) END AS read_id,
  event_id % 13 <> 0 AS parsed, CASE WHEN event_id % 13 <> 0 THEN 'NC_' || user_id || '.3' END AS contig,
  CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id % 2 + 1 = 1 THEN event_id * 7 ELSE event_id * 7 + 300 END END AS start,
  CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id % 2 + 1 = 1 THEN event_id * 7 ELSE event_id * 7 + 300 END + 149 END AS "end" FROM events""")
def read_coords(spark, d):
    return regions.parse_read_coords(_coord_reads(spark, d))


@query("region_overlap", f"""WITH {s.REGION_READS}, {s.REGIONS}
SELECT r.read_id, r.contig, r.start, r."end", coalesce(arg_min(g.family, g.ord), 'background') AS family
FROM reads r LEFT JOIN regions g ON g.contig = r.contig AND least(r."end", g."end") - greatest(r.start, g.start) + 1 >= 20 GROUP BY 1, 2, 3, 4""")
def region_overlap(spark, d):
    return regions.overlap_regions(s.region_reads(spark, d), s.regions(spark, d))


def _orf_tables(spark, d):
    key, supp = F.col("p_partkey"), F.col("s_suppkey") * 30
    name = lambda k: F.concat(F.lit("ctg_"), (k % 10).cast("string"), F.lit("_"), k.cast("string"))
    headers = s.table(spark, d, "part").select(F.concat(name(key), F.lit(" # "), (key * 10 + 1).cast("string"), F.lit(" # "), (key * 10 + F.col("p_size")).cast("string"), F.lit(" # 1 # ID=x")).alias("header"))
    return headers, s.table(spark, d, "supplier").select(F.col("s_name").alias("family"), name(supp).alias("orf_id"))


@query("region_extract", "SELECT s_name AS family, 'ctg_' || (p_partkey % 10) AS contig, CAST(p_partkey * 10 + 1 AS INTEGER) AS start, CAST(p_partkey * 10 + p_size AS INTEGER) AS \"end\" FROM supplier JOIN part ON p_partkey = s_suppkey * 30")
def region_extract(spark, d):
    return regions.extract_regions(*_orf_tables(spark, d))[0]


@query("region_missing", "SELECT s_name AS family FROM supplier WHERE s_suppkey * 30 NOT IN (SELECT p_partkey FROM part)")
def region_missing(spark, d):
    return regions.extract_regions(*_orf_tables(spark, d))[1]
