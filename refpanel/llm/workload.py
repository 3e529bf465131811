"""One query per operator over the shared test tables, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from refpanel.llm import (
    collocations,
    decontaminate,
    merkle,
    near_dedup,
    ngram,
    pieces,
    quality_rank,
    quality_rules,
    revisits,
    sanitise,
    simhash,
    token_count,
    toxicity,
)
from refpanel.llm.common import table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_kneser_ney(spark, d):
    docs = table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    model = ngram.train(docs.filter(F.coalesce(~held_out, F.lit(True))), order=3)
    scores = ngram.score(docs, model)
    columns = [F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"]
    return scores.select("doc_id", *columns)


@query
def op2_token_counts(spark, d):
    return token_count.count_tokens(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_minmax_dedup(spark, d):
    return near_dedup.near_duplicates(table(spark, d, "documents"))


@query
def op4_toxicity(spark, d):
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))


@query
def op5_quality_rules(spark, d):
    return quality_rules.filter_quality(table(spark, d, "documents"))


@query
def op6_quality_rank(spark, d):
    docs = table(spark, d, "documents")
    return quality_rank.score(docs, quality_rank.fit(docs, table(spark, d, "labels")))


def captures(spark, d):
    """Pages as a crawl: each page is a capture of one of three resources of its folder, every
    third of them not modified; times tie, validators change over time and sometimes are missing."""
    page, url = F.col("page_id"), F.col("url")
    number = F.regexp_extract(url, "/([0-9]+)", 1).cast("long") % 3
    ts = (page * 7919) % 100003
    revisit = page % 3 == 1
    tag = F.concat(F.when(page % 5 == 0, "W/").otherwise(""), F.lit("v"), F.floor(ts / 20000).cast("string"))
    date = F.concat(F.lit("d"), F.floor(ts / 30000).cast("string"))
    headers = F.map_from_entries(
        F.filter(
            F.array(
                F.when(page % 7 != 0, F.struct(F.lit("etag"), tag)),
                F.when(page % 11 != 0, F.struct(F.lit("last-modified"), date)),
                F.struct(F.lit("date"), ts.cast("string")),
                F.struct(F.lit("content-length"), F.when(revisit, "0").otherwise(F.length("html").cast("string"))),
            ),
            lambda h: h.isNotNull(),
        )
    )
    return table(spark, d, "pages").select(
        page.alias("record_id"),
        F.regexp_replace(url, "/[0-9]+(?:[.]html|/)?", F.concat(F.lit("/"), number.cast("string"))).alias("url"),
        ts.alias("ts"),
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, 304).when(page % 13 == 0, 503).otherwise(200).alias("status"),
        headers.alias("headers"),
        F.when(~revisit, F.col("html")).alias("payload"),
    )


@query
def op7_revisits(spark, d):
    found = revisits.resolve(captures(spark, d))
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda h: F.concat(h["key"], F.lit("="), h["value"]))), ";")
    return found.select("record_id", "url", "source_id", "outcome", shown.alias("headers"), F.md5("payload").alias("payload_md5"))


SQL["op7_revisits"] = """WITH c AS (
  SELECT page_id AS id, regexp_replace(url, '/[0-9]+(?:[.]html|/)?', '/' || (CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) % 3)) AS raw,
    (page_id * 7919) % 100003 AS ts, page_id % 3 = 1 AS revisit, CASE WHEN page_id % 3 = 1 THEN 304 WHEN page_id % 13 = 0 THEN 503 ELSE 200 END AS status,
    CASE WHEN page_id % 7 <> 0 THEN (CASE WHEN page_id % 5 = 0 THEN 'W/' ELSE '' END) || 'v' || CAST(floor((page_id * 7919) % 100003 / 20000) AS BIGINT) END AS tag,
    CASE WHEN page_id % 11 <> 0 THEN 'd' || CAST(floor((page_id * 7919) % 100003 / 30000) AS BIGINT) END AS changed, html FROM pages),
u AS (SELECT *, replace(tag, 'W/', '') AS plain, regexp_replace(raw, '[?#].*', '') AS base,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(raw, '[?]([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS asked FROM c),
n AS (SELECT *, base || CASE WHEN asked = '' THEN '' ELSE '?' || asked END AS url FROM u),
f AS (SELECT * FROM n WHERE status = 200),
m AS (SELECT r.id, max(struct_pack(t := f.ts, i := f.id)) AS got FROM n r JOIN f ON f.url = r.url AND (f.ts < r.ts OR f.ts = r.ts AND f.id < r.id) WHERE r.revisit GROUP BY r.id),
j AS (SELECT r.id, r.url, r.ts, r.tag, r.changed, s.id AS sid, s.tag AS stag, s.changed AS schanged, s.html,
    CASE WHEN s.id IS NULL THEN 'no_response' WHEN coalesce(r.plain = s.plain, r.plain IS NULL AND coalesce(r.changed = s.changed, r.changed IS NULL)) THEN 'resolved' ELSE 'changed' END AS outcome
  FROM n r LEFT JOIN m ON m.id = r.id LEFT JOIN n s ON s.id = m.got.i WHERE r.revisit)
SELECT id AS record_id, url, CASE WHEN outcome = 'resolved' THEN sid END AS source_id, outcome,
  CASE WHEN outcome = 'resolved' THEN 'content-length=' || length(html) || ';date=' || ts || coalesce(';etag=' || coalesce(tag, stag), '') || coalesce(';last-modified=' || coalesce(changed, schanged), '') END AS headers,
  CASE WHEN outcome = 'resolved' THEN md5(html) END AS payload_md5 FROM j"""


@query
def op8_sentencepiece(spark, d):
    found = pieces.encode(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_decontamination(spark, d):
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", F.size("near_items").cast("long").alias("n_near"))


@query
def op10_disclosure(spark, d):
    found = sanitise.report(table(spark, d, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op11_simhash_dedup(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query
def op12_merkle_manifest(spark, d):
    docs = table(spark, d, "documents")
    return merkle.audit(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


_BYTES = "octet_length(encode({0})) || ':' || {0}"
_LEAF = "sha256(" + " || ".join(f"coalesce({_BYTES.format(f'CAST({c} AS VARCHAR)')}, '-')" for c in ("doc_id", "source", "lang", "n_chars")) + " || coalesce(" + _BYTES.format("{text}") + ", '-'))"
# Fixed value: the reflected polynomial of the 32-bit checksum.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda s, b: list_reduce(list_prepend(xor(s, b), CAST(range(8) AS BIGINT[])), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
SQL["op12_merkle_manifest"] = f"""WITH RECURSIVE d AS (
  SELECT *, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text="replace(text, chr(10), '')")} AS spoilt, coalesce({_CRC} % 2 = 0, false) AS tampered FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size FROM d),
t(source, lvl, pos, size, digest) AS (SELECT source, 0, pos, size, leaf FROM leaves
  UNION ALL SELECT source, lvl + 1, pos // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM t WHERE size > 1 GROUP BY source, lvl, pos // 3, size),
tops AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM t WHERE size = 1),
u(lvl, pos, size, digest) AS (SELECT 0, pos, size, subroot FROM tops
  UNION ALL SELECT lvl + 1, pos // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM u WHERE size > 1 GROUP BY lvl, pos // 3, size),
runs AS (SELECT source, lvl, pos // 3 AS run, list(digest ORDER BY pos) AS h FROM t WHERE size > 1 GROUP BY ALL),
upper AS (SELECT lvl, pos // 3 AS run, list(digest ORDER BY pos) AS h FROM u WHERE size > 1 GROUP BY ALL),
up AS (SELECT leaves.doc_id, leaves.leaf, leaves.source, leaves.pos AS place, lvl, CAST(leaves.pos // CAST(3 ** lvl AS BIGINT) % 3 AS BIGINT) AS spot, h FROM leaves JOIN runs ON runs.source IS NOT DISTINCT FROM leaves.source AND run = leaves.pos // CAST(3 ** (lvl + 1) AS BIGINT)
  UNION ALL SELECT leaves.doc_id, leaves.leaf, leaves.source, leaves.pos, 100 + lvl, CAST(tops.pos // CAST(3 ** lvl AS BIGINT) % 3 AS BIGINT), h FROM leaves JOIN tops ON tops.source IS NOT DISTINCT FROM leaves.source JOIN upper ON run = tops.pos // CAST(3 ** (lvl + 1) AS BIGINT)),
steps AS (SELECT source, place, list({{'l': array_to_string(list_slice(h, 1, spot), ''), 'r': array_to_string(list_slice(h, spot + 2, len(h)), ''), 'all': ''}} ORDER BY lvl) AS way FROM up GROUP BY ALL),
done AS (SELECT leaves.*, tops.subroot, (SELECT digest FROM u WHERE size = 1) AS root, coalesce(way, []) AS way, CASE WHEN tampered THEN spoilt ELSE leaf END AS checked
  FROM leaves JOIN tops ON tops.source IS NOT DISTINCT FROM leaves.source LEFT JOIN steps ON steps.source IS NOT DISTINCT FROM leaves.source AND steps.place = leaves.pos),
folded AS (SELECT *, list_reduce(list_prepend({{'l': '', 'r': '', 'all': checked}}, way), lambda x, s: {{'l': '', 'r': '', 'all': sha256(s.l || x['all'] || s.r)}})['all'] AS folded_root FROM done)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


@query
def op13_collocations(spark, d):
    return collocations.mine(table(spark, d, "documents"))


SQL["op13_collocations"] = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words FROM p),
size AS (SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) ks(k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
cut AS (SELECT c.*, j, array_to_string(words[1:j], ' ') AS one, array_to_string(words[j + 1:k], ' ') AS two FROM c, range(1, 5) js(j) WHERE j < c.k),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, n, 1000 * cut.a * n // (x.a * y.a) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = one JOIN f y ON y.lang = cut.lang AND y.phrase = two JOIN size ON size.lang = cut.lang),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS rn FROM s) WHERE rn = 1),
held AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN c y ON x.lang = y.lang AND y.k > x.k AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') AND y.a >= x.a),
kept AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best ANTI JOIN held USING (lang, phrase))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM kept WHERE rank <= 2000"""
