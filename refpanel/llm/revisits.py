"""Not-modified revisits of web archives resolved to the response they confirm.

A revisit record holds only the headers of a 304 answer. The response it stands for is the latest
earlier full response of the same canonical URL, found by an as-of join over time slices: within a
slice by a window, across slices by carrying each URL's last response. Slices are quantiles of
time, so even a URL with most records is dealt over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refpanel.llm.common import store

#: Time slices; a (URL, slice) group holds about this fraction of all rows at most.
SLICES = 256
#: Headers of a 304 answer that describe its own transfer or body, and so never
#: replace those of the stored response.
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, fragment, user or ``utm_`` parameters, at least
    a slash as path; the remaining parameters sorted. Null stays null."""
    url = F.regexp_replace(F.trim(url), "#.*$", "")
    part = lambda k: F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?@]*@)?([^/?]*)([^?]*)(?:\?(.*))?$", k)
    scheme, host = F.lower(part(1)), F.lower(part(2))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when(part(3) == "", "/").otherwise(part(3))
    asked = F.array_join(F.array_sort(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    whole = F.concat(scheme, F.lit("://"), host, path, F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))
    return F.when(scheme == "", url).otherwise(whole)


def latest_before(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """``id, source``: for every row of (key, ts, id, full) with a key and time that is not full,
    the id of the last full row of its key before it, by time and then id; null where none is."""
    cuts = records.approxQuantile("ts", [k / slices for k in range(1, slices)], 0.25 / slices) if slices > 1 else []
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    rows = records.withColumn("slice", F.size(F.filter(bounds, lambda c: c <= F.col("ts"))))
    this = F.when(F.col("full"), F.struct("ts", "id"))
    last = store(rows.filter("full").groupBy("key", "slice").agg(F.max(F.struct("ts", "id")).alias("last")), "last")
    slots = rows.select("key", "slice").distinct()
    by_slice = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.join(last, ["key", "slice"], "left").select("key", "slice", F.last("last", ignorenulls=True).over(by_slice).alias("carried"))
    in_slice = Window.partitionBy("key", "slice").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("own", F.last(this, ignorenulls=True).over(in_slice)).filter("NOT full").drop("full")
    found = found.join(store(carried.filter("carried IS NOT NULL"), "carried"), ["key", "slice"], "left")
    return found.select("id", F.coalesce("own.id", "carried.id").alias("source"))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(F.element_at(headers, "etag")), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit record with the response it stands for.

    ``records``: ``record_id`` (unique), ``url``, ``ts`` (number), ``kind`` (``response`` or
    ``revisit``), ``status``, ``headers`` (map, lower-case names), ``payload``; other columns are
    ignored. A full response is one of status 200. Returns ``record_id, url`` (canonical),
    ``source_id, outcome, status, headers, payload`` per revisit. Outcomes: ``resolved``;
    ``no_response`` (no earlier one, or no URL or time); ``changed`` (its validator, the entity tag
    or else the date of last modification, is not that of the response): then source, headers and
    payload stay null. A revisit without validators is taken at its word. Headers are those of the
    response, replaced by those of the revisit that may be merged.
    """
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url"), F.col("ts").cast("double").alias("ts"), "kind", "status", "headers", "payload")
    empty = F.create_map().cast("map<string,string>")
    revisits = rows.filter("kind = 'revisit'").select("record_id", "url", F.coalesce("headers", empty).alias("mine"))
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    times = rows.filter(F.col("url").isNotNull() & F.col("ts").isNotNull() & ((F.col("kind") == "revisit") | full))
    times = store(times.select(F.xxhash64("url").alias("key"), "ts", F.col("record_id").alias("id"), (F.col("kind") == "response").alias("full")), "times")
    sources = store(latest_before(times).filter("source IS NOT NULL").select(F.col("id").alias("record_id"), "source"), "sources")
    responses = rows.filter(full).select(F.col("record_id").alias("source"), F.col("url").alias("_url"), F.col("status").alias("_status"), F.coalesce("headers", empty).alias("stored"), F.col("payload").alias("_payload"))
    found = revisits.join(sources, "record_id", "left").join(responses, "source", "left")
    tag, date = _tag(F.col("mine")), F.element_at("mine", "last-modified")
    same = F.when(tag.isNotNull(), tag.eqNullSafe(_tag(F.col("stored")))).when(date.isNotNull(), date.eqNullSafe(F.element_at("stored", "last-modified"))).otherwise(True)
    outcome = F.when(F.col("stored").isNull() | (F.col("_url") != F.col("url")), "no_response").when(same, "resolved").otherwise("changed")
    merged = F.map_filter("mine", lambda k, v: ~k.isin(*NOT_MERGED))
    headers = F.map_concat(F.map_filter("stored", lambda k, v: ~F.map_contains_key(merged, k)), merged)
    only = lambda c: F.when(F.col("outcome") == "resolved", c)
    return found.withColumn("outcome", outcome).select(
        "record_id", "url", only(F.col("source")).alias("source_id"), "outcome", only(F.col("_status")).alias("status"), only(headers).alias("headers"), only(F.col("_payload")).alias("payload")
    )
