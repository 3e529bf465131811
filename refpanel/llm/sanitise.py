"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Patterns find the protected entities. How much a term reveals an entity of the same document is
estimated from the corpus: the information that still has to be found once the term is known, in
bits, is minus the logarithm of the share of the term's documents that hold the entity (its own
information less the pointwise mutual information of the two). A term that leaves almost nothing
open is removed from documents that hold the entity, one that leaves little is generalised. What is
left open depends on the term's own documents alone, so the verdict on a text does not change when
unrelated documents join the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refpanel.llm.common import store

#: The kinds in their order with their patterns. Possessive quantifiers where nothing
#: can be given back (same matches, no recursion); an address begins where its run of characters or
#: the text after the previous address does.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to occur at all; cheaper than the full search.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Documents without the entity that are added to those of each term: the squared normal quantile
#: (0.8416) of a one-sided 80 % interval, so that a term has to be met more than once to be sure.
PRIOR = 0.7083
#: Bits left open up to which a term is generalised or removed: the entity is in every second, or in
#: four of five, of the documents with the term. A word met once beside an entity leaves 0.77 bits.
GENERALISE_AT = 1.0
REMOVE_AT = 0.33
#: A term: a whole word of three or more letters.
TERM = r"(?<![\p{L}\p{N}])\p{L}{3,}(?![\p{L}\p{N}])"
_SPAN = "struct<kind:string,start:long,end:long,value:string>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Every second digit from the right doubled, nine taken off above nine; the sum ends in 0."""
    digits = F.reverse(_digits(m))
    value = lambda k: F.substring(digits, k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, k: acc + value(k) - F.when(value(k) > 9, 9).otherwise(0))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(m)).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _spans(text: Column, kind: str, pattern: Column, entity, valid) -> Column:
    """Valid matches of ``pattern`` with code point positions: the text between the matches tells
    where each of them starts. One pass over them, as terms can be many."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.arrays_zip(found.alias("m"), F.transform(F.split(text, pattern, -1), F.length).alias("gap"))
    first = lambda acc, x: acc["at"] + x["gap"]
    last = lambda acc, x: first(acc, x) + F.length(x["m"])
    span = lambda acc, x: F.struct(F.lit(kind).alias("kind"), first(acc, x).alias("start"), last(acc, x).alias("end"), entity(x["m"]).alias("value"))
    out = lambda acc, x: F.when(valid(x["m"]), F.concat(acc["out"], F.array(span(acc, x)))).otherwise(acc["out"])
    step = lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(F.struct(last(acc, x).alias("at"), out(acc, x).alias("out")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def entity_spans(text: Column) -> Column:
    """Array of all valid spans ``(kind, start, end, value)``, kinds in order, then by start; end
    is exclusive. Leftmost non-overlapping matches of each kind; a failing match is dropped."""
    none = F.array().cast(f"array<{_SPAN}>")
    kinds = []
    for kind, pattern in PATTERNS.items():
        entity = F.lower if kind == "email" else (lambda m: m) if kind == "ip" else _digits
        spans = _spans(text, kind, F.lit(pattern), lambda m, e=entity, k=kind: F.concat(F.lit(f"{k}:"), e(m)), lambda m, k=kind: _valid(k, m))
        kinds.append(F.coalesce(F.when(text.rlike(HINTS[kind]), spans), none))
    return F.concat(*kinds)


def locate(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Stored rows with ``_uid``, ``_spans`` and ``_text`` (null where there is no span), and the
    columns ``keep``. A null text has no spans."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*(keep or []), text.alias("_text")).withColumn("_spans", entity_spans(F.col("_text")))
    rows = rows.withColumn("_text", F.when(F.size("_spans") > 0, F.col("_text")))
    return store(rows.withColumn("_uid", F.monotonically_increasing_id()), "located")


def _replaced(marks: Column) -> Column:
    """``_text`` with the stretches of ``marks(start, end, by)`` replaced; overlapping ones become
    one replacement, that of the first."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    gap = lambda acc, m: F.substring("_text", (acc["at"] + 1).cast("int"), (m["start"] - acc["at"]).cast("int"))
    step = lambda acc, m: F.when(m["start"] < acc["at"], F.struct(F.greatest(acc["at"], m["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(m["end"].alias("at"), F.concat(acc["out"], F.array(gap(acc, m), m["by"])).alias("out")))
    return F.aggregate(F.array_sort(marks), start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring("_text", (acc["at"] + 1).cast("int"), F.length("_text"))))


def _mentions(located: DataFrame) -> DataFrame:
    """``_uid``, the document's distinct ``entities`` and its ``terms`` outside of them."""
    rest = _replaced(F.transform("_spans", lambda s: F.struct(s["start"], s["end"], F.lit(" | ").alias("by"))))
    terms = F.array_distinct(F.regexp_extract_all(F.lower(rest), F.lit(TERM), F.lit(0)))
    entities = F.array_distinct(F.transform("_spans", lambda s: s["value"]))
    return located.filter(F.size("_spans") > 0).select("_uid", entities.alias("entities"), terms.alias("terms"))


def disclosing_terms(docs: DataFrame, mentions: DataFrame, text_col: str = "text", prior: float = PRIOR, generalise_at: float = GENERALISE_AT) -> DataFrame:
    """``entity, term, left``: the bits that the term leaves open about the entity.

    Counts are of documents: all of ``docs`` for the terms, those with the entity for the pairs;
    ``prior`` documents without the entity are added to those of each term. The number of all
    documents has no part in it.
    """
    pairs = mentions.select(F.explode("entities").alias("entity"), "terms").select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both"))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(TERM), F.lit(0)))
    known = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("nt"))
    left = -F.log2(F.col("both") / (F.col("nt") + F.lit(prior)))
    return store(pairs.join(known, "term").select("entity", "term", left.alias("left")).filter(F.col("left") <= generalise_at), "disclosing")


def find(docs: DataFrame, located: DataFrame, text_col: str = "text", prior: float = PRIOR, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """``located`` with ``_terms``: spans of disclosing terms outside the entities, of kind ``term``
    with the value ``generalise`` or ``remove``."""
    mentions = store(_mentions(located), "mentions")
    terms = disclosing_terms(docs, mentions, text_col, prior, generalise_at)
    held = mentions.select("_uid", F.explode("entities").alias("entity")).join(terms, "entity")
    action = F.when(F.min("left") <= remove_at, "remove").otherwise("generalise")
    mine = held.groupBy("_uid", "term").agg(action.alias("action")).groupBy("_uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "action")))).alias("_actions"))
    with_spans = located.filter(F.size("_spans") > 0).join(store(mine, "actions"), "_uid", "left")
    action = lambda m: F.element_at("_actions", F.lower(m))
    spans = _spans(F.col("_text"), "term", F.lit(TERM), action, lambda m: action(m).isNotNull())
    free = F.filter(spans, lambda t: ~F.exists("_spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    none = F.array().cast(f"array<{_SPAN}>")
    found = with_spans.withColumn("_terms", F.coalesce(F.when(F.col("_actions").isNotNull(), free), none)).drop("_actions")
    rest = located.filter(F.size("_spans") == 0).withColumn("_terms", none)
    return found.unionByName(rest)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``n_email, n_ip, n_card, n_phone``, ``base`` and ``spans``, the spans
    of the patterns and of all as ``kind:start:end``, comma-joined."""
    found = find(docs, locate(docs, text_col, [id_col]), text_col)
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in PATTERNS]
    return found.select(id_col, *counts, shown(F.col("_spans")).alias("base"), shown(F.concat("_spans", "_terms")).alias("spans"))


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with entities replaced by their kind in brackets, disclosing terms removed or
    replaced by ``[term]``. Overlapping entities become one replacement, named after the first.
    Null texts stay null; rows and all other columns stay."""
    columns = docs.columns
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).cast("string").alias("_source"))
    found = find(docs, locate(packed, "_source", ["_row"]), text_col)
    done = _replaced(F.transform(F.concat("_spans", "_terms"), lambda s: F.struct(s["start"], s["end"], F.when(s["value"] == "remove", "").otherwise(F.concat(F.lit("["), s["kind"], F.lit("]"))).alias("by"))))
    text = F.when(F.size("_spans") > 0, done).otherwise(F.col(f"_row.`{text_col}`").cast("string"))
    return found.select(*(text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in columns))
