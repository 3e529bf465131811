"""Similarity search between sequence tables by shared k-mers and ungapped diagonals.

A hit is a pair that shares a k-mer and whose best diagonal scores higher than chance allows: its
E-value, the number of such scores expected in references of that total length, is at most a given
one. The least score that this asks for is known for each query before anything is aligned, and a
seeded span shorter than that cannot reach it, so chance pairs are dropped without their letters.
So is a pair whose span cannot reach what the seeds of another hit of the same query are sure to score.
With ``containment`` a hit also shares that percentage of the query's distinct k-mers. Such a pair
shares one of the query's ``n - need + 1`` rarest k-mers (the prefix-filter principle of set-similarity
joins), so only those are looked up. Identical sequences are searched once and share the result.

A few queries are looked up by an equi-join on k-mers; many of them are compared block by block
(``blocks``), since a row for every k-mer that two sequences share grows with the square of the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refpanel.functions import kmers, residues
from refpanel.functions.sequence import chunks
from refpanel.operators.blocks import block_hits, least_span
from refpanel.session import materialize, shuffles_removed

# Published Karlin-Altschul constants for match +1, mismatch -2.
MATCH, MISMATCH, LAMBDA, KAPPA = 1, -2, 1.33, 0.621
#: Letters whose k-mers are cut in one row.
CHUNK = 65_536
#: Letters whose k-mers are grouped in one task.
TASK_LETTERS = 1_000_000
#: K-mers of queries that are sent to all tasks, so that references keep only those; beyond, blocks are compared.
BROADCAST_KMERS = 1_000_000
#: Hits expected by chance, at most, unless a search says otherwise.
MAX_EVALUE = 0.001


def needed(n, containment: int) -> Column:
    """Shared k-mers a pair needs: ``ceil(n * containment / 100)``, at least 1, in integers."""
    n = F.col(n) if isinstance(n, str) else n
    return F.greatest(F.lit(1), F.floor((n * containment + 99) / 100).cast("int"))


def bitscore(matches: Column, mismatches: Column) -> Column:
    raw = matches * MATCH + mismatches * MISMATCH
    return (raw * LAMBDA - math.log(KAPPA)) / math.log(2.0)


def evalue(bits: Column, query_length: Column, total_length: Column) -> Column:
    """Hits of ``bits`` or more expected by chance between a query and references of that length."""
    return query_length * total_length * F.pow(F.lit(2.0), -bits)


def least_score(query_length: Column, total_length: Column, max_evalue: float) -> Column:
    """Raw score that an E-value of ``max_evalue`` takes; a little less, so that rounding loses nothing."""
    return (F.log(query_length * total_length * KAPPA) - math.log(max_evalue)) / LAMBDA - 1e-6


def distinct_sequences(seqs: DataFrame, group: list[str], k: int | None) -> tuple[DataFrame, DataFrame]:
    """One row per distinct sequence of a group, and the accession -> representative map.

    The representative of identical sequences is the lowest accession. The distinct sequences
    feed several joins, so they are materialised, with their number of distinct k-mers unless ``k`` is None.
    """
    keyed = seqs.withColumn("_digest", F.md5("seq"))
    one = keyed.groupBy(*group, "_digest").agg(F.min("accession").alias("id"), F.first("seq").alias("seq"))
    one = materialize(one if k is None else one.withColumn("n_kmers", F.size(F.array_distinct(kmers("seq", k)))))
    members = keyed.select(*group, "accession", "_digest").join(
        one.select(*group, "_digest", "id"), [*group, "_digest"]
    )
    return one.drop("_digest"), members.drop("_digest")


def kmer_codes(seqs: DataFrame, group: list[str], k: int) -> DataFrame:
    """``(group, id, n_kmers, code)``: a 64-bit code of each distinct k-mer, without a shuffle.

    The code covers the group too, so counting and joining need this one number as their key.
    Codes only propose pairs: two k-mers with one code can add a candidate but never lose one,
    and candidates are verified on the k-mers themselves.
    """
    each = seqs.select(*group, "id", "n_kmers", F.explode(F.array_distinct(kmers("seq", k))).alias("_kmer"))
    return each.select(*group, "id", "n_kmers", F.xxhash64(*group, "_kmer").alias("code"))


def kmer_rows(seqs: DataFrame, keys: list[str], k: int, chunk: int = CHUNK) -> DataFrame:
    """``(keys, pos, kmer)`` of every k-mer of ``seq``, in rows bounded by ``chunk`` however long it is."""
    pieces = seqs.select(*keys, F.posexplode(chunks("seq", chunk, k - 1)).alias("_c", "_piece"))
    each = pieces.select(*keys, "_c", F.posexplode(kmers("_piece", k)).alias("_p", "kmer"))
    return each.select(*keys, (F.col("_c") * chunk + F.col("_p")).alias("pos"), "kmer")


def by_sequence(seqs: DataFrame, keys: list[str]) -> DataFrame:
    """``seqs`` dealt by ``keys`` to as many tasks as its letters need: its texts move once, and what
    is then grouped by ``keys`` and k-mer stays where it is."""
    letters = seqs.agg(F.sum(F.length("seq"))).first()[0] or 0
    least = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return seqs.select(*keys, "seq").repartition(max(least, -(-letters // TASK_LETTERS)), *keys)


def seed_index(seqs: DataFrame, k: int) -> DataFrame:
    """Seed index ``(kmer, family, accession, pos)`` of references, first position of each k-mer."""
    hits = kmer_rows(by_sequence(seqs, ["family", "accession"]), ["family", "accession"], k)
    return hits.groupBy("kmer", "family", "accession").agg(F.min("pos").alias("pos"))


def rare_probes(shared: DataFrame, group: list[str], need: Column) -> DataFrame:
    """The k-mers of each query that must be looked up.

    ``shared(group, id, n_kmers, code, df)`` holds the query k-mers that some reference has.
    Of ``p`` such k-mers a hit shares at least ``need`` (a column), so it shares one of any
    ``p - need + 1``; the rarest are taken. K-mers no reference has never enter the sort.
    """
    mine = Window.partitionBy(*group, "id")
    return (
        shared.withColumn("_p", F.count(F.lit(1)).over(mine))
        .withColumn("_rank", F.row_number().over(mine.orderBy("df", "code")))
        .filter(F.col("_rank") <= F.col("_p") - need + 1)
        .select(*group, "id", "code")
    )


def contenders(rows: DataFrame, target: list, k: int) -> DataFrame:
    """The rows of ``rows(q_id, r_id, seeds, span)`` that can be the best hit of their ``target``.

    ``n`` seeds of one diagonal cover at least ``n + k - 1`` equal letters, so a row scores no less
    than if all other letters of its span differed, and no more than if all agreed. A row that
    at its best stays below another one's least loses to it, whatever its letters are.
    """
    covered = F.least(F.col("seeds") + k - 1, F.col("span"))
    sure = covered * MATCH + (F.col("span") - covered) * MISMATCH
    keyed = rows.select("*", *(c.alias(f"_t{i}") for i, c in enumerate(target)))
    names = [f"_t{i}" for i in range(len(target))]
    floors = keyed.groupBy(*names).agg(F.max(sure).alias("_sure"))
    return keyed.join(floors, names).filter(F.col("span") * MATCH >= F.col("_sure")).drop(*names, "_sure")


def align_pairs(
    pairs: DataFrame | None,
    queries: DataFrame,
    refs: DataFrame,
    group: list[str],
    k: int,
    max_evalue: float | None,
    target: list,
    containment: int | None = None,
    ref_seeds: DataFrame | None = None,
) -> DataFrame:
    """Best diagonal and identity of given pairs ``(group, q_id, r_id)``, or of all that share a k-mer.

    Seeds are first positions of shared k-mers; the diagonal (query minus reference position)
    with most seeds wins, the lowest on a tie. Residues are then compared along the seeded span
    and along the whole overlap of that diagonal. ``refs`` has ``total``, the length of all
    references that a query of its group meets. Of the rows with one ``target`` (columns) those
    that cannot be its best hit are left out. ``ref_seeds(group, r_id, kmer, r_pos)`` are the
    references' seeds where an index holds them.
    """

    def seeds(seqs: DataFrame, side: str, asked: DataFrame | None = None) -> DataFrame:
        if pairs is not None:
            used = pairs.select(*group, F.col(f"{side}_id").alias("id")).distinct()
            seqs = seqs.join(used, [*group, "id"], "left_semi")
        pos = kmer_rows(seqs, [*group, "id"], k)
        if asked is not None:
            pos = pos.join(asked, [*group, "kmer"], "left_semi")
        return pos.groupBy(*group, "id", "kmer").agg(F.min("pos").alias(f"{side}_pos")).withColumnRenamed("id", f"{side}_id")

    if ref_seeds is not None:
        shared = seeds(queries, "q").join(ref_seeds, [*group, "kmer"])
    elif pairs is None:
        probes = materialize(seeds(queries, "q"))
        # K-mers that no query has stay where they are: only a few queries' k-mers are worth sending around.
        asked = F.broadcast(probes.select(*group, "kmer").distinct()) if probes.count() <= BROADCAST_KMERS else None
        shared = probes.join(seeds(refs, "r", asked), [*group, "kmer"])
    else:
        shared = pairs.join(seeds(queries, "q"), [*group, "q_id"]).join(seeds(refs, "r"), [*group, "r_id", "kmer"])
    per_diagonal = (
        shared.groupBy(*group, "q_id", "r_id", (F.col("q_pos") - F.col("r_pos")).alias("diag"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("q_pos").alias("_lo"), F.max("q_pos").alias("_hi"))
    )
    best = per_diagonal.groupBy(*group, "q_id", "r_id").agg(
        F.sum("_n").alias("shared"), F.min(F.struct((-F.col("_n")).alias("neg"), "diag", "_lo", "_hi")).alias("b")
    )
    rows = (
        best.select(*group, "q_id", "r_id", "shared", (-F.col("b.neg")).alias("seeds"), F.col("b.diag").alias("diag"), F.col("b._lo").alias("_lo"), F.col("b._hi").alias("_hi"))
        .join(queries.select(*group, F.col("id").alias("q_id"), F.length("seq").alias("q_len"), "n_kmers"), [*group, "q_id"])
        .join(refs.select(*group, F.col("id").alias("r_id"), F.length("seq").alias("r_len"), "total"), [*group, "r_id"])
    )
    rows = rows.withColumn("span", F.col("_hi") - F.col("_lo") + k)
    if max_evalue is not None:
        rows = rows.filter(F.col("span") * MATCH >= least_score(F.col("q_len"), F.col("total"), max_evalue))
    if containment is not None:
        rows = rows.filter(F.col("shared") >= needed("n_kmers", containment))
    # Only what can be the best significant hit meets its letters; stored, so that the plan knows how little that is.
    rows = (
        materialize(contenders(materialize(rows), target, k))
        .join(queries.select(*group, F.col("id").alias("q_id"), F.col("seq").alias("_q")), [*group, "q_id"])
        .join(refs.select(*group, F.col("id").alias("r_id"), F.col("seq").alias("_r")), [*group, "r_id"])
    )
    start = F.greatest(F.lit(0), F.col("diag"))
    length = F.least(F.col("q_len"), F.col("r_len") + F.col("diag")) - start
    same = F.zip_with(
        F.slice(residues("_q"), start + 1, length), F.slice(residues("_r"), start - F.col("diag") + 1, length), lambda a, b: a == b
    )
    rows = rows.withColumn("_same", same).withColumn("_start", start)
    hits = lambda flags: F.size(F.filter(flags, lambda x: x))
    counted = (
        rows.withColumn("matches", hits(F.slice("_same", F.col("_lo") - F.col("_start") + 1, F.col("span"))))
        .withColumn("overlap_matches", hits(F.col("_same")))
        .select(*group, "q_id", "r_id", "n_kmers", "shared", "seeds", "diag", F.col("_lo").alias("q_start"), "span", "matches", "overlap_matches", "q_len", "r_len", "total")
    )
    return _rated(counted, max_evalue)


def _rated(counted: DataFrame, max_evalue: float | None) -> DataFrame:
    """Adds identity, coverages, bitscore and E-value to counts of hits; keeps the significant ones."""
    aligned = (
        counted.withColumn("pident", F.col("matches") * 100.0 / F.col("span"))
        .withColumn("qcov", F.col("span") / F.col("q_len"))
        .withColumn("scov", F.col("span") / F.col("r_len"))
        .withColumn("identity", F.col("overlap_matches") / F.least("q_len", "r_len"))
        .withColumn("bitscore", bitscore(F.col("matches"), F.col("span") - F.col("matches")))
        .withColumn("evalue", evalue(F.col("bitscore"), F.col("q_len"), F.col("total")))
    )
    return aligned if max_evalue is None else aligned.filter(F.col("evalue") <= max_evalue)


def candidate_pairs(q: DataFrame, r: DataFrame, group: list[str], k: int, containment: int) -> DataFrame:
    """Distinct ``(group, q_id, r_id)`` that may share enough k-mers; complete, not yet exact."""
    asked = kmer_codes(q, group, k)
    # References keep only k-mers that are asked for. That small rest is used twice, so it is written.
    held = materialize(
        kmer_codes(r, group, k).drop("n_kmers").join(asked.select("code"), "code", "left_semi")
    )
    counts = held.groupBy("code").agg(F.count(F.lit(1)).alias("df"))
    probes = rare_probes(asked.join(counts, "code"), group, needed("n_kmers", containment))
    return (
        probes.withColumnRenamed("id", "q_id")
        .join(held.withColumnRenamed("id", "r_id"), [*group, "code"])
        .select(*group, "q_id", "r_id")
        .distinct()
    )


def similarity_join(
    queries: DataFrame,
    refs: DataFrame,
    k: int = 5,
    max_evalue: float | None = MAX_EVALUE,
    containment: int | None = None,
    same_family: bool = True,
) -> DataFrame:
    """Best significant reference of each query, with identity, coverages, bitscore and E-value.

    ``queries(family, accession, seq)``, ``refs(family, accession, seq)``. With ``same_family``
    a query meets references of its own family and gets its best one; otherwise it meets all
    and gets the best of each reference family. Ties go to the lowest accession. The result has
    at most one row per query and reference family, whatever the number of copies.

    ``max_evalue`` is the number of hits of a hit's score expected by chance among the distinct
    references the query meets; None keeps every pair that shares a k-mer. An explicit
    ``containment`` makes that percentage of the query's k-mers a further condition.
    """
    held = None if containment is None else k  # k-mers are counted for containment only
    group = ["family"] if same_family else []
    with shuffles_removed(queries.sparkSession):
        q, members = distinct_sequences(queries.select(*group, "accession", "seq"), group, held)
        r, _ = distinct_sequences(refs.select("family", "accession", "seq"), ["family"], held)
    if same_family:
        totals = materialize(r.groupBy("family").agg(F.sum(F.length("seq")).alias("total")))
    else:
        totals = r.agg(F.sum(F.length("seq")).alias("total")).first()["total"] or 0
    if containment is None and (q.agg(F.sum(F.greatest(F.lit(0), F.length("seq") - k + 1))).first()[0] or 0) > BROADCAST_KMERS:
        def top(hits: DataFrame) -> DataFrame:
            hits = hits.withColumn("family", F.col("q_family" if same_family else "r_family")).withColumnRenamed("r_id", "subject_id")
            return _best(_rated(hits.drop("q_family", "r_family"), max_evalue))

        return best_hits(block_hits(q, r, totals, k, least_span(max_evalue, LAMBDA, KAPPA), top), members, group)
    if containment is None:
        q = q.withColumn("n_kmers", F.size(F.array_distinct(kmers("seq", k))))
    if same_family:
        r = r.join(totals, "family")
    else:
        r = r.withColumn("id", F.struct("family", "id")).drop("family").withColumn("total", F.lit(totals).cast("long"))
    target = [F.col("q_id"), *([F.col("family")] if same_family else [F.col("r_id.family")])]
    pairs = None if containment is None else materialize(candidate_pairs(q, r, group, k, containment))
    hits = align_pairs(pairs, q, r, group, k, max_evalue, target, containment)
    if same_family:
        hits = hits.withColumnRenamed("r_id", "subject_id")
    else:
        hits = hits.select("*", F.col("r_id.family").alias("family"), F.col("r_id.id").alias("subject_id")).drop("r_id")
    return best_hits(hits, members, group)


def _best(hits: DataFrame) -> DataFrame:
    """The best of ``hits(family, q_id, subject_id, ...)`` for every query and family."""
    payload = ["shared", "seeds", "diag", "q_start", "span", "matches", "q_len", "r_len", "pident", "qcov", "scov", "identity", "evalue"]
    best = hits.groupBy("family", "q_id").agg(F.min(F.struct((-F.col("bitscore")).alias("neg"), "subject_id", *payload)).alias("b"))
    return best.select("family", "q_id", "b.*").withColumn("bitscore", -F.col("neg")).drop("neg")


def best_hits(hits: DataFrame, members: DataFrame, group: list[str]) -> DataFrame:
    """The best of ``hits(family, q_id, subject_id, ...)`` for every member that ``q_id`` stands for."""
    return members.withColumnRenamed("id", "q_id").join(_best(hits), [*group, "q_id"]).drop("q_id")
