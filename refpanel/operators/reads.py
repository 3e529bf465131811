"""Reads: tiling, source contig, k-mer location, CDS overlap, six-frame ORFs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from refpanel.functions import revcomp
from refpanel.functions.sequence import COMPLEMENT_FROM, COMPLEMENT_TO, GENETIC_CODE, chunks, windows
from refpanel.session import materialize, ship_code

FLANK = 300
KMER = 21
PROBES = 8
MIN_OVERLAP = 20
#: Letters of a contig whose tiles are cut in one row, about.
CHUNK = 65_536
#: Letters of contigs and reads that are looked up together, about.
TASK_LETTERS = 2_000_000
#: Letters of a contig for each task that shares its reads.
LONG = 2_000_000
TRUTH_COLUMNS = ["read_id", "family", "label", "accession", "overlaps_cds", "overlap_bp", "read_length"]


def cds_bounds(contigs: DataFrame, flank: int = FLANK) -> DataFrame:
    """Add ``cds_start``, ``cds_end`` (half-open) and ``usable``: false when the flanks leave nothing."""
    return (
        contigs.withColumn("cds_start", F.lit(flank))
        .withColumn("cds_end", F.length("seq") - flank)
        .withColumn("usable", F.col("cds_end") > F.col("cds_start"))
    )


def tile_reads(contigs: DataFrame, lengths: list[int], stride: int, chunk: int = CHUNK) -> DataFrame:
    """Fixed-length read pairs at every ``stride`` of every contig, with their true interval.

    Mate 1 is forward; mate 2 is the reverse complement of the same window. Ids are
    ``<contig>_<start>_<length>/<mate>``. A contig is first cut into chunks that overlap by a read,
    so a row holds the tiles of about ``chunk`` letters however long the contig is.
    """
    chunk = stride * max(1, chunk // stride)

    def of_length(n: int) -> Column:
        cut = lambda fwd, i: F.struct((F.col("_c") * chunk + i * stride).alias("start"), F.lit(n).alias("read_length"), fwd.alias("fwd"))
        # Windows of the overlap belong to the next chunk.
        return F.transform(F.slice(windows("_piece", n, stride), 1, chunk // stride), cut)

    pieces = contigs.select("contig_id", F.posexplode(chunks("seq", chunk, max(lengths) - 1)).alias("_c", "_piece"))
    tiles = F.flatten(F.array(*[of_length(n) for n in lengths]))
    rows = pieces.select("contig_id", F.explode(tiles).alias("t")).select("contig_id", "t.*")
    mates = F.explode(F.array(F.struct(F.lit(1).alias("mate"), F.col("fwd").alias("seq")), F.struct(F.lit(2).alias("mate"), revcomp("fwd").alias("seq"))))
    rows = rows.select("contig_id", "start", "read_length", mates.alias("m")).select("contig_id", "start", "read_length", "m.*")
    name = F.concat("contig_id", F.lit("_"), F.col("start").cast("string"), F.lit("_"), F.col("read_length").cast("string"), F.lit("/"), F.col("mate").cast("string"))
    return rows.select(
        name.alias("read_id"), "mate", "seq", "read_length", "contig_id", F.col("start").cast("int").alias("start"),
        (F.col("start") + F.col("read_length")).cast("int").alias("end"),
    )


def assign_contig(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Add ``contig_id``: the longest contig id the read id starts with; null when none fits.

    A prefix match becomes an equi-join: only prefixes as long as some contig id are tried, and
    contig ids have few distinct lengths (at most their longest length). Reads that begin alike, as
    far as a contig id can reach, are looked up once; a contig's reads have few such beginnings.
    """
    sizes = sorted(r[0] for r in contigs.select(F.length("contig_id")).distinct().collect() if r[0])
    reads = reads.drop("contig_id")
    if not sizes:
        return reads.withColumn("contig_id", F.lit(None).cast("string"))
    head = F.substring("read_id", 1, sizes[-1])
    prefixes = F.explode(F.array(*[F.when(F.length("_head") >= n, F.substring("_head", 1, n)) for n in sizes]))
    found = (
        reads.select(head.alias("_head")).distinct()
        .select("_head", prefixes.alias("contig_id"))
        .filter(F.col("contig_id").isNotNull())
        .join(contigs.select("contig_id").distinct(), "contig_id", "left_semi")
        .groupBy("_head")
        .agg(F.max(F.struct(F.length("contig_id").alias("n"), "contig_id")).alias("m"))
        .select("_head", F.col("m.contig_id").alias("contig_id"))
    )
    return reads.withColumn("_head", head).join(found, "_head", "left").drop("_head")


def _codes(letters: np.ndarray, kinds: int, at: np.ndarray, k: int, lead: np.ndarray) -> np.ndarray:
    """A number for ``lead`` and the ``k`` letters from each place ``at``: equal where these are, and only there.

    Before the numbers grow too large they are replaced by their ranks."""
    code, size = lead, int(lead.max(initial=0)) + 1
    for i in range(k):
        if size * kinds >= 1 << 62:
            ranks, code = np.unique(code, return_inverse=True)
            size = len(ranks)
        code = code * kinds + letters[at + i]
        size *= kinds
    return code


def _steps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the ``sizes`` each of their units belongs to, and its number there."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _places(contigs: list[str], seqs: list[str], owner: np.ndarray, k: int, probes: int) -> np.ndarray:
    """Start of each read on its contig (the ``owner``-th), -1 where it has none.

    The first probe k-mer whose last place in the contig lets the whole read fit, forward ones first."""
    texts = [*contigs, *seqs, *(s.translate(_PARTNERS)[::-1] for s in seqs)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts, points = np.cumsum(lengths) - lengths, np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    used = np.flatnonzero(np.bincount(points))
    rank = np.zeros(int(used.max(initial=0)) + 1, np.int64)
    rank[used] = np.arange(len(used))
    contig, place = _steps(np.maximum(lengths[: len(contigs)] - k + 1, 0))
    # Probes of a read: all of its letters as they are, then all of the reverse complement.
    n = lengths[len(contigs) : len(contigs) + len(seqs)]
    step = np.maximum((n - k) // probes, 1)
    count = np.where(n >= k, (n - k) // step + 1, 0)
    read, number = _steps(2 * count)
    strand, number = number // count[read], number % count[read]
    offset = number * step[read]
    at = np.concatenate([starts[contig] + place, starts[len(contigs) + strand * len(seqs) + read] + offset])
    code = _codes(rank[points], max(1, len(used)), at, k, np.concatenate([contig, owner[read]]))
    held, asked = code[: len(contig)], code[len(contig) :]
    order = np.argsort(held, kind="stable")  # places of a k-mer stay in order
    held = held[order]
    last = np.searchsorted(held, asked, "right") - 1
    out = np.full(len(seqs), -1, np.int64)
    met = np.flatnonzero(last >= 0)
    met = met[held[last[met]] == asked[met]]
    start = place[order[last[met]]] - offset[met]
    fits = (start >= 0) & (start + n[read[met]] <= lengths[owner[read[met]]])
    found, first = np.unique(read[met][fits], return_index=True)
    out[found] = start[fits][first]
    return out


_PARTNERS = str.maketrans(COMPLEMENT_FROM, COMPLEMENT_TO)


def locate_reads(reads: DataFrame, contigs: DataFrame, k: int = KMER, probes: int = PROBES) -> DataFrame:
    """``start`` and ``end`` (half-open) of each read on its own contig; reads that fit nowhere are dropped.

    Probes at 0, step, 2*step, ...; forward before reverse complement; a k-mer found more than
    once counts at its last place. Contigs and reads are dealt by contig and stream through a task,
    which sorts the k-mers of some contigs at a time and looks up their reads together, so the cost
    of a read does not depend on the length of its contig. Long contigs go to several tasks with a
    share of their reads each.
    """
    spark, rest = reads.sparkSession, [c for c in reads.columns if c not in ("contig_id", "seq")]
    whole = contigs.filter("contig_id IS NOT NULL").select("contig_id", "seq").filter(F.length("seq") >= k)
    parts = F.ceil(F.max(F.length("seq")) / LONG).cast("int").alias("_parts")
    long = materialize(whole.filter(F.length("seq") > LONG).groupBy("contig_id").agg(parts))  # stored, so that its size is known
    parts, row = F.coalesce("_parts", F.lit(1)), F.struct(*rest, F.lit(0).alias("_"))
    asked = reads.filter("contig_id IS NOT NULL").filter(F.length("seq") >= k).join(long, "contig_id", "left")
    asked = asked.select("contig_id", F.lit(1).alias("_side"), "seq", row.alias("_row"), F.pmod(F.xxhash64("seq"), parts).cast("int").alias("_part"))
    held = whole.join(long, "contig_id", "left").select(
        "contig_id", F.lit(0).alias("_side"), "seq", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
    )
    both = held.unionByName(asked).repartition("contig_id", "_part").sortWithinPartitions("contig_id", "_part", "_side")
    fields = asked.select("contig_id", "seq", "_row").schema.fields
    schema = StructType([*fields, StructField("start", IntegerType()), StructField("end", IntegerType())])

    def located(batches):
        key, texts = None, []  # the contig that reads now come from; of several with one id each counts
        for batch in batches:
            ids, sides, parts, seqs = (c.to_pylist() for c in batch.columns[:4])
            contigs, owner, rows, letters, mine = [], [], [], 0, range(0)

            def found():
                start = _places(contigs, [seqs[i] for i in rows], np.array(owner), k, probes)  # noqa: B023
                hit = np.flatnonzero(start >= 0)
                kept = batch.take(pa.array(np.array(rows)[hit]))  # noqa: B023
                end = start[hit] + [len(seqs[rows[i]]) for i in hit]  # noqa: B023
                columns = [kept.column(0), kept.column(3), kept.column(4), pa.array(start[hit], pa.int32()), pa.array(end.astype(np.int64), pa.int32())]
                return pa.RecordBatch.from_arrays(columns, ["contig_id", "seq", "_row", "start", "end"])

            for i, (name, side, part, seq) in enumerate(zip(ids, sides, parts, seqs)):
                if side == 0:
                    if (name, part) != key:
                        key, texts = (name, part), []
                    texts.append(seq)
                    mine = range(0)
                elif (name, part) == key:
                    if not mine:
                        mine = range(len(contigs), len(contigs) + len(texts))
                        contigs += texts
                        letters += sum(map(len, texts))
                    for m in mine:
                        owner.append(m)
                        rows.append(i)
                        letters += 2 * len(seq)
                    if letters > TASK_LETTERS:
                        yield found()
                        contigs, owner, rows, letters, mine = [], [], [], 0, range(0)
            if rows:
                yield found()

    ship_code(spark)
    placed = both.select("contig_id", "_side", "_part", "seq", "_row").mapInArrow(located, schema)
    return placed.select("contig_id", *(F.col("seq") if c == "seq" else F.col(f"_row.{c}") for c in reads.columns if c != "contig_id"), "start", "end")


def overlap_length(start, end, other_start, other_end) -> Column:
    """Shared length of two half-open intervals, 0 when apart."""
    return F.greatest(F.lit(0), F.least(end, other_end) - F.greatest(start, other_start))


def cds_overlap(located: DataFrame, bounds: DataFrame, min_bp: int = MIN_OVERLAP, names: list[str] | None = None) -> DataFrame:
    """Add ``overlap_bp`` and ``overlaps_cds`` (0/1) against the CDS of the read's contig, and its ``names``."""
    cds = bounds.filter("usable").select("contig_id", "cds_start", "cds_end", *(names or []))
    bp = overlap_length(F.col("start"), F.col("end"), F.col("cds_start"), F.col("cds_end"))
    return located.join(cds, "contig_id").withColumn("overlap_bp", bp).withColumn("overlaps_cds", (F.col("overlap_bp") >= min_bp).cast("int"))


def read_truth(reads: DataFrame, contigs: DataFrame, flank: int = FLANK, k: int = KMER, probes: int = PROBES, min_bp: int = MIN_OVERLAP) -> DataFrame:
    """Truth per read from its contig: family, label, accession and CDS overlap.

    ``contigs(contig_id, family, label, accession, seq)``; ``reads`` may lack ``contig_id``.
    """
    if "contig_id" not in reads.columns:
        reads = assign_contig(reads, contigs)
    located = locate_reads(reads.select("read_id", "contig_id", "seq"), contigs, k, probes)
    located = located.select("read_id", "contig_id", "start", "end", F.length("seq").alias("read_length"))
    return cds_overlap(located, cds_bounds(contigs, flank), min_bp, ["family", "label", "accession"]).select(*TRUTH_COLUMNS)


def with_background(truth: DataFrame, background: DataFrame) -> DataFrame:
    """Truth plus background reads, which belong to no family and overlap nothing."""
    rows = background.select(
        "read_id", F.lit("background").alias("family"), F.lit("negative").alias("label"), F.lit("").alias("accession"),
        F.lit(0).alias("overlaps_cds"), F.lit(0).alias("overlap_bp"), F.length("seq").alias("read_length"),
    )
    return truth.select(*TRUTH_COLUMNS).unionByName(rows)


def _codons() -> np.ndarray:
    """Residue of each codon by its three letters' codes (0-3 for T, C, A, G, 4 for others), as a flat table."""
    table = np.full(125, ord("X"), np.uint8)
    for n, residue in enumerate(GENETIC_CODE):
        table[25 * (n // 16) + 5 * (n // 4 % 4) + n % 4] = ord(residue)
    return table


_LETTERS = np.full(256, 4, np.uint8)
for _n, _pair in enumerate(("Tt", "Cc", "Aa", "Gg")):
    _LETTERS[[ord(x) for x in _pair]] = _n
_CODONS, _PAIRED = _codons(), np.array([2, 3, 0, 1, 4], np.uint8)  # T-A, C-G
_ORFS = "orf_id string, read_id string, frame int, start int, aa string"


def _orfs_of(names: list, seqs: list, min_aa: int) -> tuple[list, ...]:
    """ORF columns of some reads, which are translated together: one array operation for each frame of all."""
    out = ([], [], [], [], [])
    texts = [s.encode("ascii", "replace") for s in seqs]  # a letter of any kind is one byte
    lengths = np.array([len(x) for x in texts])
    ends = np.cumsum(lengths)
    for back in (0, 3):
        codes = _LETTERS[np.frombuffer(b"".join(x[::-1] for x in texts) if back else b"".join(texts), np.uint8)]
        codes = (_PAIRED[codes] if back else codes).astype(np.intp)
        for shift in (1, 2, 3):
            size = np.maximum(lengths - shift + 1, 0) // 3
            first = np.cumsum(size + 1) - size - 1  # a stop after each read
            place = np.arange(int((size + 1).sum())) - np.repeat(first, size + 1)
            real = place < np.repeat(size, size + 1)
            at = (np.repeat(ends - lengths + shift - 1, size + 1) + 3 * place)[real]
            residues = np.full(len(place), ord("*"), np.uint8)
            residues[real] = _CODONS[25 * codes[at] + 5 * codes[at + 1] + codes[at + 2]]
            stops = np.flatnonzero(residues == ord("*"))
            starts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else stops
            long = stops - starts >= min_aa
            starts, stops = starts[long], stops[long]
            read = np.searchsorted(first, starts, "right") - 1
            number = np.arange(len(read)) - np.searchsorted(read, read) + 1
            text, frame = residues.tobytes().decode("ascii"), shift + back
            for r, n, a, b, s in zip(read.tolist(), number.tolist(), starts.tolist(), stops.tolist(), (shift + 3 * (starts - first[read])).tolist()):
                for column, value in zip(out, ("_".join(str(x) for x in (names[r], s, frame, n) if x is not None), names[r], frame, s, text[a:b])):
                    column.append(value)
    return out


def translate_orfs(reads: DataFrame, min_aa: int = 32) -> DataFrame:
    """Stop-free stretches of at least ``min_aa`` residues in all six frames.

    Frames 1-3 are forward, 4-6 on the reverse complement. Ids are
    ``<read>_<start>_<frame>_<n>``: 1-based start on the read (on its reverse complement for
    frames 4-6) and the running number of the ORF inside its frame.
    """
    def translated(batches):
        for batch in batches:
            names, seqs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, end in _spans(seqs):
                columns = _orfs_of(names[at:end], seqs[at:end], min_aa)
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, types)], ["orf_id", "read_id", "frame", "start", "aa"])

    ship_code(reads.sparkSession)
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
    return reads.filter("seq IS NOT NULL").select(F.col("read_id").cast("string"), "seq").mapInArrow(translated, _ORFS)


def _spans(seqs: list) -> list[tuple[int, int]]:
    """Runs of reads of about ``CHUNK`` letters at most, or one read."""
    cuts, letters = [0], 0
    for i, s in enumerate(seqs):
        if i > cuts[-1] and letters + len(s) > CHUNK:
            cuts.append(i)
            letters = 0
        letters += len(s)
    return list(zip(cuts, [*cuts[1:], len(seqs)])) if seqs else []
