"""Column functions over headers, read ids and sequences. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complement of each nucleotide, both cases.
COMPLEMENT_FROM = "ACGTNacgtn"
COMPLEMENT_TO = "TGCANtgcan"
# The standard genetic code, codons in T, C, A, G order; * is a stop.
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def genus_of(organism) -> Column:
    """Organism name up to the first underscore; blank or missing gives ``unknown``."""
    organism = _col(organism)
    return F.when(F.coalesce(organism, F.lit("")) == "", F.lit("unknown")).otherwise(
        F.split_part(organism, F.lit("_"), F.lit(1))
    )


def header_accession(header) -> Column:
    """Second ``|`` field of a header, or the whole header when there is none."""
    header = _col(header)
    fields = F.split(header, "\\|")
    return F.when(F.size(fields) >= 2, fields[1]).otherwise(header)


def organism_of(header) -> Column:
    """Organism between ``OS=`` and ``OX=`` with ``_`` for spaces; else the word after ``OS=``; else ``unknown``."""
    header = _col(header)
    between = F.trim(F.regexp_extract(header, "OS=(.*?)OX=", 1))
    word = F.regexp_extract(header, "OS=\\s*(\\S+)", 1)
    return (
        F.when((F.instr(header, "OS=") > 0) & (F.instr(header, "OX=") > 0), F.replace(between, F.lit(" "), F.lit("_")))
        .when(F.instr(header, "OS=") > 0, word)
        .otherwise(F.lit("unknown"))
    )


def read_family(subject) -> Column:
    """Family of a subject id: the text before its first ``|``."""
    return F.split_part(_col(subject), F.lit("|"), F.lit(1))


def extra_id(header) -> Column:
    """Locus id after ``__`` in a study header, or the header's first word."""
    header = _col(header)
    # Fixed value: how study headers write a locus.
    locus = F.regexp_extract(header, "__([A-Za-z0-9]+_[0-9]+)", 1)
    return F.when(locus != "", locus).otherwise(F.regexp_extract(header, "(\\S+)", 1))


def orf_to_read(orf_id) -> Column:
    """Read id of an ORF id: drop the three numbers that follow the mate marker."""
    # Fixed value: start, frame and number after the mate marker.
    return F.regexp_replace(_col(orf_id), "^(.*/[12])_\\d+_\\d+_\\d+$", "$1")


def revcomp(seq) -> Column:
    """Reverse complement."""
    return F.reverse(F.translate(_col(seq), COMPLEMENT_FROM, COMPLEMENT_TO))


def residues(seq) -> Column:
    """Sequence as an array of single characters."""
    return F.when(F.length(_col(seq)) > 0, F.split(_col(seq), "")).otherwise(F.array().cast("array<string>"))


def kmers(seq, k: int) -> Column:
    """Every k-mer of ``seq`` in order, as an array.

    One regular-expression pass, so the cost is linear in the length; ``substring`` at each
    offset would rescan the UTF-8 string from its start every time.
    """
    return F.regexp_extract_all(_col(seq), F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))


def windows(seq, length: int, stride: int) -> Column:
    """Substrings of ``length`` starting at 0, stride, 2*stride, ..., in one linear pass."""
    return F.regexp_extract_all(_col(seq), F.lit(f"(?s)(?=(.{{{length}}})).{{1,{stride}}}"), F.lit(1))


def chunks(seq, length: int, overlap: int) -> Column:
    """Pieces that start at 0, length, 2*length, ... and run ``overlap`` letters into the next one.

    Together they are little longer than ``seq``, so exploding them first and cutting k-mers or
    windows from each keeps rows bounded where one array of all of them would not be.
    """
    return F.regexp_extract_all(_col(seq), F.lit(f"(?s)(?=(.{{1,{length + overlap}}})).{{1,{length}}}"), F.lit(1))


def translate_frame(dna, frame: int) -> Column:
    """Protein of one forward frame (1, 2 or 3); codons with other letters give ``X``.

    Letters become digits once per sequence, so a codon read as a number is its place in a table.
    """
    digits = F.translate(F.regexp_replace(F.upper(_col(dna)), "[^ACGT]", "N"), "TCAGN", "01234")
    codons = F.regexp_extract_all(F.substring(digits, frame, 2147483647), F.lit("..."), F.lit(0))
    by_number = F.array(*[F.lit(_amino(n // 100, n // 10 % 10, n % 10)) for n in range(445)])
    return F.array_join(F.transform(codons, lambda c: F.get(by_number, c.cast("int"))), "")


def _amino(a: int, b: int, c: int) -> str:
    return "X" if max(a, b, c) > 3 else GENETIC_CODE[16 * a + 4 * b + c]
