from refpanel.functions.ordering import score_bucket, seeded_key
from refpanel.functions.sequence import (
    extra_id,
    genus_of,
    header_accession,
    kmers,
    orf_to_read,
    organism_of,
    read_family,
    residues,
    revcomp,
)

__all__ = [
    "extra_id",
    "genus_of",
    "header_accession",
    "kmers",
    "orf_to_read",
    "organism_of",
    "read_family",
    "residues",
    "revcomp",
    "score_bucket",
    "seeded_key",
]
