from refpanel.sources.families import FAMILY_SCHEMA, families_table, load_families, subset_families
from refpanel.sources.fasta import read_fasta, retag, write_fasta
from refpanel.sources.fastq import paired_samples, read_fastq
from refpanel.sources.hits import read_hits_tsv, read_tblout
from refpanel.sources.tables import derived_partition, read_domains, read_manifest, write_id_list, write_release, write_tsv

__all__ = [
    "FAMILY_SCHEMA",
    "derived_partition",
    "families_table",
    "load_families",
    "paired_samples",
    "read_domains",
    "read_fasta",
    "read_fastq",
    "read_hits_tsv",
    "read_manifest",
    "read_tblout",
    "retag",
    "subset_families",
    "write_fasta",
    "write_id_list",
    "write_release",
    "write_tsv",
]
