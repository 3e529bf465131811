import gzip

import pytest

from refpanel import sources
from refpanel.operators.select import check_unique_models


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_fasta_scan_and_sink(spark, tmp_path):
    (tmp_path / "a.positive.faa").write_text(">x|1|G_s some\nACDE\nFG\n\n>y\n>z|2|H\nAC D\n")
    got = sources.read_fasta(spark, str(tmp_path))
    assert rows(got, "header", "seq") == [("x|1|G_s some", "ACDEFG"), ("y", ""), ("z|2|H", "ACD")]
    assert sources.read_fasta(spark, str(tmp_path / "none")).count() == 0
    long = spark.createDataFrame([("h", "A" * 120), ("k", "C" * 61), ("m", "")], "header string, seq string")
    out = str(tmp_path / "out")
    sources.write_fasta(long, out)
    assert rows(sources.read_fasta(spark, out), "header", "seq") == [("h", "A" * 120), ("k", "C" * 61), ("m", "")]
    assert max(len(r.value) for r in spark.read.text(out).collect()) == 60


def test_retag_fallbacks(spark):
    heads = ["sp|P1|N x OS=Bacillus subtilis OX=1 GN=a", "tr|P2|N OS=Vibrio sp", "plain id"]
    got = sources.retag(spark.createDataFrame([(h,) for h in heads], "header string"), "fam")
    assert [r.tagged for r in got.collect()] == ["fam|P1|Bacillus_subtilis", "fam|P2|Vibrio", "fam|plain id|unknown"]


def test_fastq_scan_with_awkward_quality_and_pairs(spark, tmp_path):
    text = "@r1/1 c\nACGT\n+\n+III\n@r2/1\nAC\n+r2/1\n@+\n@r3/1\nA\n+\n@\n"
    (tmp_path / "s_R1.fastq").write_text(text)
    with gzip.open(tmp_path / "s_R2.fastq.gz", "wt") as out:
        out.write(text.replace("/1", "/2"))
    (tmp_path / "alone_R1.fastq").write_text("@q/1\nACG\n+\nIII")
    got = sources.read_fastq(spark, str(tmp_path))
    assert rows(got, "sample", "mate", "read_id", "seq") == [
        ("alone", 1, "q/1", "ACG"),
        ("s", 1, "r1/1", "ACGT"), ("s", 1, "r2/1", "AC"), ("s", 1, "r3/1", "A"),
        ("s", 2, "r1/2", "ACGT"), ("s", 2, "r2/2", "AC"), ("s", 2, "r3/2", "A"),
    ]
    assert {r.sample for r in sources.paired_samples(got).collect()} == {"s"}


def test_hit_tables(spark, tmp_path):
    (tmp_path / "s1.blastx.tsv").write_text("r1\tfam|P1|o\t80.5\t90\t10\t50\t1e-9\t101.5\nr2\tg_decoy|P2\t70\n")
    (tmp_path / "s2.blastx.tsv").write_text("")
    got = {r.read_id: r for r in sources.read_hits_tsv(spark, str(tmp_path)).collect()}
    assert got["r1"].family == "fam" and got["r1"].sample == "s1" and got["r1"].bitscore == 101.5
    assert got["r2"].family == "g_decoy" and got["r2"].bitscore is None
    tbl = tmp_path / "t"
    tbl.mkdir()
    (tbl / "s.hmmscan.tblout").write_text("# c\n\nfam - r/1_1_2_3 - 1e-3 55.2 0\nfam - odd - 1e-3 5 0\n")
    assert rows(sources.read_tblout(spark, str(tbl)), "sample", "read_id", "family", "bitscore") == [("s", "odd", "fam", 5.0), ("s", "r/1", "fam", 55.2)]


def test_families_config(spark, tmp_path):
    path = tmp_path / "f.yaml"
    path.write_text("families:\n  - name: b\n    pos_genes: [b1]\n    trim_gt: 1\n    curated_model: PF1\n  - name: a\n    decoy_from_negatives: true\n    curated_model: PF1\n")
    got = sources.load_families(spark, str(path))
    assert rows(got, "family", "ord", "decoy_from_negatives") == [("a", 1, True), ("b", 0, False)]
    assert sources.subset_families(got, ["a"]).count() == 1
    with pytest.raises(ValueError, match="zz"):
        sources.subset_families(got, ["a", "zz"])
    with pytest.raises(ValueError, match="PF1: a,b"):
        check_unique_models(got)


def test_fastq_keeps_empty_reads(spark, tmp_path):
    text = "@e0\n\n+\n\n@r1\nAC\n+\n@I\n@e1 x\n\n+\n\n@e2\n\n+\n\n@r2\nG\n+\n@\n"
    (tmp_path / "z_R1.fastq").write_text(text)
    got = sources.read_fastq(spark, str(tmp_path))
    assert rows(got, "read_id", "seq", "read_length") == [("e0", "", 0), ("e1", "", 0), ("e2", "", 0), ("r1", "AC", 2), ("r2", "G", 1)]


def test_hit_files_are_in_percent(spark, tmp_path):
    (tmp_path / "s.blastx.tsv").write_text("r1\tfam|p\t87.5\t50\t25\t40\t1e-9\t77\nr2\tfam|p\t90\n")
    got = {r.read_id: (r.pident, r.qcov, r.scov, r.bitscore) for r in sources.read_hits_tsv(spark, str(tmp_path)).collect()}
    assert got == {"r1": (0.875, 0.5, 0.25, 77.0), "r2": (0.9, None, None, None)}
