"""Train/test splits without leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refpanel.functions import genus_of, seeded_key
from refpanel.operators.cumulative import nth_digest
from refpanel.session import materialize

MIN_SEQUENCES = 5
TEST_FRACTION = 0.2


def _target(total, fraction: float):
    return F.greatest(F.lit(1), F.floor(total * F.lit(fraction)).cast("long"))


def split_random(seqs: DataFrame, fraction: float = TEST_FRACTION, seed=42, min_sequences: int = MIN_SEQUENCES) -> DataFrame:
    """Add ``split``; ``max(1, floor(n * fraction))`` rows per family and label are test.

    Groups with fewer than ``min_sequences`` rows are left out. The rows are never ranked:
    the digest of the last test row is found per group and compared against.
    """
    keyed = seqs.withColumn("_key", seeded_key(seed, "family", "label", "accession"))
    cut = nth_digest(
        keyed, ["family", "label"], "_key", lambda n: F.when(n >= min_sequences, _target(n, fraction)), "_cut"
    )
    return (
        keyed.join(materialize(cut), ["family", "label"])
        .withColumn("split", F.when(F.col("_key") <= F.col("_cut"), "test").otherwise("train"))
        .select(*seqs.columns, "split")
    )


def held_out_genera(seqs: DataFrame, fraction: float = TEST_FRACTION, seed=42, min_sequences: int = MIN_SEQUENCES) -> DataFrame:
    """Per family and label, each genus in seeded order with its counts and whether it is held out.

    A genus is held out while fewer than the target number of rows are, keeping one in train.
    """
    group = ["family", "label"]
    counts = seqs.withColumn("genus", genus_of("organism")).groupBy(*group, "genus").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*group).orderBy(seeded_key(seed, "family", "label", "genus"), "genus")
    whole = Window.partitionBy(*group)
    held = (F.col("_before") < _target(F.col("_total"), fraction)) & (F.col("genus_rank") <= F.col("n_genera") - 1)
    return (
        counts.withColumn("genus_rank", F.row_number().over(order))
        .withColumn("_before", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_total", F.sum("n").over(whole))
        .withColumn("n_genera", F.count(F.lit(1)).over(whole))
        .filter(F.col("_total") >= min_sequences)
        .select(*group, "genus", "n", "genus_rank", "n_genera", held.alias("held_out"))
    )


def split_by_genus(seqs: DataFrame, fraction: float = TEST_FRACTION, seed=42, min_sequences: int = MIN_SEQUENCES) -> DataFrame:
    """Add ``split`` by whole genera; a group with one genus is split at random."""
    genera = materialize(
        held_out_genera(seqs, fraction, seed, min_sequences).select("family", "label", "genus", "n_genera", "held_out")
    )
    tagged = seqs.withColumn("genus", genus_of("organism")).join(genera, ["family", "label", "genus"])
    by_genus = tagged.filter("n_genera > 1").withColumn("split", F.when(F.col("held_out"), "test").otherwise("train"))
    single = split_random(tagged.filter("n_genera = 1").select(*seqs.columns), fraction, seed, min_sequences)
    return by_genus.select(*seqs.columns, "split").unionByName(single)


def leakage_report(split: DataFrame, refs: DataFrame, benchmark_negatives: DataFrame) -> DataFrame:
    """Counts that must be 0: train rows repeated in test, references repeated in benchmark negatives.

    Compared by accession and by sequence digest, inside the family for the split.
    """
    rows = split.select("family", "split", "accession", F.md5("seq").alias("digest"))
    out = None
    for by in ("accession", "digest"):
        train = rows.filter("split = 'train'").select("family", by).distinct()
        test = rows.filter("split = 'test'").select("family", by).distinct()
        left = refs.select("accession", F.md5("seq").alias("digest")).select(by).distinct()
        right = benchmark_negatives.select("accession", F.md5("seq").alias("digest")).select(by).distinct()
        for name, a, b in ((f"train_test_{by}", train, test), (f"refs_negatives_{by}", left, right)):
            n = a.join(b, a.columns, "left_semi").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
            out = n if out is None else out.unionByName(n)
    return out
