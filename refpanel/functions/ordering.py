"""Order keys: seeded pseudo-random order and order-preserving buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 256


def seeded_key(seed, *cols) -> Column:
    """md5 of ``seed:col:col``: a reproducible random order, independent per family and label."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c) if isinstance(c, str) else c for c in cols]))


def score_bucket(col: Column) -> Column:
    """Monotone bucket number of a score on a log scale (either sign).

    Equal scores share a bucket and a larger score never has a smaller bucket, so running
    totals may be taken per bucket and stitched together: no key needs one task.
    """
    size = F.floor(F.log2(F.abs(col) + F.lit(1.0)) * F.lit(BUCKETS_PER_OCTAVE))
    return F.when(col < 0, -size).otherwise(size).cast("int")


def hash_bucket(col: Column) -> Column:
    """Leading 12 bits of a hex digest: a monotone bucket for digest order."""
    return F.substring(col, 1, 3)
