"""Shared helpers: reading tables, storing intermediate tables, byte-wise text normalisation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from refpanel.session import _delete, checkpoint_root, discard, ship_code, shuffles_removed  # noqa: F401

#: Entries a worker's word cache may hold before it starts afresh.
CACHE_ENTRIES = 1_000_000
#: Longer words are not kept, which bounds the cache in bytes too.
CACHED_LENGTH = 64
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Lower-cases A-Z only; ``bytes.split()`` then cuts at exactly [\x20\x09-\x0D].
LOWER = bytes(_UPPER.get(c, c) for c in range(256))
#: The same, with every ASCII character that is neither digit nor letter turned into a space.
ALNUM = bytes(_UPPER.get(c, c if c >= 128 or chr(c).isalnum() else 32) for c in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, kind: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/llm-{kind}-{uuid.uuid4().hex}"


#: Tables stored within each ``scratch`` that is open.
_SCRATCH: list[list[str]] = []


def store(df: DataFrame, kind: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    An open ``scratch`` deletes the table as it ends, unless ``keep`` is set."""
    path = shared_folder(df.sparkSession, kind)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored while it holds are deleted as it ends; for work whose result is stored with
    ``keep`` by then, so that nothing reads them any more. Shuffle files go with each query."""
    _SCRATCH.append([])
    try:
        with shuffles_removed(spark):
            yield
    finally:
        for path in _SCRATCH.pop():
            _delete(spark, path)


class Cache(dict):
    """``cache[key]`` computes ``fn(key)`` and keeps it unless the key is a long text; emptied by ``trim``
    when it has grown."""

    def __init__(self, fn: Callable):
        super().__init__()
        self.fn = fn

    def __missing__(self, key):
        value = self.fn(key)
        if not isinstance(key, bytes | str) or len(key) <= CACHED_LENGTH:
            self[key] = value
        return value

    def trim(self, entries: int = CACHE_ENTRIES) -> None:
        if len(self) > entries:
            self.clear()


def hash_cache() -> Cache:
    """64-bit hashes of byte strings."""
    return Cache(xxhash.xxh64_intdigest)


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """UTF-8 bytes of one column, null as empty, without decoding to str."""
    for value in batch.column(column).cast(pa.large_binary()):
        yield value.as_py() or b""
