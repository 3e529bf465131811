"""Token counts of a byte-level pair-merging tokenizer, without emitting identifiers."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import Cache

#: Fixed value: the pattern with which byte-level pair-merging vocabularies of this kind cut text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _symbols() -> dict[str, int]:
    """The printable stand-in character of every byte, as vocabulary files write it."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PairMerges:
    """Ranked merges over byte symbols; ``count`` is the number of tokens of one text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, as_byte = spec["model"], _symbols()
        vocab = model["vocab"]
        self.byte = [0] * 256
        for symbol, b in as_byte.items():
            self.byte[b] = vocab[symbol]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = rank, vocab[left + right]
        special = sorted((t["content"] for t in spec.get("added_tokens") or []), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.cache = Cache(lambda piece: self.merged(piece.encode()))

    def merged(self, piece: bytes) -> int:
        """Symbols left when no adjacent pair has a merge: pop the lowest-ranked pair, leftmost
        first, join it in a linked list, push the two pairs it forms; stale entries are skipped."""
        n = len(piece)
        if n < 2:
            return n
        merges, symbol = self.merges, [self.byte[b] for b in piece]
        prev, following = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m[0], k, symbol[k], symbol[k + 1], m[1]) for k in range(n - 1) if (m := merges.get((symbol[k], symbol[k + 1])))]
        heapq.heapify(heap)
        done = 0
        while heap:
            _, k, left, right, new = heapq.heappop(heap)
            j = following[k]
            if symbol[k] != left or j >= n or symbol[j] != right:
                continue
            done += 1
            symbol[k], symbol[j] = new, -1
            after = following[k] = following[j]
            if after < n:
                prev[after] = k
                if m := merges.get((new, symbol[after])):
                    heapq.heappush(heap, (m[0], k, new, symbol[after], m[1]))
            before = prev[k]
            if before >= 0 and (m := merges.get((symbol[before], new))):
                heapq.heappush(heap, (m[0], before, symbol[before], new, m[1]))
        return n - done

    def count(self, text: str) -> int:
        """Tokens of ``text``; a special token's string inside it is one token."""
        if not self.special:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        pieces, cache = self.pattern.findall(text), self.cache
        try:
            return sum(map(cache.__getitem__, pieces))
        finally:
            cache.trim()


@lru_cache(maxsize=2)
def load(path: str) -> PairMerges:
    return PairMerges(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``) of every row.

    ``vocabulary`` is the path of the tokenizer's .json file, the same on every worker. A null text
    counts as empty; rows stay as they are, repeated ones included; only the id goes along.
    """
    rows = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(map(merges.count, texts), pa.int64())], schema.names)

    return rows.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
