"""Encoding and decoding with a merge-type piece vocabulary by a table over text prefixes.

Every prefix of a text has one last token. A prefix's last token is found among the vocabulary
entries that end there (automaton matches): it is the one that stands, unmerged, next to the last
token of the prefix before it. Reading the table backwards yields the ids.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import Cache

#: What a space is written as in the vocabulary (fixed value).
SPACE = "▁"
#: Longer parts of a text are encoded each time instead of kept.
KEPT_CHARS = 64
#: Parts kept at a time.
KEPT_PARTS = 500_000


class Pieces:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)  # only to read the entries
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_value = {i: int(p[3:5], 16) for i, p in enumerate(self.text) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_value.items()}
        self.control = {i for i in range(len(self.text)) if model.is_control(i)}
        self.other = self.control | set(self.byte_value)
        special = self.other | {self.unknown}
        self.id = {p: i for i, p in enumerate(self.text) if i not in special}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.id)
        # Merges never cross from a letter to a space if no entry holds such a pair.
        self.part = re.compile(".+" if inner else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", re.S)
        self.pair = Cache(self._compatible)
        self.size = [len(p) for p in self.text]
        self.automaton = ahocorasick.Automaton()
        self.rank = dict.fromkeys(self.id.values(), float("-inf"))  # when merging forms an entry
        self.halves: dict[int, tuple[int, int]] = {}
        for p, i in self.id.items():
            steps = self._merge(p)
            if steps[-1] == [p]:  # entries that merging can reach
                self.automaton.add_word(p, (len(p), i))
                if len(p) > 1:
                    self.rank[i], self.halves[i] = -self.score[p], (self.id[steps[-2][0]], self.id[steps[-2][1]])
        self.automaton.make_automaton()
        self.cache = Cache(self._part)

    def _merge(self, text: str) -> list[list[str]]:
        """Plain merging of a short string, best score first, leftmost among equals: all steps."""
        steps = [list(text)]
        while True:
            parts = steps[-1]
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return steps
            k = -best[1]
            steps.append([*parts[:k], parts[k] + parts[k + 1], *parts[k + 2 :]])

    def _compatible(self, pair: int) -> bool:
        """Whether two entries (packed) stay apart when they stand next to each other.

        Their merges are undone, the last one first; what then meets at the border must have no
        merge that would have come before the one undone (on a tie, the left one comes first).
        """
        left, right = pair >> 32, pair & 0xFFFFFFFF
        text, rank, halves, limit = self.text, self.rank, self.halves, float("inf")
        while True:
            joined = self.score.get(text[left] + text[right])
            if joined is not None and -joined < limit:
                return False
            a, b = rank[left], rank[right]
            if a > b:
                left, limit = halves[left][1], a
            elif b > float("-inf"):
                right, limit = halves[right][0], math.nextafter(b, float("inf"))
            else:
                return True

    def prefix_table(self, text: str) -> list[int]:
        """Last token of each prefix, from length 1 on; -1 for a character without an entry."""
        last, pair = [-1] * len(text), self.pair
        for end, (size, entry) in self.automaton.iter(text):
            if last[end] < 0:
                before = last[end - size] if end >= size else -1
                if before < 0 or pair[before << 32 | entry]:
                    last[end] = entry
        return last

    def _part(self, part: str) -> tuple[bytes, int, str]:
        """Ids (packed), their number and the decoded text of one part."""
        last, at, ids, sizes = self.prefix_table(part), len(part) - 1, [], self.size
        while at >= 0:  # backwards
            entry = last[at]
            if entry >= 0:
                ids.append(entry)
                at -= sizes[entry]
            else:
                data = part[at].encode()
                ids.extend(self.byte_id.get(b, self.unknown) for b in reversed(data)) if self.byte_id else ids.append(self.unknown)
                at -= 1
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids), len(ids), self.decode(ids, strip=False)

    def decode(self, ids: list[int], strip: bool = True) -> str:
        """Text of ids: byte entries join to UTF-8, control entries vanish, the first space goes."""
        if not self.other.intersection(ids):
            text = "".join(map(self.text.__getitem__, ids)).replace(SPACE, " ")
            return text[1:] if strip and text.startswith(" ") else text
        out, data = [], bytearray()
        for i in ids:
            if i in self.byte_value:
                data.append(self.byte_value[i])
                continue
            if data:
                out.append(data.decode("utf-8", "replace"))
                data.clear()
            if i not in self.control:
                out.append(self.text[i].replace(SPACE, " "))
        out.append(data.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if strip and text.startswith(" ") else text

    def encode(self, text: str) -> tuple[bytes, int, str]:
        """Packed ids with begin and end, their number, decoded text."""
        head, tail = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        if not text:
            return head + tail, 2, ""
        cache = self.cache
        done = [cache[p] if len(p) <= KEPT_CHARS else self._part(p) for p in self.part.findall(SPACE + text.replace(" ", SPACE))]
        cache.trim(KEPT_PARTS)
        ids, sizes, decoded = zip(*done)
        return head + b"".join(ids) + tail, 2 + sum(sizes), "".join(decoded)[1:]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ids`` (little-endian unsigned 32-bit integers, begin and end included), ``n_tokens`` and
    ``decoded`` (the text of the ids) of every row.

    ``model`` is the path of the vocabulary, the same on every worker. A null text counts as empty
    and has the two ids begin and end; rows stay as they are, repeated ones included.
    """
    rows = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    fields = [docs.schema[id_col], T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]
    schema = T.StructType(fields)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                ids, n, text = zip(*map(pieces.encode, part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(text, pa.string())], schema.names)

    return rows.mapInArrow(encoded, schema)


def decode(rows: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` for a binary column of packed ids (null: null); all columns stay."""

    @F.pandas_udf("string")
    def text(ids):
        pieces = load(model)
        return ids.map(lambda b: None if b is None else pieces.decode(np.frombuffer(b, "<u4").tolist()))

    return rows.withColumn("decoded", text(ids_col))
