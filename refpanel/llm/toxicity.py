"""Toxicity by weak supervision.

Many voters look at a text: lexicons and patterns. A generative model over the votes of all
documents estimates how accurate each voter is and how strongly voters agree beyond the hidden
class, and gives posterior labels; a linear classifier over terms is trained on those.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refpanel.llm.common import Cache
from refpanel.llm.labelled import held_out, minimise, sigmoid, training_rows

#: Labelled rows that the lexicons and the classifier are fitted on, at most.
TRAINING_ROWS = 20_000
#: Terms that the classifier weighs, at most.
TERMS = 4096
#: Least likelihood ratio of a term; three times as much for a lexicon.
CHANCE = 10.0
#: Terms shared out among the learned lexicon voters.
LEXICON_TERMS = 240
LEXICONS = 7
#: A lexicon that makes up this share of the words votes strongly.
DENSE = 0.005
#: Common English insults.
INSULTS = frozenset("idiot moron stupid dumb loser scum trash clown pathetic worthless disgusting ugly".split())
#: Patterns that often mark abuse: address with an insult, threats, masked words, shouting.
PATTERNS = (
    re.compile(r"\b(?:you|your|ur|he|she|they)\b[^.!?\n]{0,30}\b(?:" + "|".join(sorted(INSULTS)) + r")\b", re.I),
    re.compile(r"\b(?:i|we)(?:'ll| will)? (?:kill|hurt|destroy|find) you\b|\bgo die\b|\bshut up\b", re.I),
    re.compile(r"\b[a-z]{1,2}[*@$]{2,}[a-z]{0,3}\b", re.I),
    re.compile(r"\b[A-Z]{4,}(?:\W+[A-Z]{4,}){2,}!"),
)
VOTERS = LEXICONS + 1 + len(PATTERNS)
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """A word and its beginnings (marked with a hyphen)."""
    return [word, *(f"{word[:k]}-" for k in range(4, min(len(word), 8)))]


def _term_counts(training: DataFrame) -> DataFrame:
    """Training texts of either label that hold a term: ``term, toxic, clean``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(terms_of)
        for batch in batches:
            counts = Counter(), Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label != 0].update({t for w in set(_WORD.findall(text.lower())) for t in cache[w]})
                cache.trim()
            terms = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([counts[k][t] for t in terms], pa.int64()) for k in (1, 0))], ["term", "toxic", "clean"])

    each = training.select("label", "text").mapInArrow(counted, "term string, toxic long, clean long")
    return each.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _votes(text: str, voters_of: Cache) -> int:
    """Votes as digits to the base 3: 0 silent, 1 weak, 2 strong."""
    words = _WORD.findall(text.lower())
    hits = [0] * (LEXICONS + 1)
    for mask in filter(None, map(voters_of.__getitem__, words)):
        for g in range(LEXICONS + 1):
            hits[g] += mask >> g & 1
    votes = [(h > 0) + (h > DENSE * len(words)) for h in hits]
    votes += [2 * bool(p.search(text)) for p in PATTERNS]
    return sum(v * 3**k for k, v in enumerate(votes))


def _digits(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(VOTERS) % 3


class LabelModel:
    """Two hidden classes; each voter has its own vote probabilities in either class.

    Fitted by expectation and maximisation on counts of vote patterns. Voters that agree beyond
    what the class explains would count the same evidence twice: the residual correlations within
    the classes, estimated along, lower their weight.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, prior: float, steps: int = 30):
        votes, n = _digits(codes), counts.astype(float)
        self.prior = min(max(prior, 1e-4), 0.5)
        strong = (votes[:, : LEXICONS + 1] == 2).sum(axis=1)
        posterior = np.select([strong >= 2, strong == 1], [0.95, 0.6], 0.02)
        self.weight = np.ones(VOTERS)
        for _ in range(steps):
            self.table = np.empty((2, VOTERS, 3))
            for c, r in enumerate((1 - posterior, posterior)):
                for v in range(3):
                    self.table[c, :, v] = ((votes == v) * (r * n)[:, None]).sum(axis=0) + (0.5, 0.1, 0.1)[v]
                self.table[c] /= self.table[c].sum(axis=1, keepdims=True)
            residual = np.zeros((VOTERS, VOTERS))
            for c, r in enumerate((1 - posterior, posterior)):
                mean = self.table[c] @ np.arange(3)
                residual += ((votes - mean) * (r * n)[:, None]).T @ (votes - mean)
            spread = np.sqrt(np.maximum(np.diag(residual), 1e-9))
            self.correlation = residual / spread / spread[:, None]
            self.weight = 1 / np.clip(self.correlation, 0, None).sum(axis=1).clip(1)
            posterior = self.posterior(codes)

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        odds = np.log(self.table[1] / self.table[0])
        each = odds[np.arange(VOTERS), _digits(codes)] * self.weight
        return sigmoid(each.sum(axis=1) + np.log(self.prior / (1 - self.prior)))


class Model:
    """Fitted weights: ``score`` is the probability that a text is toxic."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def scorer(self):
        get = self.weights.get
        cache = Cache(lambda w: sum(get(t, 0.0) for t in terms_of(w)))

        def score(text: str) -> float:
            words = _WORD.findall(text.lower())
            cache.trim()
            return sum(map(cache.__getitem__, words)) * 100 / (len(words) + 30) + self.bias

        return score


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Lexicons from labelled rows, vote counts from all documents, weights from posterior labels.

    None where no training row is labelled toxic or none clean.
    """
    training = training_rows(docs, labels, label_col, rows, id_col, text_col)
    n = {r.label: r.n for r in training.groupBy((F.col("label") != 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    share = n[1] / (n[0] + n[1])
    both = F.col("toxic") + F.col("clean")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (both * p))).otherwise(0.0)
    side = F.signum(F.col("toxic") - both * share)
    g = 2 * side * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share))  # signed likelihood ratio
    best = _term_counts(training).withColumn("g", g).filter(F.abs("g") > CHANCE).orderBy(F.abs("g").desc(), "term").limit(TERMS).collect()
    number = {r.term: k for k, r in enumerate(best)}
    sure = [r.term for r in best if r.g > 3 * CHANCE and r.toxic / n[1] > 8 * (r.clean + 0.5) / n[0]]
    lexicon = {term: 1 << k % LEXICONS for k, term in enumerate(sure[:LEXICON_TERMS])}

    def voters(word: str) -> int:
        mask = (word in INSULTS) << LEXICONS
        for term in terms_of(word):
            mask |= lexicon.get(term, 0)
        return mask

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(voters)
        for batch in batches:
            counts = Counter(_votes(text or "", cache) for text in batch.column(0).to_pylist())
            cache.trim()
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["code", "n"])

    every = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(vote, "code long, n long")
    patterns = every.groupBy("code").agg(F.sum("n").alias("n")).collect()  # 3 to the number of voters at most
    model = LabelModel(np.array([r.code for r in patterns]), np.array([r.n for r in patterns]), share)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(voters)
        known = Cache(lambda w: [number[t] for t in terms_of(w) if t in number])
        for batch in batches:
            codes, at, values = [], [], []
            for text in batch.column(0).to_pylist():
                words = _WORD.findall(text.lower())
                found = Counter(k for w in words for k in known[w])
                codes.append(_votes(text, cache))
                at.append(list(found))
                values.append([v * 100 / (len(words) + 30) for v in found.values()])
                cache.trim()
                known.trim()
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["code", "at", "x"])

    sample = training.select("text").mapInArrow(describe, "code long, at array<int>, x array<float>").toArrow()
    sizes = sample["at"].combine_chunks().value_lengths().to_numpy()
    at, x = sample["at"].combine_chunks().flatten().to_numpy(), sample["x"].combine_chunks().flatten().to_numpy().astype(float)
    row, y = np.repeat(np.arange(len(sizes)), sizes), model.posterior(sample["code"].to_numpy())
    scale = np.sqrt(np.bincount(at, x * x, len(number)) / len(sizes)) + 1e-3
    x = x / scale[at]

    def gradient(w: np.ndarray) -> np.ndarray:
        error = (sigmoid(np.bincount(row, x * w[at], len(sizes)) + w[-1]) - y) / len(sizes)
        return np.append(np.bincount(at, x * error[row], len(number)) + 1e-4 * w[:-1], error.sum())

    w = minimise(gradient, len(number) + 1)
    return Model({r.term: float(w[k] / scale[k]) for k, r in enumerate(best)}, float(w[-1]))


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``score`` predicts as toxic, judged where they lie: no join."""
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer() if model else lambda text: -np.inf
        for batch in batches:
            raw = np.array([of(text or "") for text in batch.column(at).cast(pa.string()).to_pylist()], float)
            yield batch.filter(pa.array(sigmoid(raw) < 0.5))

    return docs.mapInArrow(kept, docs.schema)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``held_out``, ``score`` (0 to 1) and ``predicted`` (score of 0.5 or more) of every row.

    Null and empty texts get the score of a text without known terms; without a model it is 0.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer() if model else lambda text: -np.inf
        for batch in batches:
            raw = np.array([of(text or "") for text in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(raw) if model else np.zeros(len(raw)))], schema.names)

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(scored, schema)
    return rows.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
