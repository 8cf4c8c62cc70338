"""Toxicity (operator 7): a classifier chain of sparse linear models.

Categories are predicted in order; each model sees the text's features and the probabilities
of the categories before it.  While fitting, those probabilities are out-of-fold: each
training row gets them from a model fitted on the other folds.  Features are the presence of
words, of their starts and of their ends, hashed, and coarse shares of the text; an l1
penalty leaves few of them with a weight, so that in a text of any length only telling words
count, and scoring looks up each distinct word once.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import hash_below, pieces, stored

BITS = 20
DIMS = 1 << BITS
#: Ids from here on: bins of shares of the text, then one per earlier category's probability.
SHARES, BINS = DIMS, 10
EARLIER = SHARES + 4 * BINS
#: The chain: category and how it follows from a row of ``labels``.  The last one decides, fed by those before it.
CATEGORIES: tuple[tuple[str, str], ...] = (
    ("toxic_prose", "toxic = 1 and quality = 1"),
    ("toxic_junk", "toxic = 1 and quality = 0"),
    ("toxic", "toxic = 1"),
)
_MASK = DIMS - 1
_MARKS = string.punctuation + "\u00a1\u00ab\u00bb\u00bf\u2018\u2019\u201c\u201d\u201e\u2026"


def word_features(word: str) -> list[int]:
    """Hashed features of one lower-case word without the marks at its edges: itself, its first 4 and 6 letters, its last 4."""
    w = word.strip(_MARKS)
    if not w:
        return []
    hashed = xxhash.xxh3_64_intdigest
    return [hashed("w" + w) & _MASK, hashed("s" + w[-4:]) & _MASK, hashed(w[:4]) & _MASK, hashed("6" + w[:6]) & _MASK]


def share_features(words: list[str], distinct: int) -> np.ndarray:
    m = max(1, len(words))
    shares = (sum(map(str.isupper, words)) / m, sum(map(str.isalpha, words)) / m, distinct / m, sum(map(str.istitle, words)) / m)
    return np.array([SHARES + i * BINS + min(BINS - 1, int(s * BINS)) for i, s in enumerate(shares)], np.int64)


class _Features(dict):
    """word -> features, emptied when it holds too many."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = np.array(word_features(word), np.int64)
        return value


def text_features(text: str | None, cache: _Features) -> np.ndarray:
    """Sorted ids of a whole text; only the share bins of an empty one if it is null or empty."""
    text = text or ""
    words = text.split()
    distinct = set(text.lower().split())
    parts = [share_features(words, len(distinct))] + [cache[w] for w in distinct]
    return np.unique(np.concatenate(parts))


@dataclass
class Linear:
    """A sparse logistic model: ids in order and their weights, and the bias."""

    ids: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, ids: np.ndarray, earlier: list[float]) -> float:
        at = np.searchsorted(self.ids, ids)
        at[at == len(self.ids)] = 0
        z = self.bias + (float(self.weights[at][self.ids[at] == ids].sum()) if len(self.ids) else 0.0)
        for i, p in enumerate(earlier):
            j = np.searchsorted(self.ids, EARLIER + i)
            if j < len(self.ids) and self.ids[j] == EARLIER + i:
                z += self.weights[j] * (2 * p - 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, epochs: int, alpha: float = 0.3, l1: float = 0.5, l2: float = 0.1, seed: int = 5) -> Linear:
    """Logistic regression on binary features by FTRL-proximal with l1 and l2 penalties; earlier: (rows, categories)."""
    size = EARLIER + earlier.shape[1]
    z, n = np.zeros(size), np.zeros(size)
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    extra = np.arange(EARLIER, size)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((1 + np.sqrt(ni)) / alpha + l2))

    rng, bn = np.random.default_rng(seed), 1.0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids = np.concatenate((rows[i], extra))
            x = np.ones(len(ids))
            if len(extra):
                x[-len(extra) :] = 2 * earlier[i] - 1
            zi, ni = z[ids], n[ids]
            w = weights(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y[i]
            gx = g * x
            after = ni + gx * gx
            z[ids] = zi + gx - (np.sqrt(after) - np.sqrt(ni)) / alpha * w
            n[ids] = after
            bn += g * g
            bias -= 0.1 * g / np.sqrt(bn)
    w = weights(z, n)
    at = np.flatnonzero(w)
    return Linear(at, w[at], bias)


@dataclass
class Chain:
    names: list[str]
    models: list[Linear] = field(default_factory=list)

    def of(self, ids: np.ndarray) -> list[float]:
        out: list[float] = []
        for m in self.models:
            out.append(float(m.score(ids, out)))
        return out

    def telling(self) -> np.ndarray:
        """Ids of words that have a weight in any model."""
        ids = np.unique(np.concatenate([m.ids for m in self.models])) if self.models else np.empty(0, np.int64)
        return ids[ids < SHARES]


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, names: list[str], folds: np.ndarray, epochs: int = 3) -> Chain:
    """labels: (rows, categories), in chain order; folds: the fold of each row."""
    chain, earlier = Chain(names), np.zeros((len(rows), 0))
    for j in range(len(names)):
        y = labels[:, j]
        chain.models.append(fit_linear(rows, earlier, y, epochs))
        if j + 1 == len(names):
            break
        p = np.zeros(len(rows))
        for f in np.unique(folds):
            out = np.flatnonzero(folds == f)
            inside = np.flatnonzero(folds != f)
            m = fit_linear([rows[i] for i in inside], earlier[inside], y[inside], epochs)
            p[out] = [m.score(rows[i], list(earlier[i])) for i in out]
        earlier = np.column_stack((earlier, p))
    return chain


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Features()
    for batch in pieces(batches):
        ids = [text_features(t, cache).astype(np.int32).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), batch.column(2), batch.column(3)], ["doc_id", "ids", "y", "fold"])


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[tuple[str, str], ...] = CATEGORIES, rows: int = 8000, folds: int = 3) -> Chain:
    """Fit the chain on labelled documents.

    At most about ``rows`` labelled ids are fitted on, chosen by a hash of the id; that bounds the
    broadcast list of ids and what the driver gets.  Labels that are null, or whose id is null or in no
    document, teach nothing; of several labels of an id, a category holds if it holds in one.  Without a
    labelled row every probability is 0.5.
    """
    flags = F.array(*[F.coalesce(F.max(F.expr(cond)), F.lit(False)) for _, cond in categories]).alias("y")
    known = stored(labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id_")).agg(flags), "labels")
    n = known.count()
    chosen = known.where(hash_below(rows / max(n, 1), "id_"))
    fold = F.pmod(F.xxhash64(F.lit(3), "id_"), F.lit(folds)).cast("int")
    texts = (docs.select(F.col("doc_id").cast("long").alias("id_"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(chosen), "id_").select(F.col("id_").alias("doc_id"), "text", "y", fold.alias("fold")))
    got = texts.mapInArrow(_features, "doc_id long, ids binary, y array<boolean>, fold int").toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["ids"]))
    names = [c for c, _ in categories]
    if not got:
        return Chain(names, [Linear(np.empty(0, np.int64), np.empty(0), 0.0) for _ in names])
    x = [np.frombuffer(r["ids"], np.int32).astype(np.int64) for r in got]
    return fit_chain(x, np.array([r["y"] for r in got], float), names, np.array([r["fold"] for r in got]))


class _Telling(dict):
    """word -> those of its features that have a weight; most words have none."""

    def __init__(self, ids: np.ndarray):
        super().__init__()
        self.weighted = bytearray(DIMS)
        for i in ids.tolist():
            self.weighted[i] = 1

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 150_000:
            self.clear()
        weighted = self.weighted
        value = self[word] = tuple([i for i in word_features(word) if weighted[i]])
        return value


class Scorer:
    """Probabilities of whole texts, with a bounded memory of words."""

    def __init__(self, chain: Chain):
        self.chain, self.words = chain, _Telling(chain.telling())

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        words = text.split()
        distinct = set(text.lower().split())
        found: set[int] = set()
        for f in map(self.words.__getitem__, distinct):
            if f:
                found.update(f)
        ids = np.concatenate((np.sort(np.fromiter(found, np.int64, len(found))), share_features(words, len(distinct))))
        return self.chain.of(ids)


def _score(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(chain)
    for batch in pieces(batches):
        p = np.array([scorer(t) for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, len(chain.names))
        yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(p[:, j], pa.float64()) for j in range(p.shape[1])], ["doc_id"] + [f"p_{c}" for c in chain.names])


def flagged(chain: Chain, threshold: float) -> Column:
    """Whether the last link of the chain says so."""
    return F.col(f"p_{chain.names[-1]}") >= threshold


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """doc_id, a probability p_<category> per category and ``toxic`` (the last one's is ``threshold`` or more) for
    every row of ``docs``.  A null text counts as empty; repeated rows give repeated results; other columns aren't
    read; no rows in, none out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = ", ".join(["doc_id long"] + [f"p_{c} double" for c in chain.names])
    return rows.mapInArrow(partial(_score, chain=chain), schema).withColumn("toxic", flagged(chain, threshold))


def _kept(batches: Iterator[pa.RecordBatch], chain: Chain, at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(chain)
    for batch in pieces(batches):
        yield batch.filter(pa.array([scorer(t)[-1] < threshold for t in batch.column(at).to_pylist()], pa.bool_()))


def without_toxic(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that aren't toxic, with all their columns.  A null text counts as empty; repeated rows stay or
    go together; no rows in, none out."""
    return docs.mapInArrow(partial(_kept, chain=chain, at=docs.columns.index("text"), threshold=threshold), docs.schema)
