"""Quality classifier (operator 2): positive-unlabelled learning with a non-negative risk.

Trusted positives (label 1) and unlabelled texts are all the classifier sees.  With the class
prior q, estimated from both, the negative risk is estimated as (unlabelled as negative) - q * (positive as
negative); it can't be below zero, so where the estimate is, the step goes the other way.
Features are shares and ratios of the whole text, expanded by hinges at their quantiles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import crc_of_id, hash_below, pieces, stored


def _byte_classes() -> np.ndarray:
    """0 lower, 1 upper, 2 digit, 3 white space, 4 sentence marks, 5 other ASCII, 6 beyond ASCII."""
    table = np.full(256, 5, np.uint8)
    table[128:] = 6
    for chars, kind in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (range(9, 14), 3), ([32], 3), (b".,;:?!'\"()-", 4)):
        table[list(chars)] = kind
    return table


_CLASSES = _byte_classes()
FEATURES = 21


def features(text: str | None) -> np.ndarray:
    """Numbers between 0 and about 12 that describe a whole text; those of an empty one if it is null."""
    text = text or ""
    words = text.split()
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size, m = max(1, len(raw)), max(1, len(words))
    shares = np.bincount(_CLASSES[raw], minlength=7) / size
    counts = Counter(words)
    top = sorted(counts.values(), reverse=True)[:3]
    lines = [x for x in text.split("\n") if x]
    pairs = set(zip(words, words[1:]))
    ends = bytes(ord(w[-1]) & 127 if ord(w[-1]) < 128 else 97 for w in words)
    end = np.bincount(_CLASSES[np.frombuffer(ends, np.uint8)], minlength=7) / m
    return np.array([
        *shares, np.log1p(len(words)), sum(map(len, words)) / m, len(counts) / m, (top[0] if top else 0) / m, sum(top) / m,
        sum(map(str.__eq__, words, words[1:])) / m, len(pairs) / m, sum(map(str.isupper, words)) / m, sum(map(str.istitle, words)) / m,
        sum(map(str.isalpha, words)) / m, end[4], end[5], len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)),
    ], np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    weights: np.ndarray
    bias: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z] + [np.maximum(0, z - k) for k in self.knots], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        g = self.expand(x) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _log1pexp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.03, l2: float = 1e-4) -> Model:
    """Minimise the non-negative unbiased risk with the logistic loss, by Adam on all rows."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    z = np.clip((unlabelled - mean) / scale, -8, 8)
    knots = np.quantile(z, [0.02, 0.1, 0.3, 0.6, 0.9, 0.98], axis=0)
    width = z.shape[1] * (1 + len(knots))
    model = Model(mean, scale, knots, np.zeros(width), float(np.log(prior / (1 - prior))))
    p, u = model.expand(positive), model.expand(unlabelled)
    w, b = model.weights, model.bias
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        gp, gu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-np.clip(gp, -30, 30))), 1 / (1 + np.exp(-np.clip(gu, -30, 30)))
        negative = _log1pexp(gu).mean() - prior * _log1pexp(gp).mean()
        grad_negative = np.append(u.T @ su / len(u) - prior * (p.T @ sp) / len(p), su.mean() - prior * sp.mean())
        grad_positive = prior * np.append(p.T @ (sp - 1) / len(p), (sp - 1).mean())
        grad = grad_positive + grad_negative if negative >= 0 else -grad_negative
        grad[:-1] += l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    model.weights, model.bias = w, float(b)
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among ``unlabelled``, from it and trusted positives alone.

    A classifier of positives against unlabelled rows is fitted on one half of both; of the other halves, let p and u be
    the shares with a score above a threshold.  Negatives only raise u, so u / p bounds the prior from above, most
    tightly where few negatives score as high: the threshold with the least upper confidence bound is
    taken.  Without rows enough for two halves, 0.5.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    rng = np.random.default_rng(11)
    p, u = (rng.permutation(len(x)) for x in (positive, unlabelled))
    model = fit_pu(positive[p[::2]], unlabelled[u[::2]], 0.5, steps=300)
    sp, su = np.sort(model.score(positive[p[1::2]])), np.sort(model.score(unlabelled[u[1::2]]))
    above_p = 1 - np.searchsorted(sp, sp, "left") / len(sp)
    above_u = 1 - np.searchsorted(su, sp, "left") / len(su)
    width = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = int(np.argmin((above_u + width) / above_p))
    return float(min(max(above_u[best] / above_p[best], 0.01), 0.99))


def held_out(col: str = "doc_id") -> Column:
    """crc32 of the id mod 3 is 1; false for a null id (which has no label)."""
    return F.coalesce(crc_of_id(col) % 3 == 1, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        x = [features(t).tobytes() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], ["doc_id", "held_out", "x"])


def described(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, x (features as bytes) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_features, "doc_id long, held_out boolean, x binary")


def _matrix(df: DataFrame) -> np.ndarray:
    got = sorted(df.select("x").toArrow()["x"].to_pylist())
    return np.frombuffer(b"".join(got), np.float32).reshape(-1, FEATURES).astype(float)


def fit(described_docs: DataFrame, labels: DataFrame, positives: int = 10_000, unlabelled: int = 10_000, prior: float | None = None) -> Model | None:
    """Fit on trusted positives and unlabelled rows that aren't held out.

    At most about ``positives`` and ``unlabelled`` rows are fitted on, chosen by a hash of the id.
    ``prior``: the share of positives; estimated from these rows if not given (``class_prior``), so labelled
    negatives are neither needed nor used.  Labels with a null id or quality teach nothing; an id with several
    labels is positive if one is 1.  None if there is no trusted positive.
    """
    known = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id_")).agg(F.max("quality").alias("quality"))
             .where(~held_out("id_")))
    count = known.agg(F.coalesce(F.sum(F.when(F.col("quality") == 1, 1)), F.lit(0)).alias("ones")).first()
    if not count["ones"]:
        return None
    open_ = described_docs.where("not held_out")
    ids = known.where((F.col("quality") == 1) & hash_below(positives / count["ones"], "id_")).select("id_")
    pos = _matrix(open_.join(ids, open_["doc_id"] == ids["id_"], "left_semi"))
    some = _matrix(open_.where(hash_below(unlabelled / max(1, open_.count()), "doc_id")))
    if not len(pos) or not len(some):
        return None
    return fit_pu(pos, some, class_prior(pos, some) if prior is None else min(max(prior, 0.01), 0.99))


def _score(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)
        p = model.score(x) if model is not None else np.full(len(x), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; the texts are read once.

    A null text counts as empty and is scored as such.  Repeated rows give repeated results; other
    columns aren't read; no rows in, none out; 0.5 for all if no trusted positive is known.
    """
    known = stored(described(docs), "features")
    return known.mapInArrow(partial(_score, model=fit(known, labels, **options)), "doc_id long, held_out boolean, score double, predicted int")
