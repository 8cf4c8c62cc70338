"""Language ID (operator 9): sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training rows in tasks.  The model is fitted with
follow-the-regularised-leader (per-coordinate steps, elastic-net penalties) on a bounded number
of rows per language and calibrated with a temperature on rows of that sample kept out of the fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import crc_of_id, hash_below, int_array, pieces, stored

BITS = 16
DIMS = 1 << BITS
ORDERS = (1, 2, 3)
UNDETERMINED = "und"
#: Texts with fewer n-grams (three or four letters) are too short to be called foreign.
FEWEST = 12
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters (made once per worker)."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of a whole text and their counts; runs of non-letters are one space.
    Both are empty if the text is null or has no letter."""
    if not text:
        return np.empty(0, np.uint16), np.empty(0, np.int64)
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cps]
    if not letter.any():
        return np.empty(0, np.uint16), np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    chars = np.concatenate((np.array([32], np.uint32), np.where(letter, cps, np.uint32(32))[keep], np.array([32], np.uint32)))
    mul = np.uint32(0x9E3779B1)
    acc, ids = np.zeros(len(chars), np.uint32), []
    for order in range(1, max(ORDERS) + 1):
        acc = (acc[: len(chars) - order + 1] ^ (chars[order - 1 :] + np.uint32(order))) * mul
        acc ^= acc >> np.uint32(15)
        if order in ORDERS:
            ids.append((acc >> np.uint32(32 - BITS)).astype(np.uint16))
    return np.unique(np.concatenate(ids), return_counts=True)


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear term frequency times idf, at unit length."""
    x = (1 + np.log(counts)) * idf
    norm = math.sqrt(float(x @ x))
    return x / norm if norm else x


def surprises(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int) -> np.ndarray:
    """(DIMS, k): minus the log of each n-gram's smoothed frequency in the rows (ids, counts) of each language.
    A row counts by its relative frequencies, so that no long text speaks for its language."""
    total = np.full((DIMS, k), 0.0)
    for (ids, counts), c in zip(rows, y):
        total[ids, c] += counts / counts.sum()
    share = total / np.maximum(total.sum(0), 1e-9)
    return -np.log(0.999 * share + 0.001 / DIMS).astype(np.float32)


@dataclass
class Limits:
    """What of a language a text may be: its mean surprise lies at most ``most`` deviations over its language's,
    deviations of a text of n n-grams having variance a + b / n; texts of ``long`` n-grams or more must
    also have the probability ``least``, which short ones often lack."""

    mean: np.ndarray
    a: float
    b: float
    most: float
    long: float
    least: float

    def reject(self, surprise: float, n: int, i: int, p: float) -> bool:
        if n < FEWEST:
            return False
        return surprise - self.mean[i] > self.most * math.sqrt(self.a + self.b / n) or (n >= self.long and p < self.least)


def limits(surprise: np.ndarray, n: np.ndarray, i: np.ndarray, p: np.ndarray, k: int, loss: float) -> Limits | None:
    """Limits that reject at most about ``loss`` of rows like these: mean surprise, n-grams, likeliest language and
    its probability.  None without rows of FEWEST n-grams, when nothing is known of what is usual."""
    enough = n >= FEWEST
    surprise, n, i, p = surprise[enough], n[enough], i[enough], p[enough]
    if not len(n):
        return None
    # a language without rows here is taken to be as usual as all are
    mean = np.array([np.median(surprise[i == c]) if (i == c).any() else np.median(surprise) for c in range(k)])
    r = surprise - mean[i]
    b, a = np.polyfit(1 / n, r * r, 1) if len(np.unique(n)) > 1 else (0.0, float((r * r).mean()))
    a, b = max(float(a), 1e-3), max(float(b), 1.0)
    most = max(8.0, float(np.quantile(r / np.sqrt(a + b / n), 1 - loss, method="higher")))
    long = float(np.median(n))
    return Limits(mean, a, b, most, long, min(0.5, float(np.quantile(p[n >= long], loss, method="lower"))))


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    surprise: np.ndarray | None = None  # (DIMS, k): minus the log frequency of an n-gram in a language
    limits: Limits | None = None

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its calibrated probability; (und, 0) without a letter, or without a learned language."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """``predict`` and whether the limits let the text be of that language."""
        ids, counts = grams(text)
        if not len(ids) or not self.classes:
            return UNDETERMINED, 0.0, False
        z = (tfidf(counts, self.idf[ids]) @ self.weights[ids] + self.bias) / self.temperature
        z = np.exp(z - z.max())
        i = int(z.argmax())
        p = float(z[i] / z.sum())
        n = int(counts.sum())
        usual = self.limits is None or not self.limits.reject(float(counts @ self.surprise[ids, i]) / n, n, i, p)
        return self.classes[i], p, usual


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, alpha: float, beta: float, l1: float, l2: float, epochs: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression: weights (DIMS, k) and bias, sparse by the l1 part."""
    z, n = np.zeros((DIMS, k)), np.zeros((DIMS, k))
    bias, bn = np.zeros(k), np.zeros(k)
    rng = np.random.default_rng(seed)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, x = rows[i]
            zi, ni = z[ids], n[ids]
            w = weights(zi, ni)
            s = x @ w + bias
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = x[:, None] * p
            after = ni + g * g
            z[ids] = zi + g - (np.sqrt(after) - np.sqrt(ni)) / alpha * w
            n[ids] = after
            bn += p * p
            bias -= alpha * p / (beta + np.sqrt(bn))
    return weights(z, n), bias


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, between 0.05 and 20 (golden section on its log)."""
    if not len(y):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / math.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, ratio = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS, np.int64), 0
    for batch in pieces(batches):
        for text in batch.column(0).to_pylist():
            ids, _ = grams(text)
            df[ids] += 1
            n += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([int_array(np.append(at, -1)), int_array(np.append(df[at], n))], ["gram", "df"])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        found = [grams(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([c.astype(np.uint32).tobytes() for _, c in found], pa.binary())], ["lang", "held", "ids", "counts"])


def held_out(col: str = "doc_id") -> Column:
    """crc32 of the id mod 4 is 2; false for a null id (which is never trained on)."""
    return F.coalesce(crc_of_id(col) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, rows_per_language: int = 2000, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 6, loss: float = 0.0005) -> Model:
    """Learn from ``docs`` (doc_id, text, lang) with a non-null lang and an id that isn't held out.

    At most about ``rows_per_language`` rows of each language are fitted on, chosen by a hash of the
    id; the driver gets their n-gram counts, one row per language and the document frequencies
    (2**16 numbers at most).  Without a training row the model predicts ``und``.  The limits of ``identified``
    lose about ``loss`` of the rows that are kept out of the fit.
    """
    train = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & (crc_of_id() % 4 != 2))
    per = stored(train.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    df = train.select("text").mapInArrow(_document_frequency, "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df")).collect()
    total = sum(r["df"] for r in df if r["gram"] < 0)
    idf = np.full(DIMS, math.log(1 + total))
    for r in df:
        if r["gram"] >= 0:
            idf[r["gram"]] = math.log((1 + total) / (1 + r["df"])) + 1e-3
    chosen = train.join(per, "lang").where(hash_below(F.lit(float(rows_per_language)) / F.col("rows"), "doc_id"))
    held = F.pmod(F.xxhash64(F.lit(0xCA11), "doc_id"), F.lit(5)) == 0
    got = chosen.select("lang", "text", held.alias("held")).mapInArrow(_sample, "lang string, held boolean, ids binary, counts binary").toArrow().to_pylist()
    got = sorted((r for r in got if r["ids"]), key=lambda r: (r["lang"], r["ids"], r["counts"]))
    classes = sorted({r["lang"] for r in got})
    if not classes:
        return Model([], idf, np.zeros((DIMS, 1)), np.zeros(1), 1.0)
    rows, y = [], np.array([classes.index(r["lang"]) for r in got])
    for r in got:
        ids = np.frombuffer(r["ids"], np.uint16)
        rows.append((ids, tfidf(np.frombuffer(r["counts"], np.uint32).astype(float), idf[ids])))
    held_rows = np.array([r["held"] for r in got])
    seen = np.isin(y, np.unique(y[~held_rows]))
    inside = ~held_rows | ~seen  # a language with held rows only is fitted on them
    w, b = ftrl([x for x, i in zip(rows, inside) if i], y[inside], len(classes), alpha, beta, l1, l2, epochs)
    outside = np.flatnonzero(~inside)
    scores = np.array([rows[i][1] @ w[rows[i][0]] + b for i in outside]).reshape(len(outside), len(classes))
    t = temperature(scores, y[outside])
    raw = [(np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["counts"], np.uint32).astype(float)) for r in got]
    strange = surprises([x for x, i in zip(raw, inside) if i], y[inside], len(classes))
    best = scores.argmax(1) if len(outside) else np.empty(0, int)
    p = np.exp((scores - scores.max(1, keepdims=True)) / t) if len(outside) else scores
    n = np.array([raw[i][1].sum() for i in outside])
    usual = np.array([raw[i][1] @ strange[raw[i][0], c] for i, c in zip(outside, best)]) / np.maximum(n, 1)
    return Model(classes, idf, w.astype(np.float32), b, t, strange, limits(usual, n, best, 1 / p.sum(1) if len(outside) else n, len(classes), loss))


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        got = [model.predict(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a for a, _ in got], pa.string()), pa.array([p for _, p in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``: a learned language, however unlike it the text
    may be; ``und`` with score 0 only if the text is null or has no letter.  Repeated rows give repeated results;
    other columns aren't read; no rows in, none out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict, model=model), "doc_id long, held_out boolean, lang_pred string, score double")


def _kept(batches: Iterator[pa.RecordBatch], model: Model, at: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        got = [model.judge(t) for t in batch.column(at).to_pylist()]
        yield batch.filter(pa.array([usual and p >= least for _, p, usual in got], pa.bool_()))


def identified(docs: DataFrame, model: Model, least_score: float = 0.0) -> DataFrame:
    """Rows of ``docs`` whose language is determined, with a probability of ``least_score`` or more, all columns.

    By default the model's own limits decide: texts without a letter and those unlike their likeliest language go,
    short texts may have a low probability.  Null texts go; repeated rows stay or go together; no rows in, none out.
    """
    return docs.mapInArrow(partial(_kept, model=model, at=docs.columns.index("text"), least=least_score), docs.schema)
