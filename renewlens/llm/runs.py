"""Periodic runs of words (operator 11): recursive frequency splitting, then a scan by lags.

A run is a stretch of words with smallest period q, at least ``max(least_words, 2 * q)`` words long, that
no neighbouring word extends.  Every word of a run comes again in it, so a word that occurs once within a
segment can be in none of the segment's runs: it splits the segment, counts are taken anew in the parts,
and so on until nothing splits.  What is left is also split where no stretch of ``least_words // 2`` words
around a word comes again, which counting allows as well, and is then scanned lag by lag.

Texts are independent of each other: one pass over the rows, no shuffle, whatever repeats among them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from renewlens.llm.common import WORD_PATTERN, pieces, utf8

LEAST_WORDS = 12
_WORD = re.compile(WORD_PATTERN.encode())
_SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _stretches(alive: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The stretches of true values that are at least ``least`` long."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], alive, [False])).astype(np.int8)))
    return [(s, e) for s, e in edges.reshape(-1, 2).tolist() if e - s >= least]


def frequent_segments(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Segments [start, end) of at least ``least`` words in which every word occurs twice at least."""
    todo, done = ([(0, len(ids))] if len(ids) >= least else []), []
    while todo:
        s, e = todo.pop()
        part = ids[s:e]
        _, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
        alive = counts[inverse] > 1
        if alive.all():
            done.append((s, e))
        else:
            todo += [(s + a, s + b) for a, b in _stretches(alive, least)]
    return sorted(done)


def _grams(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k words from each position on."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        n = len(x) - k + 1
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(0x100000001B3) + x[j : j + n]
    return out


def _recurring(grams: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
    """Segments whose words all lie in a stretch of k words that comes again."""
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(len(grams) + k, np.int32)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + k, -1)
    return _stretches(np.cumsum(edge)[:-1] > 0, least)


def _extended(ids: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The largest [a, b) around i whose words equal those q further on; empty if not even word i does."""
    a = b = i
    size, stop = 32, len(ids) - q
    while b < stop:
        n = min(size, stop - b)
        differ = ids[b : b + n] != ids[b + q : b + q + n]
        if differ.any():
            b += int(differ.argmax())
            break
        b, size = b + n, size * 2
    size = 32
    while a > 0:
        n = min(size, a)
        differ = ids[a - n : a] != ids[a - n + q : a + q]
        if differ.any():
            a -= int(differ[::-1].argmax())
            break
        a, size = a - n, size * 2
    return a, b


def lag_scan(ids: np.ndarray, grams: np.ndarray, k: int, least: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a segment.

    A run of period q repeats at lag q over at least t = max(least - q, q) >= k words, so of every
    t - k + 1 positions one starts k words that come again q further on: only these are looked at, and hits
    are extended word by word.  Lags that are multiples of a run's period find the same run and are passed by.
    """
    m, found, known = len(ids), [], {}
    for q in range(1, m // 2 + 1):
        step = max(least - q, q) - k + 1
        hits = np.flatnonzero(grams[: len(grams) - q : step] == grams[q::step]) * step
        if not len(hits):
            continue
        for s, e in known.pop(q, ()):
            hits = hits[(hits < s) | (hits >= e - q)]
        end = -1
        for i in hits.tolist():
            if i < end:
                continue
            a, end = _extended(ids, i, q)
            length = end - a + q
            if length >= max(least, 2 * q):
                found.append((a, length, q))
                for lag in range(2 * q, length, q):
                    known.setdefault(lag, []).append((a, a + length))
    # a stretch with a smaller period was found by that period first, at the same place
    first: dict[tuple[int, int], int] = {}
    for a, length, q in found:
        first.setdefault((a, length), q)
    return [(a, length, q) for (a, length), q in first.items()]


def runs_of(ids: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word numbers, by start, then period."""
    k = max(1, least // 2)
    out, todo = [], frequent_segments(ids, least)
    while todo:
        s, e = todo.pop()
        part = ids[s:e]
        grams = _grams(part, k)
        parts = _recurring(grams, k, least)
        if parts == [(0, e - s)]:
            out += [(s + a, length, q) for a, length, q in lag_scan(part, grams, k, least)]
        else:
            for a, b in parts:
                todo += [(s + a + c, s + a + d) for c, d in frequent_segments(part[a:b], least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for the words that a run contains after its first period."""
    edge = np.zeros(n + 1, np.int32)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return np.cumsum(edge)[:n] > 0


def _texts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        sizes, runs, texts = [], [], []
        for text in utf8(batch.column(1)):
            words = _WORD.findall(text or b"")
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
            got = runs_of(ids, least)
            if got:
                cut = dropped(len(words), got).tolist()
                words = [w for w, out in zip(words, cut) if not out]
            sizes.append(len(ids))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in got])
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of each row.

    docs: (doc_id, text).  Words are runs of anything but ASCII white space, numbered from 0.  ``collapsed``
    has the words that no run contains after its first period, joined by one space.  Null and empty texts
    have no words, no runs and an empty ``collapsed``; null and repeated ids and repeated rows stay as they
    are, one row each; an empty table gives no rows.  Other columns aren't read.  A text is one task's work,
    in memory that grows with the text and time with n log n but for texts made to repeat at many lags.
    """
    if least_words < 2:
        raise ValueError("a run has at least two words")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_texts, least=least_words), f"doc_id {kind}, {_SCHEMA}")
