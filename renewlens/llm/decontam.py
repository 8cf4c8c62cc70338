"""Benchmark decontamination (operator 1): CGK embedding, bit-sampling LSH, exact edit distance.

Passages are compared as word sequences (lower case, without marks at their edges).  The CGK
random walk turns a sequence into one of three times its length, so that sequences at a small
edit distance agree at most positions; keys of a few sampled positions, repeated until the
target recall is reached, select candidate windows of an item's size; a candidate counts if
an exact edit distance within ``max_edits`` of the item's length follows.

Windows are only embedded where they can match at all: with at most k edits, one of k + 1
pieces of the item is untouched, so window and item share that many words in a row.

The benchmark goes to the tasks in blocks of at most ``block_words`` words, one scan of the
documents per block; documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import WordHashes, pieces

MAX_EDITS = 0.2
TARGET_RECALL = 0.99
SAMPLED = 3
MAX_REPEATS = 48
BLOCK_WORDS = 1_000_000
MAX_GRAM = 4
MUL = np.uint64(0x9E3779B97F4A7C15)


def _word_key(word: str) -> int:
    """Hash of a word without the marks at its edges; 0 if nothing is left."""
    lo, hi = 0, len(word)
    while lo < hi and not word[lo].isalnum():
        lo += 1
    while hi > lo and not word[hi - 1].isalnum():
        hi -= 1
    return xxhash.xxh3_64_intdigest(word[lo:hi]) | 1 if lo < hi else 0


def sequence(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The words of a text as odd hashes."""
    h = hashes.of((text or "").lower().split())
    return h[h != 0]


def allowed(length: int | np.ndarray, share: float = MAX_EDITS):
    return np.floor(np.asarray(length) * share + 1e-9).astype(np.int64)


def cgk(tokens: np.ndarray, lengths: np.ndarray, steps: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Walk all rows of ``tokens`` (w, width; 0 beyond ``lengths``) once per repeat.

    steps: (repeats, 3 * width) odd multipliers; at a step, the top bit of multiplier * word says
    whether the walk moves on to the next word.  wanted: (repeats, w, s) positions to report, each
    below 3 * length.  Returns the words there, (repeats, w, s); 0 beyond the end of a row.
    """
    repeats, w = len(steps), len(tokens)
    padded = np.concatenate((tokens, np.zeros((w, 1), np.uint64)), axis=1)
    at = np.zeros((repeats, w), np.int64)
    rows, end = np.arange(w)[None, :], lengths[None, :]
    out = np.zeros(wanted.shape, np.uint64)
    for j in range(int(wanted.max()) + 1 if wanted.size else 0):
        now = padded[rows, at]
        hit = wanted == j
        if hit.any():
            out[hit] = np.broadcast_to(now[:, :, None], out.shape)[hit]
        move = (now * steps[:, j, None] * MUL) >> np.uint64(63)
        at = np.minimum(at + move.astype(np.int64), end)
    return out


def edit_distance(items: np.ndarray, lengths: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Least edit distance of each item to any run of its segment, row by row (rows padded with 0 and 1)."""
    w, width = segments.shape
    column = np.arange(width + 1)[None, :]
    row = np.zeros((w, width + 1), np.int32)
    best = np.zeros(w, np.int64)
    for i in range(1, int(lengths.max()) + 1):
        step = np.empty_like(row)
        step[:, 0] = i
        step[:, 1:] = np.minimum(row[:, :-1] + (segments != items[:, i - 1, None]), row[:, 1:] + 1)
        row = np.minimum.accumulate(step - column, axis=1) + column
        done = lengths == i
        if done.any():
            best[done] = row[done].min(1)
    return best


@dataclass
class Block:
    """Items of a benchmark with everything a task needs to find them."""

    ids: list
    tokens: np.ndarray
    lengths: np.ndarray
    edits: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    steps: np.ndarray
    picks: np.ndarray
    keys: np.ndarray


def _keys(tokens: np.ndarray, lengths: np.ndarray, steps: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """(repeats, w) LSH keys: the words at sampled positions, which depend on the length only."""
    wanted = np.floor(picks[:, None, :] * (3 * lengths)[None, :, None]).astype(np.int64)
    words = cgk(tokens, lengths, steps, wanted)
    key = np.zeros(words.shape[:2], np.uint64)
    for s in range(words.shape[2]):
        key = (key ^ (key >> np.uint64(31))) * MUL + words[:, :, s]
    return key


def _rows_of(sequences: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(sequences), width), np.uint64)
    for i, s in enumerate(sequences):
        out[i, : len(s)] = s
    return out


def _gram_hashes(h: np.ndarray, q: int) -> np.ndarray:
    acc = h[: max(0, len(h) - q + 1)].copy()
    for j in range(1, q):
        acc = (acc ^ (acc >> np.uint64(29))) * MUL + h[j : len(h) - q + 1 + j]
    return acc


def repeats_needed(tokens: np.ndarray, lengths: np.ndarray, edits: np.ndarray, recall: float, seed: int = 11) -> int:
    """Repeats after which an item with all its edits used is found with probability ``recall``, as measured
    on the items with random words replaced, dropped and added."""
    rng = np.random.default_rng(seed)
    changed = []
    for row, n, k in zip(tokens, lengths, edits):
        seq = list(row[:n])
        for _ in range(k):
            at, what = int(rng.integers(len(seq))), rng.integers(3)
            new = np.uint64(rng.integers(1 << 62) | 1)
            if what == 0 or (what == 1 and len(seq) == 1):
                seq[at] = new
            elif what == 1:
                del seq[at]
            else:
                seq.insert(at, new)
        changed.append(np.array(seq[:n], np.uint64))
    trial = 24
    steps = rng.integers(1 << 63, size=(trial, 3 * tokens.shape[1]), dtype=np.uint64) | np.uint64(1)
    picks = rng.random((trial, SAMPLED))
    same = _keys(tokens, lengths, steps, picks) == _keys(_rows_of(changed, tokens.shape[1]), lengths, steps, picks)
    rate = min(max(float(np.quantile(same.mean(0), 0.1)), 0.05), 0.99)
    return int(min(MAX_REPEATS, max(4, np.ceil(np.log(1 - recall) / np.log(1 - rate)))))


def make_block(items: list[tuple], share: float = MAX_EDITS, recall: float = TARGET_RECALL, seed: int = 3) -> Block | None:
    """From (id, text) of a benchmark.  Items without words can't be in a text and are left out."""
    hashes = WordHashes(key=_word_key)
    found = [(i, s) for i, t in items if len(s := sequence(t, hashes))]
    if not found:
        return None
    lengths = np.array([len(s) for _, s in found])
    tokens, edits = _rows_of([s for _, s in found], int(lengths.max())), allowed(lengths, share)
    postings: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for i, (_, s) in enumerate(found):
        q = int(max(1, min(MAX_GRAM, len(s) // (edits[i] + 1))))
        for o, g in enumerate(_gram_hashes(s, q).tolist()):
            postings[q][g].append((i, o))
    grams = {}
    for q, by in postings.items():
        names = np.array(sorted(by), np.uint64)
        lists = [by[int(g)] for g in names]
        grams[q] = (names, np.cumsum([0] + [len(x) for x in lists]), np.array([x for y in lists for x in y], np.int64))
    rng = np.random.default_rng(seed)
    repeats = repeats_needed(tokens, lengths, edits, recall)
    steps = rng.integers(1 << 63, size=(repeats, 3 * tokens.shape[1]), dtype=np.uint64) | np.uint64(1)
    picks = rng.random((repeats, SAMPLED))
    return Block([i for i, _ in found], tokens, lengths, edits, grams, steps, picks, _keys(tokens, lengths, steps, picks))


def find(seqs: list[np.ndarray], block: Block, chunk: int = 2000) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, first word of the window) of the best window of each item in each text."""
    lens = np.array([len(s) for s in seqs], np.int64)
    starts = np.concatenate(([0], np.cumsum(lens + 1)))
    flat = np.zeros(int(starts[-1]), np.uint64)  # a 0 between texts: no word hash is even
    for s, a in zip(seqs, starts):
        flat[a : a + len(s)] = s
    windows = []
    for q, (names, offsets, postings) in block.grams.items():
        g = _gram_hashes(flat, q)
        bits = np.zeros(1 << 18, bool)
        bits[names >> np.uint64(46)] = True
        pos = np.flatnonzero(bits[g >> np.uint64(46)])
        slot = np.searchsorted(names, g[pos])
        slot[slot == len(names)] = 0
        ok = names[slot] == g[pos]
        pos, slot = pos[ok], slot[ok]
        width = offsets[slot + 1] - offsets[slot]
        at = np.repeat(offsets[slot] - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
        item, off = postings[at, 0], postings[at, 1]
        p = np.repeat(pos, width)
        text = np.searchsorted(starts, p, "right") - 1
        windows.append(np.stack([text, item, p - starts[text] - off], 1))
    if not windows or not sum(map(len, windows)):
        return []
    found: dict[tuple[int, int], tuple[int, int]] = {}
    windows = np.unique(np.concatenate(windows), axis=0)
    for c in range(0, len(windows), chunk):
        text, item, begin = windows[c : c + chunk].T
        n = block.lengths[item]
        grid = np.arange(block.tokens.shape[1])[None, :]

        def cut(first, size, width, fill):
            at = first[:, None] + np.arange(width)[None, :]
            inside = (np.arange(width)[None, :] < size[:, None]) & (at >= 0) & (at < lens[text][:, None])
            return np.where(inside, flat[np.clip(at + starts[text][:, None], 0, max(0, len(flat) - 1))], np.uint64(fill))

        # windows that begin before the text are cut to it; the walk starts at their first word
        first = np.maximum(begin, 0)
        size = np.minimum(n, lens[text] - first)
        rows = cut(first, size, grid.shape[1], 0)
        near = (_keys(rows, n, block.steps, block.picks) == block.keys[:, item]).any(0)
        if not near.any():
            continue
        text, item, begin, n = text[near], item[near], begin[near], n[near]
        k = block.edits[item]
        segments = cut(begin - k, n + 2 * k, int((n + 2 * k).max()), 1 << 1)
        edits = edit_distance(block.tokens[item], n, segments)
        for t, i, e, b, most in zip(text.tolist(), item.tolist(), edits.tolist(), begin.tolist(), k.tolist()):
            if e <= most and (e, b) < found.get((t, i), (e + 1, 0)):
                found[t, i] = (e, b)
    return [(t, i, e, max(0, b)) for (t, i), (e, b) in sorted(found.items())]


def _matches(batches: Iterator[pa.RecordBatch], block: Block, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes(key=_word_key)
    for batch in pieces(batches, 2000):
        got = find([sequence(t, hashes) for t in batch.column(1).to_pylist()], block)
        of = pa.array([t for t, *_ in got], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(of), pa.array([block.ids[i] for _, i, *_ in got], kind), pa.array([e for *_, e, _ in got], pa.int64()), pa.array([int(block.lengths[i]) for _, i, *_ in got], pa.int64()), pa.array([b for *_, b in got], pa.int64())],
            ["doc_id", "item_id", "edits", "item_words", "first_word"])


def _clean(batches: Iterator[pa.RecordBatch], block: Block, at: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes(key=_word_key)
    for batch in pieces(batches, 2000):
        hit = {t for t, *_ in find([sequence(t, hashes) for t in batch.column(at).to_pylist()], block)}
        yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, **options) -> list[Block]:
    """The benchmark's items (item_id, text) in blocks of about ``block_words`` words at most, by a hash of the item."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-words // block_words))
    out = []
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        block = make_block(sorted(map(tuple, part.collect()), key=lambda x: (x[0] is None, x[0], x[1])), **options)
        out += [block] if block else []
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, edits, item_words, first_word: a row for each document and benchmark item found in it.

    edits: the least edit distance (in words) of the item to a run of the document, at most 0.2 of its
    words; first_word: where the best window begins.  Null and empty texts and items match nothing; a
    repeated row or item gives repeated rows; other columns aren't read; empty tables give no rows.
    """
    schema = "doc_id long, item_id long, edits long, item_words long, first_word long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in blocks(benchmark, **options):
        part = rows.mapInArrow(partial(_matches, block=block, kind=pa.int64()), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item was found, with all their columns."""
    at = docs.columns.index("text")
    for block in blocks(benchmark, **options):
        docs = docs.mapInArrow(partial(_clean, block=block, at=at), docs.schema)
    return docs
