"""Repeated substrings (operator 13): merged Burrows-Wheeler transforms of the texts that may repeat.

A string of ``span`` bytes that starts at two places has the same least-hashed gram of ``gram`` bytes at
both, its anchor.  So texts are cut at anchors: a piece has all windows of ``span`` bytes that one anchor serves,
every window lies in one piece, and equal windows lie in pieces with equal anchors.  Anchors that occur once are
dropped before any text moves.  The pieces of an anchor are read as words of eight bytes, counted
from the anchor, so that equal windows are cut alike, and dealt over shards.  Each shard has its suffixes sorted
and keeps its Burrows-Wheeler transform; two transforms are merged by refining their interleave word by word, never
sorting suffixes again.  The depth at which neighbours part is their common prefix; rows of an interval with a long
enough common prefix whose preceding bytes (the transform's own words) also agree are equal windows.

Equal texts count as one that occurs twice, and so do equal pieces: of those one is merged with the anchor's other
pieces, if it has any.  An anchor with more than ``most_pieces`` different pieces (a passage that a third of all texts
hold in other surroundings) doesn't go to one task: its windows are counted one by one, by their 128-bit hashes,
as a grouped sum.  Where rows meet the count of their key, keys of many rows are spread over several salts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import int_array, pieces, signed, stored

SPAN = 200
#: Different pieces of one anchor that a task merges at most (some 1.5 MB).
MOST_PIECES = 4096
#: Bytes of pieces that a task merges at once, at least one anchor.
CHUNK_BYTES = 1 << 21
SHARDS = 2
#: Keys with more rows than this are spread; a broadcast table holds at most MOST_HOT of them, as the bound rises with
#: the number of all rows.
SPREAD_ROWS = 1000
MOST_HOT = 50_000
WORD = 8
_BLOCK = 1 << 18
_NEVER = 1 << 30


# --- anchors ------------------------------------------------------------------------------------------

@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number a byte value, and n powers of an odd number and of its inverse."""
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)))) for b in (base, pow(base, -1, 1 << 64)))
    return np.random.default_rng(13).integers(0, 1 << 64, 256, np.uint64), up, down


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from each position of a block on."""
    value, up, down = _powers(_BLOCK + 4096)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[data] * down[: len(data)])))
        x = (sums[k:] - sums[:-k]) * up[: len(data) - k + 1]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    size, out = 1, x
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - size :]) if size < width else out


def anchors(data: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """text number, hash, first and last window and the anchor's place of each piece of texts laid end to end.

    The anchor of a window is the leftmost gram with the least hash in it, which depends on its bytes alone.
    """
    n = len(data) - span + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    low = np.uint64((1 << 24) - 1)
    before, runs = (-1, -1), []
    # block by block, only where the anchor or the text changes is kept
    for b in range(0, n, _BLOCK - span):
        part = data[b : min(b + _BLOCK - 1, len(data))]
        g = gram_hashes(part, gram)
        place = _least((g & ~low) | np.arange(len(g), dtype=np.uint64), span - gram + 1)[: _BLOCK - span] & low
        place = place.astype(np.int64)
        starts = np.arange(b, b + len(place))
        text = np.searchsorted(offsets, starts, "right") - 1
        text[starts + span > offsets[text + 1]] = -1  # reaches into the next text
        new = np.empty(len(place), bool)
        new[0] = (place[0] + b, text[0]) != before
        new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        before = int(place[-1]) + b, int(text[-1])
        k = np.flatnonzero(new)
        runs.append((starts[k], place[k] + b, text[k], g[place[k]]))
    first, at, text, hashes = (np.concatenate(c) for c in zip(*runs))
    last = np.append(first[1:], n) - 1
    k = np.flatnonzero(text >= 0)
    t, first, last = text[k], first[k], last[k]
    return t, hashes[k], first - offsets[t], last - offsets[t], at[k] - first


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def _anchor_rows(batches: Iterator[pa.RecordBatch], span: int, gram: int) -> Iterator[pa.RecordBatch]:
    """One row a piece: its anchor's hash, and two halves of a hash of its bytes."""
    for batch in pieces(batches, 500):
        data, offsets = _buffers(batch.column(1))
        t, h, first, last, place = anchors(data, offsets, span, gram)
        raw, begin = memoryview(data), offsets[t] + first
        whole = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(begin.tolist(), (offsets[t] + last + span).tolist())]
        halves = np.frombuffer(b"".join(whole), np.int64).reshape(-1, 2)
        of = pa.array(t)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(of), batch.column(2).take(of), int_array(signed(h)), int_array(halves[:, 0]), int_array(halves[:, 1]),
             int_array(first), int_array(last), int_array(place)], ["tid", "weight", "h", "p1", "p2", "first", "last", "place"])


def _pieces(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each piece of a text; pieces of hot anchors as their single windows, with a hash and no bytes."""
    names = ["k1", "k2", "tid", "first", "place", "twice", "piece"]
    for batch in pieces(batches, 200):
        out, size = [[] for _ in names], 0
        for tid, text, found in zip(*(c.to_pylist() for c in batch.columns)):
            for f in found:
                a, b = f["first"], f["last"]
                if not f["hot"]:
                    rows = [(f["h"], 0, tid, a, f["place"], f["twice"], text[a : b + span])]
                else:
                    rows = []
                    for p in range(a, b + 1):
                        high, low = divmod(xxhash.xxh3_128_intdigest(text[p : p + span]), 1 << 64)
                        rows.append((high - (1 << 63), low - (1 << 63), tid, p, None, f["twice"], None))
                for row in rows:
                    for column, value in zip(out, row):
                        column.append(value)
                size += len(rows) * 32 + (b - a + span)
            if size > 1 << 23:
                yield _piece_batch(out, names)
                out, size = [[] for _ in names], 0
        if out[0]:
            yield _piece_batch(out, names)


def _piece_batch(out: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


# --- transforms ---------------------------------------------------------------------------------------

@dataclass
class Shard:
    """Suffixes of some pieces in order, and the transform.  Row arrays have an element a suffix.

    ``text`` has the words of all pieces, each piece ended by one word of zeros; ``row`` is a suffix's place in it and
    ``rest`` the number of words up to the piece's end; ``follow`` is the row of the suffix one word shorter (-1: empty);
    ``before`` the eight bytes that precede it, last byte first; ``piece`` and ``at`` say where it starts;
    ``parted`` is the depth in words at which a row first differs from the row before.
    """

    text: np.ndarray
    row: np.ndarray
    rest: np.ndarray
    follow: np.ndarray
    before: np.ndarray
    piece: np.ndarray
    at: np.ndarray
    parted: np.ndarray | None = None

    @property
    def first(self) -> np.ndarray:
        return self.text[self.row]


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def transform(data: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray, number: np.ndarray, depth: int) -> Shard:
    """The shard of pieces at ``start`` in ``data`` (with 8 more bytes at both ends), suffixes sorted by ``depth`` words."""
    shift = place % WORD
    words = -(-(length - shift) // WORD)
    size = words + 1
    n, total = len(start), int(size.sum())
    piece = np.repeat(np.arange(n), size)
    begin = np.cumsum(size) - size
    j = np.arange(total) - begin[piece]
    at = shift[piece] + WORD * j
    real = j < words[piece]
    view = np.ndarray((len(data) - WORD + 1,), ">u8", buffer=data, strides=(1,))
    text = np.zeros(total, np.uint64)
    text[real] = view[(start[piece] + at)[real]]
    over = at + WORD - length[piece]
    tail = np.flatnonzero(real & (over > 0))
    cut = (over[tail] * 8).astype(np.uint64)
    text[tail] = (text[tail] >> cut) << cut
    # ranks by 1, 2, 4, ... words, then by depth: two overlapping halves
    end = (begin + words)[piece]
    rank = np.zeros(total, np.int64)
    rank[real] = _dense(text[real]) + 1
    known, places = 1, np.arange(total)
    while known < depth:
        step = min(known, depth - known)
        beyond = np.minimum(places + step, end)
        rank[real] = _dense((rank << 32 | np.where(places + step < end, rank[beyond], 0))[real]) + 1
        known += step
    row = np.flatnonzero(real)
    row = row[np.argsort(rank[row], kind="stable")]
    position = np.full(total, -1, np.int64)
    position[row] = np.arange(len(row))
    little = np.ndarray((len(data) - WORD + 1,), "<u8", buffer=data, strides=(1,))
    before = little[(start[piece] + at - WORD)[row]].astype(np.uint64)
    return Shard(text, row, (end - places)[row], position[row + 1], before, number[piece[row]], at[row])


def merge(a: Shard, b: Shard, depth: int) -> Shard:
    """Both shards' suffixes in one order by ``depth`` words.

    The rows of a shard never change their order; what is refined is which of them come between which of the
    other's.  After t rounds the interleave is right for the first t words: a row's key is its first word and
    the class of its follower, i.e. the words after it, so the rows of each class are followed back by one
    word, as the transform has it.  Where two neighbours part for the first time is noted.
    """
    alphabet = np.unique(np.concatenate((a.text[a.row], b.text[b.row])))
    n = len(a.row) + len(b.row)
    word = [np.searchsorted(alphabet, s.first) << 32 for s in (a, b)]
    classes = [np.ones(len(s.row), np.int64) for s in (a, b)]
    parted = np.full(n, _NEVER, np.int64)
    parted[:1] = 0
    count, mine, theirs = 1, None, None
    for t in range(1, depth + 1):
        end = int(t == 1)  # no words yet: an ended suffix is like any other; later it comes first
        keys = [w | np.append(c, end)[s.follow] for w, c, s in zip(word, classes, (a, b))]
        theirs = np.searchsorted(keys[0], keys[1], "right") + np.arange(len(keys[1]))
        free = np.ones(n, bool)
        free[theirs] = False
        mine = np.flatnonzero(free)
        both = np.empty(n, np.int64)
        both[mine], both[theirs] = keys
        new = np.empty(n, bool)
        new[:1] = True
        np.not_equal(both[1:], both[:-1], out=new[1:])
        parted[new & (parted == _NEVER)] = t
        number = np.cumsum(new)
        classes = [number[mine], number[theirs]]
        if number[-1] == count and t > 1:
            break
        count = number[-1]

    def dealt(x, y):
        out = np.empty(n, x.dtype)
        out[mine], out[theirs] = x, y
        return out

    follow = [np.where(s.follow < 0, -1, to[s.follow]) for s, to in ((a, mine), (b, theirs))]
    return Shard(np.concatenate((a.text, b.text)), dealt(a.row, b.row + len(a.text)), dealt(a.rest, b.rest), dealt(*follow),
                 dealt(a.before, b.before), dealt(a.piece, b.piece), dealt(a.at, b.at), parted)


def common_bytes(s: Shard) -> np.ndarray:
    """How many bytes each row of a merged shard has in common with the row before, up to the depth merged by."""
    n = len(s.row)
    out = np.full(n, _NEVER, np.int64)
    out[:1] = 0
    k = np.flatnonzero(s.parted[1:] < _NEVER) + 1
    off = s.parted[k] - 1
    x = np.where(off < s.rest[k], s.text[s.row[k] + np.minimum(off, s.rest[k])], 0)
    y = np.where(off < s.rest[k - 1], s.text[s.row[k - 1] + np.minimum(off, s.rest[k - 1])], 0)
    differ = (x ^ y).astype(">u8").view(np.uint8).reshape(-1, WORD) != 0
    out[k] = off * WORD + np.where(differ.any(1), differ.argmax(1), WORD)
    return out


def repeated_windows(s: Shard, length: np.ndarray, twice: np.ndarray, span: int) -> np.ndarray:
    """True for each window (of all pieces, laid end to end) whose bytes also start elsewhere.

    A window starts 0 to 7 bytes before a suffix: it is repeated if the suffix shares an interval of the remaining
    bytes' length with another one, and the bytes before, in the transform's word, agree as well.
    """
    begin = np.concatenate(([0], np.cumsum(length - span + 1)))
    out = np.zeros(begin[-1], bool)
    prefix = common_bytes(s)
    near = np.zeros(len(prefix), bool)
    close = prefix >= span - WORD + 1
    near |= close
    near[:-1] |= close[1:]
    near |= twice[s.piece]
    keep = np.flatnonzero(near & (s.at - WORD < length[s.piece] - span + 1))
    piece, at = s.piece[keep], s.at[keep]
    order = np.argsort(s.before[keep], kind="stable")
    ranked = s.before[keep][order]
    for d in range(WORD):
        interval = np.cumsum(prefix < span - d)[keep]
        same = np.zeros(len(keep), np.int64)
        if d:
            tops = ranked >> np.uint64(64 - 8 * d)
            same[order[1:]] = np.cumsum(tops[1:] != tops[:-1])
        rows = np.flatnonzero((at >= d) & (at - d <= length[piece] - span))
        if not len(rows):
            continue
        _, group, count = np.unique(interval[rows] << 32 | same[rows], return_inverse=True, return_counts=True)
        again = (count + np.bincount(group, twice[piece[rows]], len(count)) > 1)[group]
        hit = rows[again]
        out[begin[piece[hit]] + at[hit] - d] = True
    return out


def repeats_of(data: np.ndarray, offsets: np.ndarray, place: np.ndarray, twice: np.ndarray, span: int, shards: int = SHARDS) -> np.ndarray:
    """Windows repeated among pieces (bytes laid end to end): the pieces' shards, merged two by two."""
    padded = np.zeros(len(data) + 2 * WORD, np.uint8)
    padded[WORD:-WORD] = data
    length, depth = np.diff(offsets), -(-span // WORD)
    numbers = [np.arange(i, len(length), shards) for i in range(min(shards, len(length)))]
    line = [transform(padded, offsets[:-1][x] + WORD, length[x], place[x], x, depth) for x in numbers]
    if len(line) == 1:
        line.append(transform(padded, *(np.empty(0, np.int64) for _ in range(4)), depth))
    while len(line) > 1:
        line = [merge(*line[i : i + 2], depth) if i + 1 < len(line) else line[i] for i in range(0, len(line), 2)]
    return repeated_windows(line[0], length, twice, span)


def _merged(batches: Iterator[pa.RecordBatch], span: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of pieces that come sorted by anchor, some whole anchors at a time."""
    held: list[pa.RecordBatch] = []

    def solved(table: pa.Table) -> pa.RecordBatch:
        batch = table.combine_chunks().to_batches()[0]
        data, offsets = _buffers(batch.column("piece"))
        tid, first = (batch.column(c).to_numpy() for c in ("tid", "first"))
        twice = batch.column("twice").to_numpy(zero_copy_only=False)
        hit = repeats_of(data, offsets, batch.column("place").to_numpy(), twice, span)
        windows = np.diff(offsets) - span + 1
        piece = np.repeat(np.arange(len(windows)), windows)
        at = np.arange(len(piece)) - (np.cumsum(windows) - windows)[piece]
        use = np.flatnonzero(hit & ~twice[piece])
        new = np.ones(len(use), bool)
        new[1:] = (np.diff(use) != 1) | (np.diff(piece[use]) != 0)
        starts = use[new]
        ends = use[np.append(new[1:], True)] if len(use) else use
        return pa.RecordBatch.from_arrays([int_array(tid[piece[starts]]), int_array(first[piece[starts]] + at[starts]), int_array(first[piece[ends]] + at[ends])], ["tid", "first", "last"])

    size = 0
    for batch in pieces(batches, 2000):
        held.append(batch)
        size += batch.nbytes
        if size >= chunk:
            table = pa.Table.from_batches(held)
            keys = table.column("k1").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield solved(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held) if cut else 0
    if held and sum(b.num_rows for b in held):
        yield solved(pa.Table.from_batches(held))


# --- tables -------------------------------------------------------------------------------------------

def recurring(rows: DataFrame, keys: list[str], spread_rows: int, weight: str | None = None) -> DataFrame:
    """The stored ``rows`` whose ``keys`` occur twice at least (by the sum of ``weight``), with ``rows_``, the rows of their keys.

    Keys of many rows are dealt over salts, so that no task gets more than about ``spread_rows`` of them (more
    only where there are over MOST_HOT times as many rows).
    """
    limit = max(spread_rows, rows.count() // MOST_HOT)
    total = F.count("*") if weight is None else F.sum(weight)
    counts = stored(rows.groupBy(*keys).agg(F.count("*").alias("rows_"), total.alias("times_")).where("times_ > 1"), "counts")
    salts = F.ceil(F.col("rows_") / limit).cast("int")
    hot = counts.where(F.col("rows_") > limit).select(*keys, salts.alias("salts_"))
    salted = counts.select(*keys, "rows_", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt_"))
    dealt = rows.join(F.broadcast(hot), keys, "left")
    # a row's number tells repeated rows apart, and is the same when a task reads its files again
    dealt = dealt.withColumn("salt_", F.pmod(F.monotonically_increasing_id(), F.coalesce("salts_", F.lit(1))).cast("int"))
    return dealt.join(salted, [*keys, "salt_"]).select(*rows.columns, "rows_")


def _union(found: list[dict], span: int) -> list[tuple[int, int]]:
    """Maximal byte spans under runs of windows."""
    out: list[tuple[int, int]] = []
    for f in sorted(found, key=lambda f: f["first"]):
        a, b = f["first"], f["last"] + span
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 200):
        spans, kept = [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            cut = _union(found or [], span)
            edges = [0, *(x for s in cut for x in s), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if cut else text)
            spans.append([{"start": a, "end": b} for a, b in cut])
        sizes = [len(t) for t in batch.column(1).to_pylist()]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), int_array(sizes), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int | None = None, most_pieces: int = MOST_PIECES, chunk_bytes: int = CHUNK_BYTES,
                   spread_rows: int = SPREAD_ROWS) -> DataFrame:
    """doc_id, n_bytes, spans (start, end) and kept (binary) of each row.

    docs: (doc_id, text).  Texts count as UTF-8 bytes; ``spans`` are the maximal runs of bytes that lie under a
    string of ``span`` bytes that also starts elsewhere, in this or another row, overlapping or not; ``kept``
    are the others.  Null and empty texts, and those shorter than ``span``, have no spans (null: no bytes).  Rows with
    equal texts, repeated ids and rows included, repeat each other; ids may be null.  An empty table gives
    no rows.  Other columns aren't read.  Strings are compared byte by byte, but whole pieces, and strings under
    hot anchors, are equal if their 128-bit hashes are, and texts if their SHA-256 is.
    """
    gram = max(2, span // 5) if gram is None else gram
    if span < 2 * WORD or gram >= span:
        raise ValueError("span is 16 bytes at least, and longer than a gram")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    no_spans = F.array().cast("array<struct<start:long,end:long>>")
    short = rows.where(F.col("n_bytes") < span).select("doc_id", "n_bytes", no_spans.alias("spans"), F.col("text").alias("kept"))
    long = rows.where(F.col("n_bytes") >= span).withColumn("fp", F.unhex(F.sha2("text", 256)))

    narrow = stored(long.select("doc_id", "n_bytes", "fp"), "long")
    copies = recurring(narrow, ["fp"], spread_rows).select(
        "doc_id", "n_bytes", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans"), F.lit(b"").alias("kept"))

    one = F.first(F.struct("doc_id", "text"))
    texts = long.groupBy("fp").agg(one.alias("one"), F.least(F.count("*"), F.lit(2)).alias("weight")).select("one.doc_id", "one.text", "weight")
    texts = stored(texts.withColumn("tid", F.monotonically_increasing_id()), "texts")
    found = texts.select("tid", "text", "weight").mapInArrow(
        partial(_anchor_rows, span=span, gram=gram), "tid long, weight long, h long, p1 long, p2 long, first long, last long, place long")
    again = stored(recurring(stored(found, "anchors"), ["h"], spread_rows).drop("rows_"), "again")

    # equal pieces: each of their windows is repeated
    equal = recurring(again, ["p1", "p2"], spread_rows, "weight").where("weight = 1").select("tid", "first", "last")
    kinds = again.groupBy("p1", "p2").agg(F.first("h").alias("h"), (F.sum("weight") > 1).alias("twice"), F.min(F.struct("tid", "first", "last", "place")).alias("one"))
    kinds = stored(kinds.select("h", "twice", "one.*"), "kinds")
    merged = recurring(kinds, ["h"], spread_rows).withColumn("hot", F.col("rows_") > most_pieces)
    lists = merged.groupBy("tid").agg(F.collect_list(F.struct("h", "first", "last", "place", "twice", "hot")).alias("found"))
    cut = stored(texts.select("tid", "text").join(lists, "tid").select("tid", "text", "found")
                 .mapInArrow(partial(_pieces, span=span), "k1 long, k2 long, tid long, first long, place long, twice boolean, piece binary"), "pieces")

    runs = (cut.where("piece is not null").repartition("k1").sortWithinPartitions("k1").select("k1", "tid", "first", "place", "twice", "piece")
            .mapInArrow(partial(_merged, span=span, chunk=chunk_bytes), "tid long, first long, last long")).unionByName(equal)
    single = cut.where("piece is null").select("k1", "k2", "tid", "first", "twice", F.when(F.col("twice"), 2).otherwise(1).alias("weight"))
    if not single.isEmpty():
        seen = recurring(stored(single, "windows"), ["k1", "k2"], spread_rows, "weight")
        runs = runs.unionByName(seen.where("not twice").select("tid", "first", F.col("first").alias("last")))
    marked = runs.groupBy("tid").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    single_texts = texts.where("weight = 1").join(marked, "tid", "left").select("doc_id", "text", "runs")
    rest = single_texts.mapInArrow(partial(_kept, span=span), f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return short.unionByName(copies).unionByName(rest)
