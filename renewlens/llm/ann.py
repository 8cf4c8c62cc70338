"""Approximate nearest neighbours (operator 3): a forest of random-projection trees.

Trees are fitted on a bounded sample of the vectors; every vector is then indexed in one leaf of
each tree.  A query walks all trees through one shared priority queue, ordered by the least
margin on the way, and takes the leaves that come out first.  Leaves and the queries that
probe them meet by key, leaf candidates are ranked by exact distances, and the best of all
probed leaves are merged.  How many leaves a query probes is set by measuring recall against
brute force on the sample.

A leaf of more than ``chunk_rows`` rows (many equal vectors can't be told apart by any plane)
is dealt over several groups, each searched exactly, so no group grows with the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.llm.common import hash_below, int_array, stored

TREES = 3
LEAF_ROWS = 2048
SAMPLE_ROWS = 20_000
CHUNK_ROWS = 4096
TARGET_RECALL = 0.97


@dataclass
class Tree:
    """Inner nodes have a plane, a threshold and two children; a child below 0 is leaf -1 - child."""

    planes: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.planes) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", x[inner], self.planes[node]) >= self.thresholds[node]
            at[inner] = self.children[node, side.astype(int)]
        return -1 - at


def grow(x: np.ndarray, leaves: int, rng: np.random.Generator) -> Tree:
    """Split ``x`` at medians of projections on differences of two of its rows into about ``leaves`` leaves."""
    size = max(1, len(x) // max(1, leaves))
    planes, thresholds, children, n_leaves = [], [], [], 0

    def split(rows: np.ndarray) -> int:
        nonlocal n_leaves
        if len(rows) >= 2 * size:
            for _ in range(5):
                a, b = x[rng.choice(rows, 2, replace=False)]
                plane = a - b
                if not (norm := np.linalg.norm(plane)):
                    continue
                plane /= norm
                on = x[rows] @ plane
                cut = float(np.median(on))
                if (side := on >= cut).all():
                    cut = float(on[on > cut].min()) if (on > cut).any() else cut
                    side = on >= cut
                if side.any() and not side.all():
                    me = len(planes)
                    planes.append(plane)
                    thresholds.append(cut)
                    children.append([0, 0])
                    children[me] = [split(rows[~side]), split(rows[side])]
                    return me
        n_leaves += 1
        return -n_leaves

    split(np.arange(len(x)))
    width = x.shape[1]
    return Tree(np.array(planes).reshape(-1, width), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), n_leaves)


def probe(forest: list[Tree], q: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The first ``most`` leaves (tree, leaf) out of the shared queue, for one query."""
    margins = [t.planes @ q - t.thresholds for t in forest]
    queue = [(-np.inf, i, 0 if len(t.planes) else -1) for i, t in enumerate(forest)]
    out = []
    while queue and len(out) < most:
        worst, i, at = heapq.heappop(queue)
        while at >= 0:
            m = margins[i][at]
            near, far = forest[i].children[at][::-1] if m >= 0 else forest[i].children[at]
            heapq.heappush(queue, (max(worst, abs(m)), i, int(far)))
            at = int(near)
        out.append((i, -1 - at))
    return out


def nearest(q: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact k nearest rows of ``x`` but those with the query's own id: (ids, distances), ties to the smaller id."""
    keep = np.flatnonzero(ids != own)
    if not len(keep):
        return ids[:0], np.empty(0)
    d = np.sqrt(((x[keep] - q) ** 2).sum(1))
    if len(keep) > k:
        edge = np.partition(d, k - 1)[k - 1]
        close = d <= edge
        keep, d = keep[close], d[close]
    order = np.lexsort((ids[keep], d))
    got, first = np.unique(ids[keep][order], return_index=True)
    first = np.sort(first)[:k]
    return ids[keep][order][first], d[order][first]


def probes_for(forest: list[Tree], x: np.ndarray, k: int, recall: float, tries: int = 100, seed: int = 17) -> int:
    """The least number of probed leaves (by steps of a fifth) with the wanted recall on ``x`` itself."""
    rng = np.random.default_rng(seed)
    total = sum(t.leaves for t in forest)
    queries = rng.choice(len(x), min(tries, len(x)), replace=False)
    leaf = [t.leaf_of(x) for t in forest]
    # the rank, in the order of probing, of the first leaf that holds each true neighbour
    ranks = []
    for i in queries:
        order = {key: r for r, key in enumerate(probe(forest, x[i], total))}
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        true = np.argsort(d, kind="stable")[: min(k, len(x) - 1)]
        ranks += [min(order[t, int(leaf[t][j])] for t in range(len(forest))) for j in true]
    if not ranks:
        return total
    return min(total, int(np.quantile(ranks, recall, method="higher")) + 1)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _leaves(batches: Iterator[pa.RecordBatch], forest: list[Tree], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _vectors(batch.column(1), width)
        for i, tree in enumerate(forest):
            yield pa.RecordBatch.from_arrays([batch.column(0), int_array(np.full(len(x), i)), int_array(tree.leaf_of(x)), batch.column(1)], ["vec_id", "tree", "leaf", "x"])


def _probes(batches: Iterator[pa.RecordBatch], forest: list[Tree], width: int, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [probe(forest, q, most) for q in _vectors(batch.column(1), width)]
        of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
        flat = np.array([p for f in found for p in f], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(of), int_array(flat[:, 0]), int_array(flat[:, 1]), batch.column(1).take(of)], ["query_id", "tree", "leaf", "q"])


def _rank(rows: pa.Table, queries: pa.Table, width: int, k: int) -> pa.Table:
    ids, x = rows["vec_id"].to_numpy(), _vectors(rows["x"], width)
    out = []
    for qid, q in zip(queries["query_id"].to_pylist(), _vectors(queries["q"], width)):
        got, d = nearest(q, qid, x, ids, k)
        out.append((np.full(len(got), qid), got, d))
    if not out:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    a, b, d = (np.concatenate(c) for c in zip(*out))
    return pa.table({"query_id": int_array(a), "vec_id": int_array(b), "score": pa.array(d, pa.float64())})


def usable(vector: str) -> Column:
    """Vectors that aren't null, empty, zero, and hold no null or non-finite component."""
    big = F.lit(float("inf"))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == big))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda v: v != 0)


def search(vectors: DataFrame, queries: Column, k: int = 10, trees: int = TREES, leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS, chunk_rows: int = CHUNK_ROWS, recall: float = TARGET_RECALL, seed: int = 1) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, nearest first.

    vectors: (vec_id, embedding); ``queries`` is true for rows that are queries.  score is the Euclidean
    distance in double precision; ties go to the smaller vec_id; a query's own id is no candidate; all
    candidates are returned if there are fewer than k.  Rows with a null id, and vectors that are null,
    empty, zero or hold a null or non-finite component, take no part, nor do those of another length than
    most (of equally many, the longest).  Repeated ids count once, by their nearest vector.  An empty table
    gives no rows.  Other columns aren't read.

    ``sample_rows`` bounds the rows that the trees are fitted on (chosen by a hash of the id).
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    named = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"), F.coalesce(queries, F.lit(False)).alias("is_query")).where(usable("x"))
    shape = named.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if shape is None:
        return spark.createDataFrame([], schema)
    width, n = shape
    rows = named.where(F.size("x") == width)
    taken = rows.where(hash_below(sample_rows / n, "vec_id")).select("vec_id", "x").toArrow().sort_by("vec_id")
    sample = _vectors(taken["x"], width)
    leaves = max(1, min(n // leaf_rows, len(sample) // 32))
    rng = np.random.default_rng(seed)
    forest = [grow(sample, leaves, rng) for _ in range(trees if leaves > 1 else 1)]
    most = probes_for(forest, sample, k, recall)

    indexed = rows.select("vec_id", "x").mapInArrow(partial(_leaves, forest=forest, width=width), "vec_id long, tree long, leaf long, x array<double>")
    asked = rows.where("is_query").select("vec_id", "x").mapInArrow(partial(_probes, forest=forest, width=width, most=most), "query_id long, tree long, leaf long, q array<double>")
    # as many rows as the forest has leaves
    parts = stored(indexed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks")), "leaves")
    dealt = indexed.join(F.broadcast(parts), ["tree", "leaf"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    spread = asked.join(F.broadcast(parts), ["tree", "leaf"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    key = ["tree", "leaf", "chunk"]
    found = (dealt.select(*key, "vec_id", "x").groupBy(*key).cogroup(spread.select(*key, "query_id", "q").groupBy(*key))
             .applyInArrow(partial(_rank, width=width, k=k), "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
