"""Helpers shared by the operators: stored tables, word hashes, Arrow columns, components."""

from __future__ import annotations

import contextlib
import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.session import checkpoint_dir

#: Words of the contracts: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage where a table has several readers or ends a round of a loop; the files
    are on shared storage, so a lost executor costs no recomputation of what came before.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Let Spark's cleaner drop the shuffle files of steps that are stored by now: it does so once the
    driver's JVM has collected the plans, which Python's unreachable frames and events that wait for
    their listeners still hold.  Without a JVM at hand (Spark Connect), nothing happens."""
    sc = getattr(df.sparkSession, "_sc", None)
    if getattr(sc, "_jvm", None) is not None:
        with contextlib.suppress(Py4JJavaError):    # too many events in the time given
            sc._jsc.sc().listenerBus().waitUntilEmpty(5_000)
        gc.collect()
        for _ in range(2):    # the first finds the plans, the second what only they held
            sc._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that no later step reads.  Without a JVM at hand they stay."""
    sc = getattr(df.sparkSession, "_sc", None)
    if getattr(sc, "_jvm", None) is not None:
        for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def hash_below(fraction: float | Column, *cols) -> Column:
    """True for about ``fraction`` of the rows, decided by a hash of ``cols``."""
    return F.pmod(F.xxhash64(F.lit(0x5EED), *cols), F.lit(1 << 30)) < F.lit(fraction) * (1 << 30)


class WordHashes(dict):
    """word -> 64-bit hash.  Emptied when it holds ``limit`` words, so its memory is bounded."""

    def __init__(self, limit: int = 150_000, key=None):
        super().__init__()
        self.limit, self.key = limit, key or xxhash.xxh3_64_intdigest

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.key(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that what a worker derives at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(column: pa.Array) -> list:
    """A string column as bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def int_array(values, mask=None, kind=None) -> pa.Array:
    return pa.array(np.asarray(values, np.int64), type=kind or pa.int64(), mask=mask)


#: Bits of one row of a filter.
ROW_BITS = 1 << 15


def key_filter(keys: DataFrame, most_bits: int = 1 << 27) -> tuple[DataFrame, int]:
    """A one-hash Bloom filter of the column ``key`` (long): rows (bucket, bits) and its number of bits.

    At least 64 bits a key, but never more than ``most_bits`` (16 MB by default), which bounds what is
    broadcast; with more keys than that is good for, the filter lets more rows through, and the exact
    join behind it has more to do.
    """
    n, bits = keys.count(), ROW_BITS
    while bits < min(64 * n, most_bits):
        bits *= 2
    at = keys.select(F.pmod("key", F.lit(bits)).alias("at"))
    rows = at.select(F.floor(F.col("at") / ROW_BITS).alias("bucket"), (F.col("at") % ROW_BITS).alias("pos"))
    return stored(rows.groupBy("bucket").agg(F.bitmap_construct_agg("pos").alias("bits")), "filter"), bits


def with_filter(df: DataFrame, key: str, found: tuple[DataFrame, int], flag: str) -> DataFrame:
    """``df`` with a column ``flag``: false only for rows whose ``key`` is not in the filter."""
    table, bits = found
    bucket, mask, at = (fresh(df, x) for x in ("filter_bucket", "filter_bits", "filter_at"))
    table = table.select(F.col("bucket").alias(bucket), F.col("bits").alias(mask))
    placed = df.withColumn(at, F.pmod(key, F.lit(bits)))
    both = placed.join(F.broadcast(table), F.floor(F.col(at) / ROW_BITS) == F.col(bucket), "left")
    byte = f"cast(conv(hex(substring(`{mask}`, cast((`{at}` % {ROW_BITS}) div 8 as int) + 1, 1)), 16, 10) as int)"
    test = F.expr(f"coalesce((shiftright({byte}, cast(`{at}` % 8 as int)) & 1) = 1, false)")
    return both.withColumn(flag, test).drop(bucket, mask, at)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, root), root the least node.

    Alternates large-star and small-star steps until the edges are stars.  Every step is a
    partial aggregate (the least neighbour) and an equi-join that AQE can split at a hub; each
    round is stored, and only a count and a checksum of it reach the driver.  Nodes without an
    edge to another node don't appear.  No rows in, no rows out.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where("u is not null and v is not null and u <> v").distinct(), "edges")

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first())

    before = mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = stored(small, "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
