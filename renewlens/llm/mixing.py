"""Mixing sources to target weights (operator 8).

Sizes are aggregated per source; targets follow from weights by water filling under a cap on
repetition; every document is emitted floor(rate) times plus one hash-seeded Bernoulli copy
with probability equal to the fraction.  A few seeds are tried per source in one aggregate and
the one whose copies come nearest to the target is used: all draws stay independent functions
of the row, and small sources don't miss their target by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.llm.common import WORD_PATTERN, fresh, stored

#: Weights by rank of the source, repeating.
WEIGHTS = (1, 2, 3)
CAP = 3
SEEDS = 16


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From (source, source_size), one row per source: adds target and rate.

    Sources by code point, null last, get the weights in turn.  A target over ``cap`` times its
    source is cut to that and the excess shared again by weight: sources are cut in the order of
    cap * size / weight, and the rest share what is left.  A source of size 0 has target and rate 0.
    The windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int")).cast("long"))
    full = F.col("source_size") * cap
    fill = Window.orderBy(full / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    below = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.col("total") - F.col("cut")) / (F.col("weights") - F.col("cut_weights")))
    cut = (weighed.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
           .withColumn("cut", F.coalesce(F.sum(full).over(below), F.lit(0))).withColumn("cut_weights", F.coalesce(F.sum("weight").over(below), F.lit(0)))
           .withColumn("level", level).withColumn("is_cut", full <= F.col("level") * F.col("weight")))
    # the first source that isn't cut sets the level of all that aren't
    share = F.min(F.when(~F.col("is_cut"), F.struct(full / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"), F.col("level")))).over(everything)["level"]
    target = F.when(F.col("is_cut"), full.cast("double")).otherwise(share * F.col("weight"))
    return (cut.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
            .select("source", "source_size", "target", "rate"))


def draw(seed: Column, key: Column) -> Column:
    """Uniform in [0, 1) from a seed and the row's key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", seed.cast("string"), key).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def row_key(id_col: str = "doc_id", text: str = "text") -> Column:
    """The document's id as text; without one, a digest of its text."""
    return F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """(documents as key, doc_id, source, size), (source, source_size, target, rate, seed): the mix's decisions."""
    base = stored(docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words().alias("size")), "sizes")
    rates = stored(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "rates")
    fraction = F.col("rate") - F.floor("rate")
    drawn = base.join(rates.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    taken = drawn.groupBy("source").agg(*[F.sum(F.when(draw(F.lit(i), F.col("key")) < fraction, F.col("size")).otherwise(0)).alias(f"t{i}") for i in range(seeds)])
    gap = rates.withColumnRenamed("source", "s").join(taken, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    miss = [F.struct(F.abs(F.col(f"t{i}") + F.floor("rate") * F.col("source_size") - F.col("target")).alias("miss"), F.lit(i).alias("seed")) for i in range(seeds)]
    best = gap.withColumn("seed", F.least(*miss)["seed"]).select("source", "source_size", "target", "rate", "seed")
    return base, stored(best, "seeds")


def copies(rate: Column, seed: Column, key: Column) -> Column:
    return (F.floor(rate) + F.when(draw(seed, key) < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    size: words of the text (null: 0).  A null source is a source of its own, ordered last.  Repeated
    rows are drawn alike (the draw depends on the id, or without one on the text).  An empty table
    gives no rows.
    """
    base, best = plan(docs, **options)
    n = copies(F.col("rate"), F.col("seed"), F.col("key"))
    return (base.join(best.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "source", "size", "source_size", "target", n.alias("copies"), (n * F.col("size")).cast("long").alias("taken")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns and ``copy`` (from 1;
    ``copy_`` if ``docs`` has such a column)."""
    _, best = plan(docs, **options)
    s, rate, seed, n, copy = (fresh(docs, x) for x in ("mix_source", "mix_rate", "mix_seed", "mix_copies", "copy"))
    best = best.select(F.col("source").alias(s), F.col("rate").alias(rate), F.col("seed").alias(seed))
    taken = docs.join(best, F.col("source").cast("string").eqNullSafe(F.col(s))).withColumn(n, copies(F.col(rate), F.col(seed), row_key()))
    return taken.where(F.col(n) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias(copy))


#: The same mix for DuckDB.
SQL = r"""
with base as (
  select coalesce(cast(doc_id as varchar), md5(coalesce(text, ''))) as key, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents),
sizes as (select source, cast(sum(size) as bigint) as source_size from base group by source),
ranked as (
  select *, 1 + (row_number() over (order by source is null, encode(source)) - 1) % 3 as weight from sizes),
summed as (
  select *, 3 * source_size as full_size, sum(source_size) over () as total, sum(weight) over () as weights,
         coalesce(sum(3 * source_size) over before, 0) as cut, coalesce(sum(weight) over before, 0) as cut_weights
  from ranked
  window before as (order by 3 * source_size / cast(weight as double), source is null, encode(source) rows between unbounded preceding and 1 preceding)),
levels as (
  select *, cast(total - cut as double) / cast(weights - cut_weights as double) as level from summed),
marked as (select *, full_size <= level * weight as is_cut from levels),
shared as (
  select *, first_value(level) over (order by is_cut, full_size / cast(weight as double), source is null, encode(source)) as share from marked),
rates as (
  select source, source_size, case when is_cut then cast(full_size as double) else share * weight end as target from shared),
rated as (select *, case when source_size > 0 then target / source_size else 0.0 end as rate from rates),
drawn as (
  select b.key, r.source, i as seed, b.size, rate, source_size, target,
         cast(cast('0x' || substr(md5(cast(i as varchar) || ':' || b.key), 1, 8) as bigint) as double) / 4294967296.0 as u
  from base b join rated r on b.source is not distinct from r.source, range(16) t(i)),
tried as (
  select source, seed, abs(sum(case when u < rate - floor(rate) then size else 0 end) + floor(any_value(rate)) * any_value(source_size) - any_value(target)) as miss
  from drawn group by source, seed),
best as (select source, arg_min(seed, (miss, seed)) as seed from tried group by source)
select b.doc_id, b.source, cast(b.size as bigint) as size, r.source_size, r.target,
       cast(floor(r.rate) + case when cast(cast('0x' || substr(md5(cast(s.seed as varchar) || ':' || b.key), 1, 8) as bigint) as double) / 4294967296.0 < r.rate - floor(r.rate) then 1 else 0 end as integer) as copies,
       cast((floor(r.rate) + case when cast(cast('0x' || substr(md5(cast(s.seed as varchar) || ':' || b.key), 1, 8) as bigint) as double) / 4294967296.0 < r.rate - floor(r.rate) then 1 else 0 end) * b.size as bigint) as taken
from base b join rated r on b.source is not distinct from r.source join best s on b.source is not distinct from s.source
"""
