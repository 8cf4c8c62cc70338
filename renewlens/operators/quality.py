"""Data-quality reports, drift and calibration.

Global statistics are computed by one aggregate and attached as scalar
subqueries (``DataFrame.scalar()``), so no row is joined against all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens import config


#: Buckets of distinct values, and sampled values per bucket: what a cut costs per value and task stays bounded.
MOST_BUCKETS = 64
SAMPLE_PER_BUCKET = 32


def balanced_buckets(distinct: DataFrame, group_col: str, value_col: str, parts: int, out: str = "_pid") -> DataFrame:
    """``distinct`` (one row per group and value) with the number of the value's bucket in its group.

    Buckets are ranges of about equally many distinct values, whatever the values' spread, cut at a sample of
    them: those with the least hashes.  The sample depends on the set of values alone, so a value's bucket
    is the same however often and wherever it is computed.
    """
    from pyspark.sql import Window

    least = Window.partitionBy(group_col).orderBy("_hash", value_col)
    sample = (distinct.select(group_col, value_col, F.xxhash64(value_col).alias("_hash")).withColumn("_i", F.row_number().over(least))
              .filter(F.col("_i") <= parts * SAMPLE_PER_BUCKET).groupBy(group_col).agg(F.sort_array(F.collect_list(value_col)).alias("_sample")))
    each = F.sequence(F.lit(1), F.lit(parts - 1)) if parts > 1 else F.array().cast("array<int>")
    cut = lambda i: F.get("_sample", F.floor(i * F.size("_sample") / parts).cast("int"))
    cuts = sample.select(group_col, F.array_distinct(F.transform(each, cut)).alias("_cuts"))
    # one row per group, i.e. per reported column
    both = distinct.join(F.broadcast(cuts), group_col)
    return both.withColumn(out, F.size(F.filter("_cuts", lambda c: c <= F.col(value_col)))).drop("_cuts")


def exact_quantiles(long: DataFrame, group_col: str, value_col: str, qs: Sequence[float],
                    num_partitions: int | None = None, method: str = "nearest") -> DataFrame:
    """Exact quantiles per group, computed distributedly.

    ``nearest``: the smallest value v with at least ``ceil(q * n)`` non-null values <= v.
    ``linear``: interpolation between the values at 0-based positions floor/ceil of
    ``(n - 1) * q`` (the usual continuous median / ``percentile``).

    No single-task buffer and no hot value: rows are first collapsed to
    (group, value) -> count with a partial aggregate (a value held by a third of the
    rows becomes one row per map task); the distinct values fall into buckets of about equal numbers of them,
    cut at a sample of them; a per-bucket total (one row per (group, bucket)) turns each target rank into
    (bucket, local rank); running counts inside each bucket give every distinct
    value its rank interval, and the value whose interval holds the target is picked.
    Returns (group_col, q, value).
    """
    from pyspark.sql import Window

    spark = long.sparkSession
    parts = min(num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    v = long.select(F.col(group_col), F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    vc = v.groupBy(group_col, "_v").agg(F.count(F.lit(1)).alias("_cnt"))
    ranged = balanced_buckets(vc, group_col, "_v", parts)
    totals = ranged.groupBy(group_col, "_pid").agg(F.sum("_cnt").alias("_c"))
    w = Window.partitionBy(group_col).orderBy("_pid")
    offsets = totals.select(group_col, "_pid", "_c",
                            (F.sum("_c").over(w) - F.col("_c")).alias("_off"),
                            F.sum("_c").over(Window.partitionBy(group_col)).alias("_n"))
    # one row per (group, partition, quantile, bound): explode the literal lists, no join
    t = offsets.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    if method == "nearest":
        t = t.withColumn("_bound", F.lit("lo")).withColumn(
            "_rank", F.greatest(F.ceil(F.col("q") * F.col("_n")), F.lit(1)))
    elif method == "linear":
        pos = (F.col("_n") - 1) * F.col("q")
        t = (t.withColumn("_bound", F.explode(F.array(F.lit("lo"), F.lit("hi"))))
             .withColumn("_rank", F.when(F.col("_bound") == "lo", F.floor(pos)).otherwise(F.ceil(pos)) + 1)
             .withColumn("_frac", pos - F.floor(pos)))
    else:
        raise ValueError(method)
    targets = (t.filter((F.col("_rank") > F.col("_off")) & (F.col("_rank") <= F.col("_off") + F.col("_c")))
               .withColumn("_local", F.col("_rank") - F.col("_off"))
               .select(group_col, "_pid", "_local", "q", "_bound", *(["_frac"] if method == "linear" else [])))
    # rank interval [start, end] of each distinct value inside its range partition
    wl = Window.partitionBy(group_col, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_end", F.sum("_cnt").over(wl)).withColumn("_start", F.col("_end") - F.col("_cnt") + 1)
    # targets: at most 2 * len(qs) rows per (group, partition) -> broadcast, equi join on (group, partition)
    hits = (local.join(F.broadcast(targets), [group_col, "_pid"])
            .filter((F.col("_local") >= F.col("_start")) & (F.col("_local") <= F.col("_end"))))
    if method == "nearest":
        return hits.select(group_col, "q", F.col("_v").alias("value"))
    picked = hits.groupBy(group_col, "q").agg(
        F.max(F.when(F.col("_bound") == "lo", F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_bound") == "hi", F.col("_v"))).alias("_hi"),
        F.max("_frac").alias("_frac"))
    return picked.select(group_col, "q",
                         (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias("value"))


def feature_stats(df: DataFrame, cols: Sequence[str], null_share_max: float = config.DQ_NULL_SHARE_MAX,
                  quartiles: str = "exact") -> DataFrame:
    """Per column: rows, nulls, null share, mean, std, min, max, quartiles; flag null share > max.

    Moments: a single aggregate over all columns, then ``stack`` to one row per column.
    Quartiles: ``exact`` (distributed nearest-rank, see ``exact_quantiles``) or ``approx``
    (``percentile_approx``, one sketch per column).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if quartiles == "approx":
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    qcol = lambda c: f", `{c}__q`" if quartiles == "approx" else ""
    parts = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`{qcol(c)}" for c in cols)
    names = "column_name, non_null, mean, std, min, max" + (", q" if quartiles == "approx" else "")
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {parts}) AS ({names})")
    if quartiles == "approx":
        qs = [F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    else:
        vals = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double")
                                                      .alias("x")) for c in cols])).alias("_s")).select("_s.*")
        qt = (exact_quantiles(vals, "column_name", "x", [0.25, 0.5, 0.75])
              .groupBy("column_name").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value")))
        qt = qt.toDF("column_name", "p25", "p50", "p75")
        long = long.join(qt, "column_name", "left")
        qs = ["p25", "p50", "p75"]
    return long.select(
        "column_name", F.col("_rows").alias("rows"), (F.col("_rows") - F.col("non_null")).alias("nulls"),
        ((F.col("_rows") - F.col("non_null")) / F.col("_rows")).alias("null_share"),
        "mean", "std", "min", "max", *qs,
        (((F.col("_rows") - F.col("non_null")) / F.col("_rows")) > null_share_max).alias("too_many_nulls"))


def outliers(df: DataFrame, col: str, k: float = config.DQ_OUTLIER_STD) -> DataFrame:
    """Rows with |x - mean| > k * std (population-wide mean/std as scalar subqueries)."""
    stats = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    mean = stats.select("m").scalar()
    std = stats.select("s").scalar()
    return df.filter(F.abs(F.col(col) - mean) > k * std)


def min_weeks(facts: DataFrame, n: int = config.DQ_MIN_WEEKS, active_col: str = "sessions") -> DataFrame:
    """Members with at least ``n`` weeks of data."""
    return (facts.filter(F.col(active_col) > 0).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("weeks")).filter(F.col("weeks") >= n))


def psi(df: DataFrame, col: str, is_baseline: F.Column, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """Population stability index of ``col`` between baseline and current rows.

    Bins are cut at the baseline's exact quantiles (deciles, by default); a value on a cut belongs to the
    bin below it.  Shares below ``eps`` are floored at ``eps``; a bin without rows counts for nothing.
    Null where the baseline or the current side has no rows.
    """
    d = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"), is_baseline.alias("_base"))
    base = d.filter("_base").select("_base", "_x")
    cuts = exact_quantiles(base, "_base", "_x", [i / bins for i in range(1, bins)])
    cuts = cuts.agg(F.collect_list("value").alias("cuts")).scalar()
    bin_of = F.array_position(F.sort_array(F.array_append(cuts, F.col("_x"))), F.col("_x"))    # cuts below x, and one
    counts = d.withColumn("bin", bin_of).groupBy("bin").agg(F.sum(F.col("_base").cast("long")).alias("n_base"), F.sum((~F.col("_base")).cast("long")).alias("n_cur"))
    # as many rows as bins
    one = counts.agg(F.sum("n_base").alias("tb"), F.sum("n_cur").alias("tc"), F.sort_array(F.collect_list(F.struct("bin", "n_base", "n_cur"))).alias("each"))

    def share(n, total):
        return F.greatest(F.try_divide(n, total), F.lit(eps))

    part = F.transform("each", lambda r: (share(r.n_cur, F.col("tc")) - share(r.n_base, F.col("tb")))
                       * F.log(share(r.n_cur, F.col("tc")) / share(r.n_base, F.col("tb"))))
    psi_sum = F.when((F.col("tb") > 0) & (F.col("tc") > 0), F.aggregate(part, F.lit(0.0), lambda a, x: a + x))
    return one.select(F.lit(col).alias("feature"), psi_sum.alias("psi"), F.col("tb").alias("baseline_rows"), F.col("tc").alias("current_rows"))


def calibration(df: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    """Predicted vs observed by fixed probability bins [i/bins, (i+1)/bins), last bin closed."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return (df.withColumn("bin", b).groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_predicted"),
                 F.avg(F.col(y).cast("double")).alias("observed_rate")))
