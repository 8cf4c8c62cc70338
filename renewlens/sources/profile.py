"""Data profiles: schema sample, null counts, row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_profile(df: DataFrame, n: int, order_key: str, max_values: int = 5) -> DataFrame:
    """Per field of the first ``n`` rows in ``order_key`` order: type and first values.

    The sample is a bounded top-n (TakeOrderedAndProject); values are rendered as
    strings, nulls as 'null', at most ``max_values`` per field in key order.
    """
    sample = df.orderBy(order_key).limit(n)
    fields = df.schema.fields
    pairs = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', CAST(`{f.name}` AS STRING)" for f in fields)
    long = sample.selectExpr(f"`{order_key}` AS _k", f"stack({len(fields)}, {pairs}) AS (field, type, value)")
    vals = F.slice(F.array_sort(F.collect_list(F.struct(F.col("_k"), F.coalesce("value", F.lit("null"))
                                                        .alias("v")))), 1, max_values)
    return (long.groupBy("field", "type").agg(vals.alias("_vals"))
            .select("field", "type", F.array_join(F.transform("_vals", lambda s: s["v"]), " | ").alias("sample_values")))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing-value count and type per column: one aggregate, then unpivot."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    long = wide.unpivot([], cols, "column_name", "nulls")
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.select("column_name", tmap[F.col("column_name")].alias("dtype"), "nulls")


def collection_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named frame (union of global counts)."""
    parts = [df.groupBy().count().select(F.lit(name).alias("table_name"), F.col("count").alias("row_count"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
