"""Profile of documents without a schema: JSON texts read as VARIANT and unnested path by path.

Each round unnests the objects and arrays of the level before (a generator, no join), until a level has none; levels
are stored, so a document is parsed once however deep it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.sources.sinks import store


def _kind(variant: str) -> Column:
    """object, array, string, long, decimal, boolean, null or another type's name of a variant."""
    name = F.schema_of_variant(variant)
    return (F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
            .when(name == "BIGINT", "long").when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "decimal")
            .when(name == "VOID", "null").otherwise(F.lower(name)))


def unnested(docs: DataFrame, key: str, text: str) -> DataFrame:
    """_id, path, type, value, _at: one row per node of each document.

    The root is ``$``; a field adds ``.name`` (or ``["name"]``), an element ``[]``.  ``value`` is the text of scalars but null; ``_at``
    the positions on the way, which order a document's nodes of one path.  A null text is one node of type
    ``missing``, one that isn't JSON of type ``invalid``.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text")).withColumn("_v", F.try_parse_json("_text"))
    kind = F.when(F.col("_text").isNull(), "missing").when(F.col("_v").isNull(), "invalid").otherwise(_kind("_v"))
    level = store(raw.select("_id", F.lit("$").alias("path"), F.array().cast("array<int>").alias("_at"), kind.alias("type"), "_v"), "documents")
    levels = []
    plain = F.col("name").rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    step = (F.when(F.col("name").isNull(), "[]").when(plain, F.concat(F.lit("."), "name")).otherwise(F.concat(F.lit('["'), "name", F.lit('"]'))))
    while True:
        levels.append(level.select("_id", "path", "type", F.when(~F.col("type").isin("object", "array"), F.col("_v").cast("string")).alias("value"), "_at"))
        nested = level.filter(F.col("type").isin("object", "array"))
        if nested.isEmpty():
            break
        inner = nested.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()).toDF("pos", "name", "inner"))
        level = store(inner.select("_id", F.concat("path", step).alias("path"), F.concat("_at", F.array(F.col("pos").cast("int"))).alias("_at"),
                                   _kind("inner").alias("type"), F.col("inner").alias("_v")), "documents")
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    return out


def document_profile(docs: DataFrame, key: str, text: str, max_values: int = 5) -> DataFrame:
    """path, type, documents, nodes, mixed, sample_values of all documents.

    A path with nodes of several types other than null has a row for each, marked ``mixed``.  sample_values are the
    first ``max_values`` by key and place, at most so many per task and path on the way; objects and arrays have none.
    """
    nodes = unnested(docs, key, text)
    per = nodes.groupBy("path", "type", "_id").agg(F.count("*").alias("n"))
    counts = per.groupBy("path", "type").agg(F.count("*").alias("documents"), F.sum("n").alias("nodes"))
    kinds = counts.filter(~F.col("type").isin("null", "missing")).groupBy("path").agg((F.count("*") > 1).alias("mixed"))
    first = Window.partitionBy("path", "type").orderBy("_id", "_at")
    sample = (nodes.filter(~F.col("type").isin("object", "array", "missing", "invalid")).withColumn("i", F.row_number().over(first)).filter(F.col("i") <= max_values)
              .groupBy("path", "type").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("value", F.lit("null")).alias("v")))).alias("vs")))
    joined = counts.join(kinds, "path", "left").join(sample, ["path", "type"], "left")
    return joined.select("path", "type", "documents", "nodes", F.coalesce("mixed", F.lit(False)).alias("mixed"),
                         F.array_join(F.transform("vs", lambda s: s["v"]), " | ").alias("sample_values"))
