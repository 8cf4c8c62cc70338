"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.llm import ann, chat, decontam, html_text, jaccard, langid, mixing, quality, repeats, runs, toxicity, warc, whiten
from renewlens.llm.common import WORD_PATTERN, crc_of_id, read


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of each hundredth."""
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages"), least_bytes=0)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 75 % of their five-word shingles."""
    return jaccard.link_documents(read(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by category."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document goes into the mix."""
    return mixing.mixed(read(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as preference pairs with a common prompt and masked completions."""
    return chat.format_preferences(chat.neighbour_pairs(read(spark, sf_dir, "conversations")))


def _planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text, in which every tenth document (by the crc32 of its id) repeats a stretch of its words to the end."""
    words = docs.select("doc_id", "text", crc_of_id().alias("h"), F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return words.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), text).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, and digests of them and of the texts without repeats."""
    found = runs.collapse_runs(_planted_runs(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    length, period = F.col("best.length"), -F.col("best.q")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors whitened on their first four components."""
    found = whiten.whiten(read(spark, sf_dir, "embeddings"))
    each = found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation as bigint)").alias("deviation"),
                       F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"), "identity_error")


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that also start elsewhere."""
    found = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_quality, op3_nearest, op4_warc, op5_html_text, op6_jaccard_join, op7_toxicity, op8_mixing, op9_language, op10_preferences, op11_runs, op12_whitening, op13_repeats)
}

ORACLE: dict[str, str] = {"op4_warc": warc.SQL, "op8_mixing": mixing.SQL, "op10_preferences": chat.SQL}
