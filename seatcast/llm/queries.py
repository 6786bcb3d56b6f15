"""Thin queries over the driver's tables, one per operator (their SQL: ``sql``).

Each query applies its operator with production parameters to the whole table
and derives the contract's columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from . import (
    decontam,
    dialogs,
    langid,
    linedup,
    neardup,
    packing,
    pagetext,
    periods,
    pii,
    quality,
    records,
    substrings,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

END_ID = 2


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                          _vocabulary("byte_bpe_50k.json"), end_id=END_ID)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                         "offset")


def op2_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; the text models are counted over documents."""
    return langid.identify(table(spark, sf_dir, "pages"),
                           table(spark, sf_dir, "documents", "lang", "text"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(
        table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


def op4_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                             table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines and the digest of what is left."""
    left = linedup.drop_templates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  table(spark, sf_dir, "benchmark")).drop("row_key")


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.render(F.col("base")), 256)
                        .alias("base_sha256"), pii.render(F.col("spans")).alias("spans"))


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents", "doc_id", "text"), path,
                          _vocabulary("word_bpe_49k.json"), end_id=END_ID)
    return records.read_records(spark, path).drop("ids")


def op9_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compression_bands(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def _with_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: of documents with h = crc32(doc_id), h % 10 = 0, the
    words from a on are the p words from a on, again and again."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = (docs.withColumn("h", h)
              .withColumn("words", F.when(F.col("h") % 10 == 0, words))
              .withColumn("n", F.size("words").cast("long")))
    g = F.floor(F.col("h") / 10)
    a = F.when(F.col("n") > 0, g % F.col("n"))
    rest = F.col("n") - a
    p = F.lit(1) + F.floor(rest / (g % 8 + 3))
    tail = F.flatten(F.array_repeat(F.slice("words", (a + 1).cast("int"), p.cast("int")),
                                    F.ceil(rest / p).cast("int")))
    made = F.concat(F.slice("words", F.lit(1), a.cast("int")), tail)
    text = F.array_join(F.slice(made, F.lit(1), F.col("n").cast("int")), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text"))
                         .alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = periods.periodic_runs(_with_periods(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))), "")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.floor(F.col("top.length") * 1000 / (-F.col("top.period"))).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage, by a hash of conversation and turn."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    k = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    times = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("k", k).where("k != 0").select(
        "conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(text("role")).alias("role"),
        F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate(text("text"), ".!?", ""))
        .otherwise(text("text")).alias("text"), F.explode(times).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    found = dialogs.repair_report(_damaged(rows)).withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_evidence_fusion, op3_suffix_dedup,
        op4_noisy_channel_toxicity, op5_line_templates, op6_prefix_decontamination,
        op7_bootstrapped_pii, op8_binary_records, op9_compression_bands, op10_hyperminhash,
        op11_periodic_runs, op12_conversation_repair, op13_html_extraction)}
