"""Pipeline stages: each applies one operator to what its predecessor kept.

A stage takes (spark, docs, sf_dir).  All but the last return the columns of
``docs``; the last returns the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import decontam, linedup, neardup, packing, quality
from .common import materialize, small_batches, without
from .queries import END_ID, _vocabulary


# Shingle similarity, in percent, from which the pipeline takes two texts as near
# duplicates.  The op10 query has its own.
NEAR_PERCENT = 80

# Known pieces of a worker in the pipeline, whose executors carry the heap of all
# earlier stages: fewer than where packing runs alone, for some more encoding.
PACK_KNOWN_BYTES = 32 << 20
# Bytes of text that packing encodes at a time in the pipeline, for the same reason.
PACK_SLICE_BYTES = 1 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands reject go."""
    return quality.keep_passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; so does a document that has no word left, as every
    line of it stands in others.  n_chars follows the text."""
    left = linedup.drop_templates(docs).where(
        (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    out = left.select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates stays."""
    with small_batches(spark):
        near = neardup.near_duplicates(docs, NEAR_PERCENT)
        out = materialize(near.where("NOT kept").select("doc_id").distinct(), "near-copies")
    return without(docs, out, "doc_id").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(
        *docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of every remaining document goes."""
    with small_batches(spark, PACK_SLICE_BYTES):
        packed = packing.pack(docs, _vocabulary("byte_bpe_50k.json"), end_id=END_ID,
                              known_bytes=PACK_KNOWN_BYTES, slice_bytes=PACK_SLICE_BYTES)
    return packed.drop("ids")
