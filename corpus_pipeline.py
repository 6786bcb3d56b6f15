"""A corpus pipeline over ``documents``: each stage applies one operator of
``seatcast.llm`` and its decisions take effect before the next stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seatcast.llm import stages
from seatcast.llm.common import materialize
from seatcast.sources.tables import table

STAGES = [
    ("quality", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("pack", stages.pack),
]

# Compression, template and packing stages have no SQL form; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and
    read again as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
