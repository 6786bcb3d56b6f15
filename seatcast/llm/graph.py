"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b): the label is the
    smallest node that can be reached.

    Every round takes the smallest label among a node and its neighbours, then
    follows the label's own label, so long chains shorten by doubling.  Rounds
    write their labels to the shared folder; only a count comes back.  Minima
    are pre-aggregated before the shuffle; a node with very many neighbours is
    a skewed join key, which adaptive execution splits.  Null ends and empty
    tables give no rows; self and repeated edges do no harm.
    """
    one = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = materialize(one.union(one.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        met = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = materialize(met.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
