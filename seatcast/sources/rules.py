"""Alert rules: build, read and save.

Saved rules are JSON lines, one object each: ``rule_id``, ``target_price``,
``created_at``, ``triggered``, optional ``event_id`` / ``artist_name``, later
``triggered_at`` / ``triggered_price``.  ``read_rules`` reads that form back, and
also a hand-written JSON array of such objects, whose rules are numbered by
their position where they have no ``rule_id``.  A file that cannot be parsed is
an error, never "no rules".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RULES
from ..session import exists


def rules_frame(spark: SparkSession, records) -> DataFrame:
    """Rules from Python records: tuples (target_price, created_at,
    triggered, event_id, artist_name) or dicts shaped like the rule file."""
    rows = []
    for i, r in enumerate(records):
        if isinstance(r, dict):
            rows.append((i, r.get("target_price"), r.get("created_at"), r.get("triggered"),
                         r.get("event_id"), r.get("artist_name"), r.get("triggered_at"),
                         r.get("triggered_price")))
        else:
            rows.append((i, *r) + (None,) * (7 - len(r)))
    import pandas as pd
    data = [(i, None if t is None else float(t), *rest) for i, t, *rest in rows]
    # from pandas (Arrow) the rules become a LocalRelation with its real size,
    # so the planner's size checks can broadcast them; a Python list would
    # give an RDD scan of unknown (maximal) size
    pdf = pd.DataFrame(data, columns=RULES.fieldNames()).astype(object)
    pdf = pdf.where(pd.notna(pdf), None)
    return spark.createDataFrame(pdf, RULES)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a saved folder or file; a missing one means no rules."""
    if not exists(spark, path):
        return spark.createDataFrame([], RULES)
    reader = spark.read.schema(RULES).option("mode", "FAILFAST")
    first = (spark.read.text(path).filter(F.trim("value") != "").limit(1).collect())
    if first and first[0][0].lstrip().startswith("["):
        # an array in one file is read in order by one task
        rules = reader.option("multiLine", True).json(path)
    else:
        rules = reader.json(path)
    place = F.monotonically_increasing_id()
    return rules.select(F.coalesce("rule_id", place).alias("rule_id"),
                        *[c for c in RULES.fieldNames() if c != "rule_id"])


def save_rules(rules: DataFrame, path: str) -> None:
    """Write the rules as a new version (JSON lines, ordered by rule_id), in the
    form ``read_rules`` reads.  Refuses to overwrite: the caller picks a fresh
    path, never the one the rules were read from (overwriting the input of a
    lazy plan loses it)."""
    (rules.orderBy("rule_id").write.mode("errorifexists").json(path))
