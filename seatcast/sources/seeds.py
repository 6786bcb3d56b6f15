"""The genre mapping seed (source genre name -> display genre).

Loadable reference data; no query depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import GENRE_SEED

# The seed rows (source genre, display genre), in file order.
GENRE_MAPPINGS = [
    ("Rock", "Rock"),
    ("Pop", "Pop"),
    ("Hip-Hop/Rap", "Hip-Hop"),
    ("R&B", "R&B"),
    ("Country", "Country"),
    ("Alternative", "Alternative"),
    ("Metal", "Metal"),
    ("Electronic", "Electronic"),
    ("Jazz", "Jazz"),
    ("Classical", "Classical"),
    ("Latin", "Latin"),
    ("Folk", "Folk"),
    ("Blues", "Blues"),
    ("Reggae", "Reggae"),
    ("World", "World"),
]


def genre_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GENRE_MAPPINGS, GENRE_SEED)


def read_genre_seed(spark: SparkSession, path: str) -> DataFrame:
    """A seed CSV with a header line; columns are taken by position
    (source genre, display genre)."""
    return spark.read.schema(GENRE_SEED).option("header", True).csv(path)


def write_genre_seed(spark: SparkSession, path: str) -> None:
    genre_seed(spark).coalesce(1).write.mode("errorifexists").option("header", True).csv(path)
