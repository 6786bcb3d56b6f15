"""The rounding recipes against the SQL engine the models were written for
(DuckDB), on tie-heavy values."""

import random

import duckdb
import pandas as pd

from pyspark.sql import functions as F

from seatcast.functions import dec2, price_micros, round_half_away, to_numeric


def test_recipes_match_duckdb(spark):
    rnd = random.Random(11)
    # prices with 2-4 decimals, many exact halves, negatives, means of pairs
    vals = []
    for _ in range(3000):
        v = rnd.randint(-200000, 200000) / rnd.choice([100, 200, 1000, 2000, 8])
        vals.append(v)
        vals.append((v + rnd.randint(0, 9999) / 100) / 2.0)
    # edges: just below a half, negative halves, huge values, zero
    vals += [0.49999999999999994, -0.49999999999999994, 0.5, -0.5, 1.5, -2.5, 0.0,
             0.004999999999999999, 2.0 ** 52 + 1, -(2.0 ** 53), 1e15 + 0.5, 123456.785]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    small = F.abs("x") < 1e12
    got = df.select("x", round_half_away("x", 2).alias("r2"), round_half_away("x", 0).alias("r0"),
                    F.when(small, to_numeric("x")).alias("n3"),
                    F.when(small, dec2("x")).alias("d2"),
                    F.when(small, price_micros("x")).alias("m")).toPandas()
    con = duckdb.connect()
    con.register("t", got[["x"]])
    want = con.sql("SELECT x, round(x, 2) AS r2, round(x, 0) AS r0, "
                   "CASE WHEN abs(x) < 1e12 THEN CAST(x AS DECIMAL(18,3)) END AS n3, "
                   "CASE WHEN abs(x) < 1e12 THEN round(CAST(x AS DECIMAL(18,3)), 2) END AS d2, "
                   "CASE WHEN abs(x) < 1e12 THEN CAST(round(x * 1000000) AS BIGINT) END AS m "
                   "FROM t").df()
    for c in ("r2", "r0", "n3", "d2", "m"):
        a = [None if pd.isna(v) else float(v) for v in got[c]]
        b = [None if pd.isna(v) else float(v) for v in want[c]]
        bad = [(x, p, q) for x, p, q in zip(got["x"], a, b) if p != q]
        assert not bad, (c, bad[:5])


def test_binary_rounding_matches_python(spark):
    from seatcast.functions import round_binary
    rnd = random.Random(3)
    vals = [2.675, -2.675, 0.125, 2.375, 1.005, -0.005, 0.0, 2.5, 1023.995, 2000.125, 2.0]
    vals += [rnd.randint(-9000, 9000) / 1000 for _ in range(500)]
    vals += [rnd.uniform(-9, 9) for _ in range(500)]
    got = spark.createDataFrame([(v,) for v in vals], "x double").select(
        "x", round_binary("x", 2).alias("r")).collect()
    assert [r.r for r in got if r.r != round(r.x, 2)] == []
