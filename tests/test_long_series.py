"""Exponential means of series of a million rows against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.functions import series

N = 1_000_000


def long_values(spark, gaps=0):
    """A million values from a hash, some missing, of one key; another key has seven."""
    v = F.pmod(F.xxhash64("id"), F.lit(100_003)) / 997.0 + F.when(F.col("id") % 50_000 == 0, 1e6).otherwise(0.0)
    rows = spark.range(N).select(F.lit("long").alias("k"), F.col("id").alias("i"), v.alias("v")).unionByName(spark.range(7).select(F.lit("short").alias("k"), F.col("id").alias("i"), (F.col("id") * 1.5).alias("v")))
    return rows.withColumn("v", F.when(F.pmod(F.xxhash64("i", F.lit(3)), F.lit(100)) >= gaps, F.col("v"))) if gaps else rows


def columns(df, *names):
    table = df.select("k", "i", *names).toPandas().sort_values(["k", "i"])
    return table[table.k == "long"], table[table.k == "short"]


@pytest.mark.parametrize("alphas", [(2 / 13, 2 / 27, 1 / 14), (0.9, 0.0005), (1e-7,)])
def test_adjusted_means(spark, alphas):
    df = series.ewm_means(long_values(spark), ["k"], ["i"], {f"m{j}": (F.col("v"), a) for j, a in enumerate(alphas)})
    for part in columns(df, "v", *[f"m{j}" for j in range(len(alphas))]):
        for j, a in enumerate(alphas):
            np.testing.assert_allclose(part[f"m{j}"], part.v.ewm(alpha=a).mean(), rtol=1e-9)


@pytest.mark.parametrize("gaps", [30, 97])
def test_recursive_means_with_gaps(spark, gaps):
    df = long_values(spark, gaps)
    df = df.withColumn("v", F.when((F.col("i") < 300_000) | (F.col("i") > 310_000), F.col("v")))  # a gap of 10,000 rows
    share, decay = series.ewm_gaps(F.col("v").isNotNull(), F.col("i"), ["k"], ["i"], 2 / 11)
    df = series.decayed_sums(df.withColumns({"s": share, "d": decay}), ["k"], ["i"], F.col("d"), {"m": F.col("s") * F.col("v")})
    long, short = columns(df, "v", "m")
    for part in (long, short):
        want = part.v.ewm(span=10, adjust=False).mean()
        seen = want.notna()
        np.testing.assert_allclose(part.m[seen], want[seen], rtol=1e-9)
    assert np.isfinite(long.m).all()


def test_decays_of_zero_and_one(spark):
    rows = [(0, 1.0, 5.0), (1, 0.0, 7.0), (2, 1.0, None), (3, 1e-320, 2.0), (4, 0.5, 1.0)]
    df = spark.createDataFrame([("a", *r) for r in rows], "k string, i int, d double, x double")
    got = [r.y for r in series.decayed_sums(df, ["k"], ["i"], F.col("d"), {"y": F.col("x")}).orderBy("i").collect()]
    assert got == [5.0, 7.0, 7.0, 2.0, 2.0]


def test_alpha_outside_its_range(spark):
    with pytest.raises(ValueError, match="alpha"):
        series.ewm_means(long_values(spark), ["k"], ["i"], {"m": (F.col("v"), 1.0)})


def test_matrix_indicators_are_finite_over_many_years_in_one_partition(spark):
    """Keys that aren't cut by day: the indicators of one series of 60,000 rows stay finite and are pandas' own."""
    from quantloom.operators import matrix

    rows = spark.range(60_000).select(F.lit("2024-01-01").cast("date").alias("date"), F.lit("T").alias("ticker"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("window_start"), (100 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0).alias("close"))
    got = matrix.rsi(matrix.macd(rows)).toPandas().sort_values("window_start")
    assert np.isfinite(got[["ema12", "ema26", "macd", "rsi"]].to_numpy()).all()
    np.testing.assert_allclose(got.ema12, got.close.ewm(span=12).mean(), rtol=1e-9)
    change = got.close.diff()
    up, down = (c.fillna(0).ewm(alpha=1 / 14).mean() for c in (change.clip(lower=0), (-change).clip(lower=0)))
    np.testing.assert_allclose(got.rsi[1:], (100 - 100 / (1 + up / down))[1:], rtol=1e-9)
    assert pd.notna(got.rsi).all()
