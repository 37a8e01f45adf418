"""Wide tables of a thousand tickers."""

import pytest
from pyspark.sql import functions as F

from quantloom.operators import matrix

METRICS = matrix.METRICS


def minutes(spark, tickers, n):
    rows = spark.range(tickers * n).select((F.col("id") % tickers).alias("k"), F.floor(F.col("id") / tickers).alias("m")).filter("k % 10 <> m % 10")
    return rows.select(
        F.lit("2024-01-02").cast("date").alias("date"), (F.lit("2024-01-02 09:30:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m").cast("int"))).alias("window_start"),
        F.format_string("T%04d", "k").alias("ticker"), *[(F.col("k") * 100.0 + F.col("m") + i / 16.0).alias(c) for i, c in enumerate(METRICS)], F.col("k"), F.col("m"),
    )


def test_both_ways_give_the_same_columns(spark, monkeypatch):
    df = minutes(spark, 23, 7)
    tickers = [f"T{k:04d}" for k in range(0, 23, 2)] + ["none"]
    want = matrix.to_wide(df, tickers, METRICS[:3])
    monkeypatch.setattr(matrix, "WIDE", 0)
    got = matrix.to_wide(df, tickers, METRICS[:3])
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert matrix.to_wide(df, ["T0001"], ["close"]).columns == ["date", "window_start", "T0001_close"]
    assert matrix.wide_tickers(df, 3) == ["T0000", "T0001", "T0002"]


@pytest.mark.parametrize("n", [1024])
def test_11264_columns_with_generated_code_only(spark, n):
    """Code that can't be compiled fails the job here, instead of being interpreted."""
    settings = {"spark.sql.codegen.factoryMode": "CODEGEN_ONLY", "spark.sql.codegen.fallback": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = minutes(spark, n, 20)
        tickers = [f"T{k:04d}" for k in range(n)]
        wide = matrix.to_wide(df, tickers, METRICS)
        assert len(wide.columns) == 2 + 11_264
        wide.write.format("noop").mode("overwrite").save()
        rows = matrix.to_arrays(df, tickers, METRICS).orderBy("window_start").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 20
    for m, row in enumerate(rows):
        for k in (0, 1, 31, 32, 33, 500, 1023):
            for i, c in enumerate(METRICS):
                cell = row.cells[k]
                assert (cell and cell[c]) == (None if k % 10 == m % 10 else k * 100.0 + m + i / 16.0)
