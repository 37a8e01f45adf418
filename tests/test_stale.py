"""The daily run rewrites stale dates only."""

import datetime as dt
import gzip
from pathlib import Path

from pyspark.sql import functions as F

from quantloom.plans import stale
from quantloom.sources import sinks, stored

D = [dt.date(2024, 1, d) for d in range(2, 8)]
BARS = "ticker string, window_start timestamp_ntz, open double, high double, low double, close double, volume long, transactions long, date date"


def bars(spark, days, price=10.0):
    rows = [(t, dt.datetime.combine(d, dt.time(10, m)), price, price + 1, price - 1, price + m, 100, 5, d) for d in days for t in "AB" for m in (0, 3)]
    return spark.createDataFrame(rows, BARS)


def put(spark, base, days, price=10.0):
    for name in ("day_bars", "minute_bars"):
        sinks.write_table(bars(spark, days, price), f"{base}/{name}", ["date"])


def split(spark, base, day, ticker="A"):
    row = spark.createDataFrame([(ticker, day, 1.0, 2.0, day)], "ticker string, execution_date date, split_from double, split_to double, date date")
    sinks.write_table(row, f"{base}/splits", ["date"])


def files(base, table):
    return {str(p.relative_to(f"{base}/{table}")) for p in Path(base, table).rglob("*.parquet")}


def names(days):
    return [str(d) for d in days]


def test_only_stale_dates_are_rewritten(spark, tmp_path):
    base, steps = str(tmp_path), [s for s in stale.steps_of(stale.STOCKS) if s.name in ("adjusted_day_bars", "adjusted_minute_bars", "matrix")]
    put(spark, base, D[:4])
    split(spark, base, D[1])
    sinks.write_table(spark.createDataFrame([("B", D[0], 0.5, D[0])], "ticker string, ex_dividend_date date, cash_amount double, date date"), f"{base}/dividends", ["date"])
    done = stale.refresh(spark, base, steps)
    assert done == {s.name: names(D[:4]) for s in steps}
    assert stale.refresh(spark, base, steps) == {s.name: [] for s in steps}  # nothing has changed
    tables = {s.name: files(base, s.name) for s in steps}

    put(spark, base, D[4:5])  # a new day
    assert stale.refresh(spark, base, steps) == {s.name: names(D[4:5]) for s in steps}
    for s in steps:
        assert tables[s.name] < files(base, s.name)
    tables = {s.name: files(base, s.name) for s in steps}

    split(spark, base, D[3], "B")  # a late split makes all earlier adjusted dates stale, and none of the matrix
    assert stale.stale_dates(spark, base, steps[0]) == names(D[:3])
    assert stale.refresh(spark, base, steps) == {"adjusted_day_bars": names(D[:3]), "adjusted_minute_bars": names(D[:3]), "matrix": []}
    assert {f for f in tables["adjusted_day_bars"] if f[:15] > f"date={D[2]}"} <= files(base, "adjusted_day_bars") and files(base, "matrix") == tables["matrix"]
    got = {(r.ticker, r.date): r.adj_open for r in spark.read.parquet(f"{base}/adjusted_day_bars").filter("minute(window_start) = 0").collect()}
    assert got == {("A", d): 10.0 / (2 if d < D[1] else 1) for d in D[:5]} | {("B", d): 10.0 / (2 if d < D[3] else 1) for d in D[:5]}

    put(spark, base, D[1:2], 20.0)  # corrected bars on an action day: its close counts for the dates before
    assert stale.refresh(spark, base, steps)["adjusted_day_bars"] == names(D[:2])


def test_dates_that_lose_their_rows_or_inputs_go(spark, tmp_path):
    base, steps = str(tmp_path), [s for s in stale.steps_of(stale.INDICES)]
    put(spark, base, D[:3])
    stale.refresh(spark, base, steps)
    night = bars(spark, D[1:2]).withColumn("window_start", F.col("window_start") + F.expr("INTERVAL 12 HOURS"))
    sinks.write_table(night, f"{base}/minute_bars", ["date"])  # no bar of the session any more
    stored.drop_partitions(spark, f"{base}/minute_bars", names(D[:1]))
    assert stale.refresh(spark, base, steps) == {"matrix": names(D[1:2])}
    assert stored.partition_values(spark, f"{base}/matrix") == names(D[2:3])
    assert stale.refresh(spark, base, steps) == {"matrix": []}
    assert "rsi" not in spark.read.parquet(f"{base}/matrix").columns  # indices have no indicators


def test_a_run_that_was_cut_off_is_made_up_for(spark, tmp_path, monkeypatch):
    base, steps = str(tmp_path), stale.steps_of(stale.INDICES)
    put(spark, base, D[:2])
    real = stale.sinks.write_table
    monkeypatch.setattr(stale.sinks, "write_table", lambda *a: (real(*a), 1 / 0)[0])
    try:
        stale.refresh(spark, base, steps)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert stale.refresh(spark, base, steps) == {"matrix": names(D[:2])} and stale.refresh(spark, base, steps) == {"matrix": []}


def test_markets_and_histories(spark, tmp_path):
    base, csv = str(tmp_path / "base"), str(tmp_path / "bars.csv.gz")
    late = 1_704_164_400_000_000_000  # 2024-01-02 03:00 UTC: still the 1st in New York
    with gzip.open(csv, "wt") as f:
        f.write("ticker,volume,open,close,high,low,window_start,transactions\n" + f"X:BTCUSD,1.5,1,1,1,1,{late},1\n")
    stale.ingest_bars(spark, csv, f"{base}/crypto", stale.CRYPTO)
    stale.ingest_bars(spark, csv, f"{base}/stocks", stale.STOCKS)
    assert stored.partition_values(spark, f"{base}/crypto/minute_bars") == ["2024-01-02"] and stored.partition_values(spark, f"{base}/stocks/minute_bars") == ["2024-01-01"]
    assert spark.read.parquet(f"{base}/crypto/minute_bars").first().volume == 1.5 and spark.read.parquet(f"{base}/stocks/minute_bars").first().volume == 1
    assert [s.name for s in stale.steps_of(stale.FOREX)] == [] and {s.name for m in stale.MARKETS for s in stale.steps_of(m)} >= {"matrix", "tq_bars", "option_flow", "adjusted_minute_bars"}
    put(spark, base, D)
    assert stale.history(spark, base, 2).select("date").distinct().count() == 3
    assert stale.expire(spark, base, "day_bars", 2) == 3 and stored.partition_values(spark, f"{base}/day_bars") == names(D[3:])
