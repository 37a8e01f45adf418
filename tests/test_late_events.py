"""Interval factors against full recomputation, event after event."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quantloom.operators import adjust

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(30)]
BARS = "ticker string, window_start timestamp_ntz, open double, high double, low double, close double, volume long"


@pytest.fixture(scope="module")
def bars(spark):
    r = random.Random(8)
    rows = []
    for t in "ABC":
        for d in DAYS:
            for m in range(r.choice([0, 1, 3])):
                p = r.choice([0.0, 5.0 + r.random(), 20.0 + r.random()]) if t == "C" else 10 + r.random()
                rows.append((t, dt.datetime.combine(d, dt.time(10, m)), p, p + 1, p - 1, p, r.randrange(1000)))
    return spark.createDataFrame(rows, BARS).cache()


def same(got, want):
    key = lambda r: (r.ticker, r.window_start)
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert len(a) == len(b) > 0
    for x, y in zip(a, b, strict=True):
        assert key(x) == key(y)
        for c in adjust.PRICES:
            assert x[f"adj_{c}"] == pytest.approx(y[f"adj_{c}"], rel=1e-12)


@pytest.mark.parametrize("zero_close", ["one", "split_only"])
def test_after_each_late_event_equal_to_a_full_recomputation(spark, bars, zero_close):
    splits = [("A", DAYS[20], 1.0, 2.0), ("B", DAYS[3], 5.0, 4.0), ("C", DAYS[9], 1.0, 3.0), ("A", DAYS[20], 2.0, 3.0), ("A", DAYS[5], 1.0, 10.0)]
    dividends = [("A", DAYS[12], 0.5), ("C", DAYS[29], 1.0), ("D", DAYS[2], 1.0), ("A", DAYS[12], 0.25), ("C", DAYS[0], 7.0)]
    table = lambda rows, names: spark.createDataFrame(rows, names)
    of = lambda n: (table(splits[:n], "ticker string, execution_date date, split_from double, split_to double"), table(dividends[:n], "ticker string, ex_dividend_date date, cash_amount double"))
    daily = adjust._dated(bars).groupBy("ticker", "date").agg(F.max_by("close", "window_start").alias("close"))
    now = adjust.factor_intervals(daily, *of(1), zero_close)
    for n in range(1, 6):
        if n > 1:
            touched = table([(splits[n - 1][0],), (dividends[n - 1][0],)], "ticker string")
            before = {tuple(r) for r in now.collect()}
            now = adjust.late_events(now, daily, *of(n), touched, zero_close)
            asked = {splits[n - 1][0], dividends[n - 1][0]}
            assert {r for r in before if r[0] not in asked} == {tuple(r) for r in now.collect() if r[0] not in asked}
        same(adjust.adjust_by_intervals(bars, now), adjust.adjust_bars(bars, *of(n), zero_close=zero_close))


def test_no_events_and_unknown_modes(spark, bars):
    none = spark.createDataFrame([], "ticker string, date date, cum double, split_cum double")
    rows = adjust.adjust_by_intervals(bars, none, "inverse").collect()
    assert rows and all(r.adj_close == r.close and r.adj_volume == r.volume for r in rows)
    with pytest.raises(ValueError, match="volume_mode"):
        adjust.adjust_by_intervals(bars, none, "sideways")


SPLITS, DIVIDENDS = "ticker string, execution_date date, split_from double, split_to double", "ticker string, ex_dividend_date date, cash_amount double"


def events(spark):
    splits = [("A", DAYS[20], 1.0, 2.0), ("B", DAYS[3], 5.0, 4.0), ("C", DAYS[9], 1.0, 3.0), ("A", DAYS[20], 2.0, 3.0), ("E", DAYS[5], 1.0, 10.0), (None, DAYS[5], 1.0, 2.0), ("B", None, 1.0, 2.0)]
    splits += [(t, d, 1.0, 2.0) for t in "ABC" for d in DAYS[12:16]]
    dividends = [("A", DAYS[12], 0.5), ("C", DAYS[29], 1.0), ("D", DAYS[2], 1.0), ("A", DAYS[12], 0.25), ("C", DAYS[0], 7.0), ("B", DAYS[7], None), (None, DAYS[5], 1.0)]
    return spark.createDataFrame(splits, SPLITS), spark.createDataFrame(dividends, DIVIDENDS)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("zero_close", ["one", "split_only"])
@pytest.mark.parametrize("mode", [None, "reference", "inverse"])
def test_in_one_pass_equal_to_factors_and_joins(spark, bars, zero_close, mode):
    splits, dividends = events(spark)
    want = adjust.adjust_bars(bars, splits, dividends, zero_close)
    for some in (F.lit(True), F.dayofmonth("window_start") % 3 == 0, F.dayofmonth("window_start") < 9):  # what isn't asked for gives its closes
        asked = bars.filter(some)
        got = adjust.adjust_with_events(asked, bars.filter(~some), splits, dividends, zero_close, mode)
        same(got, want.filter(some))
        by_intervals = adjust.adjust_by_intervals(asked, adjust.factor_intervals(bars, splits, dividends, zero_close), mode)
        assert got.columns == by_intervals.columns
        key = lambda r: (r.ticker, r.window_start)
        for a, b in zip(sorted(got.collect(), key=key), sorted(by_intervals.collect(), key=key), strict=True):
            assert a == b


def test_bars_without_ticker_or_day_stay_as_they_are(spark, bars):
    odd = spark.createDataFrame([(None, dt.datetime(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1), ("A", None, 1.0, 1.0, 1.0, 1.0, 1), ("Z", dt.datetime(2024, 1, 2), 1.0, 1.0, 1.0, None, 1)], BARS)
    got = adjust.adjust_with_events(odd, bars, *events(spark), volume_mode="reference").collect()
    assert len(got) == 3 and all(r.adj_open == 1.0 and r.adj_volume == 1 for r in got)
    with pytest.raises(ValueError, match="volume_mode"):
        adjust.adjust_with_events(bars, bars.limit(0), *events(spark), volume_mode="sideways")


def test_stored_day_bars_are_adjusted_without_joins_and_sorted_once(spark, bars):
    from quantloom.plans import stale

    splits, dividends = events(spark)
    tables = {"day_bars": bars, "all_day_bars": bars, "other_day_bars": bars.limit(0), "splits": splits, "dividends": dividends}
    plan = plan_of(stale.steps_of(stale.STOCKS)[0].build(tables))
    assert "Join" not in plan and plan.count("Sort [") == 1


def test_factors_of_events_join_nothing(spark, bars):
    assert "Join" not in plan_of(adjust.factor_intervals(adjust.daily_closes(bars), *events(spark)))
