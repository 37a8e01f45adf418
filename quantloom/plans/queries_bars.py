"""Queries of time selection, consolidation, adjustment, matrices and ticks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import times
from ..functions.series import densify, top_n_by
from ..functions.shared import shared_path
from ..operators import adjust, consolidate, matrix, ticks
from ..sources import sinks, stored
from ..streaming import incremental
from . import views as v
from .registry import query, same_rows
from .views import with_views

BAR = ("open", "high", "low", "close")
ADJ = tuple(f"adj_{c}" for c in BAR)


def dated(df):
    return df.withColumn("date", times.ny_date(df, "window_start"))


_DAY = "SELECT *, CAST(window_start AS DATE) AS date FROM v_day_bars"


@query("t1_recent_days", with_views("v_day_bars", more={"d": _DAY}) + " FINAL SELECT ticker, date, close, volume FROM d WHERE date >= (SELECT max(date) FROM d) - 365", dbl=("close",), txt=("date",))
def t1(spark, sf):
    return times.recent_days(dated(v.day_bars(spark, sf)), 365).select("ticker", "date", "close", "volume")


@query("t2_date_range", with_views("v_day_bars", more={"d": _DAY}) + " FINAL SELECT ticker, date, close FROM d WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'", dbl=("close",), txt=("date",))
def t2(spark, sf):
    return times.date_range(dated(v.day_bars(spark, sf)), "1998-01-01", "1998-03-31").select("ticker", "date", "close")


@query("t3_latest_date", with_views("v_day_bars", more={"d": _DAY}) + " FINAL SELECT ticker, date, close FROM d WHERE date = (SELECT max(date) FROM d)", dbl=("close",), txt=("date",))
def t3(spark, sf):
    return times.latest_date(dated(v.day_bars(spark, sf))).select("ticker", "date", "close")


@query("t4_last_n_day_aggs", with_views("v_day_bars", more={"d": _DAY}) + " FINAL SELECT date, ticker, open, high, low, close, volume, transactions FROM d WHERE ticker IS NOT NULL AND date >= (SELECT max(date) FROM d) - 730", dbl=BAR, txt=("date",))
def t4(spark, sf):
    return consolidate.last_n_day_aggs(v.day_bars(spark, sf), 730)


_APPEND = with_views(
    "v_day_bars",
    more={
        "old": "SELECT ticker, window_start, close FROM v_day_bars WHERE window_start < TIMESTAMP '1999-06-01'",
        "new": "SELECT ticker, window_start, close + 1 AS close FROM v_day_bars WHERE window_start >= TIMESTAMP '1999-01-01'",
    },
)


def _halves(spark, sf):
    bars = v.day_bars(spark, sf).select("ticker", "window_start", "close")
    return bars.filter("window_start < TIMESTAMP_NTZ'1999-06-01'"), bars.filter("window_start >= TIMESTAMP_NTZ'1999-01-01'").withColumn("close", F.col("close") + 1)


@query("t5_append_bars", _APPEND + " FINAL SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.ticker = old.ticker AND new.window_start = old.window_start)", dbl=("close",), txt=("window_start",))
def t5(spark, sf):
    return consolidate.append_bars(*_halves(spark, sf))


@query(
    "t5_append_newer_only",
    _APPEND + " FINAL SELECT * FROM old UNION ALL SELECT new.* FROM new LEFT JOIN (SELECT ticker, max(window_start) AS high FROM old GROUP BY ticker) h ON new.ticker = h.ticker WHERE high IS NULL OR window_start > high",
    dbl=("close",), txt=("window_start",),
)
def t5_newer(spark, sf):
    return consolidate.append_bars(*_halves(spark, sf), mode="newer_only")


@query(
    "t5_merge_stored",
    _APPEND + """ FINAL SELECT ticker, window_start, close, CAST(date_trunc('month', window_start) AS DATE) AS month FROM (SELECT * FROM new UNION ALL SELECT * FROM old
                  WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.ticker = old.ticker AND new.window_start = old.window_start))""",
    dbl=("close",), txt=("window_start", "month"),
)
def t5_stored(spark, sf):
    """Two merges into a stored table; the second reads and rewrites only months that it has rows of."""
    path = shared_path(spark, "bars")
    for part in _halves(spark, sf):
        stored.merge_into(part.withColumn("month", F.trunc("window_start", "month")), path, partition="month")
    return spark.read.parquet(path)


@query(
    "t5_merge_newer_only",
    _APPEND + """ FINAL SELECT *, CAST(date_trunc('month', window_start) AS DATE) AS month FROM (SELECT * FROM old UNION ALL SELECT new.* FROM new LEFT JOIN (SELECT ticker, max(window_start) AS high FROM old GROUP BY ticker) h
                  ON new.ticker = h.ticker WHERE high IS NULL OR window_start > high)""",
    dbl=("close",), txt=("window_start", "month"),
)
def t5_stored_newer(spark, sf):
    """As above with the table of latest times: what isn't later than a ticker's latest bar is left out, without reading bars for it."""
    path = shared_path(spark, "bars")
    for part in _halves(spark, sf):
        stored.merge_into(part.withColumn("month", F.trunc("window_start", "month")), f"{path}/bars", partition="month", marks=f"{path}/marks")
    return spark.read.parquet(f"{path}/bars")


@query(
    "t3_latest_month_stored",
    with_views("v_day_bars") + " FINAL SELECT ticker, window_start, close, CAST(date_trunc('month', window_start) AS DATE) AS month FROM v_day_bars WHERE date_trunc('month', window_start) = (SELECT max(date_trunc('month', window_start)) FROM v_day_bars)",
    dbl=("close",), txt=("window_start", "month"),
)
def t3_stored(spark, sf):
    """The latest partition of a stored table, from the names of its folders."""
    path = shared_path(spark, "bars")
    bars = v.day_bars(spark, sf).select("ticker", "window_start", "close")
    sinks.write_table(bars.withColumn("month", F.trunc("window_start", "month")), path, ["month"])
    return stored.read_latest(spark, path, "month")


@query("t6_ny_date", "SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS date FROM events", txt=("date",))
def t6(spark, sf):
    e = v.table(spark, sf, "events")  # January: New York is 5 hours behind UTC
    utc = e.select("event_id", F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts").cast("timestamp_ntz")).cast("timestamp").alias("at"))
    return utc.select("event_id", times.ny_date(utc, "at").alias("date"))


def _adjusted(zero: str, extra: str = "") -> dict[str, str]:
    factor = {
        "one": "CASE WHEN close = 0 THEN 1.0 ELSE (1.0 / coalesce(split, 1.0)) * ((close - coalesce(dividend, 0.0)) / close) END",
        "split_only": "(1.0 / coalesce(split, 1.0)) * CASE WHEN close = 0 THEN 1.0 ELSE (close - coalesce(dividend, 0.0)) / close END",
    }[zero]
    return {
        "d": _DAY,
        "f": f"""SELECT d.ticker, d.date, {factor}::DOUBLE AS f, (1.0 / coalesce(split, 1.0))::DOUBLE AS s
                 FROM (SELECT ticker, date, arg_max(close, window_start) AS close FROM d GROUP BY 1, 2) d
                 LEFT JOIN (SELECT ticker, execution_date AS date, product(split_to / split_from) AS split FROM v_splits GROUP BY 1, 2) sp ON sp.ticker = d.ticker AND sp.date = d.date
                 LEFT JOIN (SELECT ticker, ex_dividend_date AS date, sum(cash_amount) AS dividend FROM v_dividends GROUP BY 1, 2) dv ON dv.ticker = d.ticker AND dv.date = d.date""",
        "c": """SELECT ticker, date, coalesce(product(f) OVER (PARTITION BY ticker ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS cum,
                       coalesce(product(s) OVER (PARTITION BY ticker ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS scum FROM f""",
    }


_ADJ = "open * cum AS adj_open, high * cum AS adj_high, low * cum AS adj_low, close * cum AS adj_close"


@query("a1_adjust_bars", with_views("v_day_bars", "v_splits", "v_dividends", more=_adjusted("one")) + f" FINAL SELECT d.*, {_ADJ} FROM d JOIN c USING (ticker, date)", dbl=(*BAR, *ADJ), txt=("date", "window_start"))
def a1(spark, sf):
    return adjust.adjust_bars(v.day_bars(spark, sf), v.splits(spark, sf), v.dividends(spark, sf))


@query("a2_adjust_day_bars", with_views("v_day_bars", "v_splits", "v_dividends", more=_adjusted("split_only")) + f" FINAL SELECT d.*, {_ADJ} FROM d JOIN c USING (ticker, date)", dbl=(*BAR, *ADJ), txt=("date", "window_start"))
def a2(spark, sf):
    bars = _stored(spark, v.day_bars(spark, sf), "day-bars")  # read twice
    return adjust.adjust_day_bars(bars, v.splits(spark, sf), v.dividends(spark, sf))


@query(
    "a3_adjust_combined",
    with_views("v_day_bars", "v_splits", "v_dividends", more=_adjusted("split_only"))
    + f" FINAL SELECT d.ticker, d.date, open, high, low, close, volume, transactions, {_ADJ}, trunc(volume * scum) AS adj_volume FROM d JOIN c USING (ticker, date)",
    dbl=(*BAR, *ADJ), txt=("date",), big=("adj_volume",),
)
def a3(spark, sf):
    return adjust.adjust_combined(v.day_bars(spark, sf), v.splits(spark, sf), v.dividends(spark, sf))


def _stored(spark, df, what):
    """A view as a table that is made once and then read, as a stored feed is."""
    path = shared_path(spark, what)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _late(spark, sf, zero_close):
    """(day bars, the interval table of events up to a date, then with the rest as late events)."""
    bars = _stored(spark, v.day_bars(spark, sf), "day-bars")
    daily = dated(bars).select("ticker", "date", "close")
    splits, dividends = _stored(spark, v.splits(spark, sf), "splits"), _stored(spark, v.dividends(spark, sf), "dividends")
    early = F.lit("1995-06-01").cast("date")
    path = shared_path(spark, "factors")
    adjust.factor_intervals(daily, splits.filter(F.col("execution_date") < early), dividends.filter(F.col("ex_dividend_date") < early), zero_close).write.parquet(path)
    late = splits.filter(F.col("execution_date") >= early).select("ticker").union(dividends.filter(F.col("ex_dividend_date") >= early).select("ticker"))
    return bars, adjust.late_events(spark.read.parquet(path), daily, splits, dividends, late, zero_close)


@query("a1_late_events", with_views("v_day_bars", "v_splits", "v_dividends", more=_adjusted("one")) + f" FINAL SELECT d.*, {_ADJ} FROM d JOIN c USING (ticker, date)", dbl=(*BAR, *ADJ), txt=("date", "window_start"))
def a1_late(spark, sf):
    return adjust.adjust_by_intervals(*_late(spark, sf, "one"))


@query(
    "a3_late_events",
    with_views("v_day_bars", "v_splits", "v_dividends", more=_adjusted("split_only"))
    + f" FINAL SELECT d.ticker, d.date, open, high, low, close, volume, transactions, {_ADJ}, trunc(volume * scum) AS adj_volume FROM d JOIN c USING (ticker, date)",
    dbl=(*BAR, *ADJ), txt=("date",), big=("adj_volume",),
)
def a3_late(spark, sf):
    return adjust.adjust_by_intervals(*_late(spark, sf, "split_only"), "reference").drop("window_start")


_SESSION = {
    "s": "SELECT *, CAST(window_start AS DATE) AS date FROM v_minute_bars WHERE CAST(window_start AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:00:00'",
}
_TOP = {
    **_SESSION,
    "top": """SELECT date, ticker FROM (SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY v DESC, ticker) AS r
              FROM (SELECT date, ticker, sum(close * volume) AS v FROM s GROUP BY 1, 2)) WHERE r <= 4""",
    "k": "SELECT s.* FROM s SEMI JOIN top ON s.date = top.date AND s.ticker = top.ticker",
}
_DENSE = {
    **_TOP,
    "g": """SELECT t.date, t.ticker, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS window_start
            FROM (SELECT DISTINCT date, ticker FROM k) t JOIN (SELECT date, min(window_start) AS lo, max(window_start) AS hi FROM k GROUP BY date) b ON t.date = b.date""",
    "j": "SELECT g.date, g.ticker, g.window_start, open, high, low, close, coalesce(volume, 0) AS volume, coalesce(transactions, 0) AS transactions FROM g LEFT JOIN k ON g.date = k.date AND g.ticker = k.ticker AND g.window_start = k.window_start",
    "b": "SELECT date, ticker, window_start, "
    + ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER w, first_value({c} IGNORE NULLS) OVER a) AS {c}" for c in BAR)
    + ", volume, transactions FROM j WINDOW w AS (PARTITION BY date, ticker ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY date, ticker ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
}


def _ewm(c: str, alpha: str) -> str:
    return f"sum({c} * power(1 - {alpha}, -i)) OVER w / sum(power(1 - {alpha}, -i)) OVER w"


_GROW = "WINDOW w AS (PARTITION BY date, ticker ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FILLED = lambda c: f"coalesce(last_value({c} IGNORE NULLS) OVER w, first_value({c} IGNORE NULLS) OVER a) AS {c}"
_MATRIX = {
    **_DENSE,
    "n": """SELECT *, row_number() OVER o AS i, greatest(coalesce(close - lag(close) OVER o, 0.0), 0.0) AS gain, greatest(coalesce(lag(close) OVER o - close, 0.0), 0.0) AS loss
            FROM b WINDOW o AS (PARTITION BY date, ticker ORDER BY window_start)""",
    "e": f"""SELECT *, {_ewm('close', '(2.0::DOUBLE / 13)')} AS ema12, {_ewm('close', '(2.0::DOUBLE / 27)')} AS ema26, {_ewm('gain', '(1.0::DOUBLE / 14)')} AS up, {_ewm('loss', '(1.0::DOUBLE / 14)')} AS down,
             sum((high + low + close) / 3 * volume) OVER w AS pv, sum(volume) OVER w AS vv FROM n {_GROW}""",
    "r": """SELECT *, ema12 - ema26 AS macd, CASE WHEN down = 0 AND up > 0 THEN 100.0 WHEN down > 0 THEN 100.0 - 100.0 / (1.0 + up / down) END AS rsi,
            CASE WHEN vv > 0 THEN pv / vv END AS vwap, CASE WHEN transactions > 0 THEN volume / transactions ELSE 0.0 END AS atv FROM e""",
    "x": f"SELECT date, window_start, ticker, open, high, low, close, volume, ema12, ema26, macd, {_FILLED('rsi')}, {_FILLED('vwap')}, atv FROM r {_GROW}, a AS (PARTITION BY date, ticker ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
}
IND = ("ema12", "ema26", "macd", "rsi", "vwap", "atv")


@query("m1_session_filter", with_views("v_minute_bars", more=_SESSION) + " FINAL SELECT ticker, window_start, close FROM s", dbl=("close",), txt=("window_start",))
def m1(spark, sf):
    return times.session_filter(v.minute_bars(spark, sf)).select("ticker", "window_start", "close")


@query("m2_top_tickers", with_views("v_minute_bars", more=_TOP) + " FINAL SELECT date, ticker, window_start, close, volume FROM k", dbl=("close",), txt=("date", "window_start"))
def m2(spark, sf):
    s = dated(times.session_filter(v.minute_bars(spark, sf)))
    return top_n_by(s, ["date"], "ticker", F.col("close") * F.col("volume"), 4).select("date", "ticker", "window_start", "close", "volume")


@query("m3_dense_grid", with_views("v_minute_bars", more=_DENSE) + " FINAL SELECT * FROM b", dbl=BAR, txt=("date", "window_start"))
def m3(spark, sf):
    return matrix.dense_bars(v.minute_bars(spark, sf), 4)


def _dense(spark, sf):
    return matrix.dense_bars(v.minute_bars(spark, sf), 4)


def _indicator(name: str, *columns: str):
    return query(name, with_views("v_minute_bars", more=_MATRIX) + f" FINAL SELECT date, ticker, window_start, {', '.join(columns)} FROM x", dbl=columns, txt=("date", "window_start"))


@_indicator("m4_ema_macd", "ema12", "ema26", "macd")
def m4(spark, sf):
    return matrix.macd(_dense(spark, sf)).select("date", "ticker", "window_start", "ema12", "ema26", "macd")


@_indicator("m5_rsi", "rsi")
def m5(spark, sf):
    return matrix.rsi(_dense(spark, sf)).select("date", "ticker", "window_start", "rsi")


@_indicator("m6_vwap", "vwap")
def m6(spark, sf):
    return matrix.vwap(_dense(spark, sf)).select("date", "ticker", "window_start", "vwap")


@_indicator("m7_atv", "atv")
def m7(spark, sf):
    return matrix.atv(_dense(spark, sf)).select("date", "ticker", "window_start", "atv")


_TICKERS, _METRICS = ("click", "error", "purchase", "signup", "view"), ("close", "volume")


@query(
    "m8_wide_pivot",
    with_views("v_minute_bars", more=_DENSE)
    + " FINAL SELECT date, window_start, "
    + ", ".join(f"first({m}) FILTER (ticker = '{t}') AS {t}_{m}" for t in _TICKERS for m in _METRICS)
    + " FROM b GROUP BY date, window_start",
    dbl=tuple(f"{t}_{m}" for t in _TICKERS for m in _METRICS), txt=("date", "window_start"),
)
def m8(spark, sf):
    return matrix.to_wide(_dense(spark, sf), _TICKERS, _METRICS)


@query("m9_null_gate", with_views("v_minute_bars", more=_MATRIX) + " FINAL SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in (*BAR, "volume", *IND)) + " FROM x")
def m9(spark, sf):
    full = matrix.stocks_matrix(v.minute_bars(spark, sf), 4)
    return consolidate.count_nulls(consolidate.assert_no_nulls(full, columns=[*BAR, "volume", *IND]), [*BAR, "volume", *IND])


@query("m10_stocks_matrix", with_views("v_minute_bars", more=_MATRIX) + " FINAL SELECT * FROM x", dbl=(*BAR, *IND), txt=("date", "window_start"))
def m10(spark, sf):
    return matrix.stocks_matrix(v.minute_bars(spark, sf), 4)


_PRICE = "(coalesce(open, 0) + coalesce(high, 0) + coalesce(low, 0) + coalesce(close, 0)) / nullif((open IS NOT NULL)::INT + (high IS NOT NULL)::INT + (low IS NOT NULL)::INT + (close IS NOT NULL)::INT, 0)"
_OPTIONS = {
    "p": f"SELECT date, underlying, ticker, window_start, {_PRICE} AS price, volume FROM v_option_bars WHERE underlying IN ('SPX', 'SPXW', 'XSP', 'XSPW', 'VIX', 'VIXW', 'NVDA')",
    "o": "SELECT date, underlying, ticker FROM p GROUP BY 1, 2, 3 HAVING count(price) / 391.0 > 0.05",
    "g": "SELECT *, unnest(generate_series(CAST(date AS TIMESTAMP) + INTERVAL 570 MINUTE, CAST(date AS TIMESTAMP) + INTERVAL 960 MINUTE, INTERVAL 1 MINUTE)) AS window_start FROM o",
    "j": "SELECT g.date, g.underlying, g.ticker, g.window_start, price, coalesce(volume, 0) AS volume FROM g LEFT JOIN p ON g.date = p.date AND g.ticker = p.ticker AND g.window_start = p.window_start",
}


@query(
    "m11_options_matrix",
    with_views("v_option_bars", more=_OPTIONS)
    + """ FINAL SELECT date, underlying, ticker, window_start, coalesce(last_value(price IGNORE NULLS) OVER w, first_value(price IGNORE NULLS) OVER a) AS price, volume
          FROM j WINDOW w AS (PARTITION BY date, ticker ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY date, ticker ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    dbl=("price",), txt=("date", "window_start"),
)
def m11(spark, sf):
    valid = v.table(spark, sf, "region").limit(1).select(F.lit("NVDA").alias("underlying"))
    return matrix.options_matrix(v.option_bars(spark, sf), valid)


_FLOW = {
    "top": "SELECT underlying FROM (SELECT underlying, row_number() OVER (ORDER BY sum(volume) DESC, underlying) AS r FROM v_option_bars GROUP BY underlying) WHERE r <= 3",
    "am": "SELECT date, underlying, type, window_start, sum(volume) AS v, sum(volume * strike) AS vs FROM v_option_bars SEMI JOIN top USING (underlying) GROUP BY 1, 2, 3, 4",
    "ex": "SELECT DISTINCT date, type, window_start FROM am",
    "g": """SELECT u.date, u.underlying, t.type, unnest(generate_series(CAST(u.date AS TIMESTAMP) + INTERVAL 570 MINUTE, CAST(u.date AS TIMESTAMP) + INTERVAL 960 MINUTE, INTERVAL 1 MINUTE)) AS window_start
            FROM (SELECT DISTINCT date, underlying FROM am) u, (VALUES ('C'), ('P')) t(type)""",
    "x": """SELECT g.*, CASE WHEN am.v IS NOT NULL THEN am.v::DOUBLE WHEN ex.type IS NULL THEN 0.0 END AS v, CASE WHEN am.vs IS NOT NULL THEN am.vs::DOUBLE WHEN ex.type IS NULL THEN 0.0 END AS vs, coalesce(am.v, 0) AS n
            FROM g LEFT JOIN am ON g.date = am.date AND g.underlying = am.underlying AND g.type = am.type AND g.window_start = am.window_start
            LEFT JOIN ex ON g.date = ex.date AND g.type = ex.type AND g.window_start = ex.window_start""",
    # between valid values the old mean decays; a fold over the valid ones only, with the gap to the last
    "va": "SELECT *, row_number() OVER (PARTITION BY underlying, type ORDER BY window_start) AS i FROM x",
    "vb": "SELECT *, i - lag(i) OVER (PARTITION BY underlying, type ORDER BY window_start) AS gap, row_number() OVER (PARTITION BY underlying, type ORDER BY window_start) AS k FROM va WHERE v IS NOT NULL",
    "rec": """SELECT underlying, type, k, i, v AS ev, vs AS es FROM vb WHERE k = 1
              UNION ALL SELECT b.underlying, b.type, b.k, b.i,
                     (power(9.0::DOUBLE / 11, b.gap) * r.ev + (2.0::DOUBLE / 11) * b.v) / (power(9.0::DOUBLE / 11, b.gap) + 2.0::DOUBLE / 11),
                     (power(9.0::DOUBLE / 11, b.gap) * r.es + (2.0::DOUBLE / 11) * b.vs) / (power(9.0::DOUBLE / 11, b.gap) + 2.0::DOUBLE / 11)
              FROM rec r JOIN vb b ON b.underlying = r.underlying AND b.type = r.type AND b.k = r.k + 1""",
    "m": """SELECT a.date, a.underlying, a.type, a.window_start, a.n, coalesce(last_value(rec.es IGNORE NULLS) OVER w / nullif(last_value(rec.ev IGNORE NULLS) OVER w, 0), 0) AS mean
            FROM va a LEFT JOIN rec ON rec.underlying = a.underlying AND rec.type = a.type AND rec.i = a.i
            WINDOW w AS (PARTITION BY a.underlying, a.type ORDER BY a.i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}


@query(
    "m12_option_flow_matrix",
    with_views("v_option_bars", more=_FLOW).replace("WITH ", "WITH RECURSIVE ", 1)
    + """ FINAL SELECT date, window_start, underlying, max(n) FILTER (type = 'C') AS C_volume, max(n) FILTER (type = 'P') AS P_volume,
          max(mean) FILTER (type = 'C') AS C_vwas_ema10, max(mean) FILTER (type = 'P') AS P_vwas_ema10 FROM m GROUP BY 1, 2, 3""",
    dbl=("C_vwas_ema10", "P_vwas_ema10"), txt=("date", "window_start"), big=("C_volume", "P_volume"),
)
def m12(spark, sf):
    return matrix.option_flow_matrix(v.option_bars(spark, sf), 3)


@query(
    "m13_merge_matrices",
    with_views("v_minute_bars", more={**_DENSE, "fl": "SELECT CAST(window_start AS DATE) AS date, window_start, ticker, sum(transactions) AS C_volume FROM v_minute_bars GROUP BY 1, 2, 3"})
    + " FINAL SELECT b.date, b.window_start, b.ticker, b.close, fl.C_volume FROM b JOIN fl ON b.date = fl.date AND b.window_start = fl.window_start AND b.ticker = fl.ticker",
    dbl=("close",), txt=("date", "window_start"), big=("C_volume",),
)
def m13(spark, sf):
    bars = dated(v.minute_bars(spark, sf))
    flow = bars.groupBy("date", "window_start", F.col("ticker").alias("underlying")).agg(F.sum("transactions").alias("C_volume"))
    return matrix.merge_matrices(_dense(spark, sf).select("date", "window_start", "ticker", "close"), flow)


# ---- ticks

#: Seconds of an interval.
STEP = 10


def _bin(ts: str) -> str:
    return f"date_trunc('day', {ts}) + to_seconds(CAST(floor((extract('hour' FROM {ts}) * 3600 + extract('minute' FROM {ts}) * 60 + floor(extract('second' FROM {ts}))) / {STEP}) * {STEP} AS INTEGER))"


def _ticks(prefix: str, keys: str, on: str, volume: str) -> dict[str, str]:
    q_cols = ", ".join(f"arg_max({c}, ts * 1000000 + seq) AS {c}" for c in ("bid", "bid_size", "ask", "ask_size"))
    micros = "epoch_us(ts)::HUGEINT AS ts"
    fill = lambda c: f"last_value({c} IGNORE NULLS) OVER w AS {c}"
    return {
        "q": f"SELECT date, {keys}, bin, {q_cols} FROM (SELECT CAST(ts AS DATE) AS date, {_bin('ts')} AS bin, * REPLACE ({micros}) FROM v_{prefix}quotes) GROUP BY ALL",
        "t": f"SELECT date, {keys}, bin, arg_max(price, ts * 1000000 + seq) AS last, arg_max(size, ts * 1000000 + seq) AS last_size, sum(size) AS volume FROM (SELECT CAST(ts AS DATE) AS date, {_bin('ts')} AS bin, * REPLACE ({micros}) FROM v_{prefix}trades) GROUP BY ALL",
        "qg": f"SELECT date, {keys}, unnest(generate_series(lo, hi, INTERVAL {STEP} SECOND)) AS bin FROM (SELECT date, {keys}, min(bin) AS lo, max(bin) AS hi FROM q GROUP BY ALL)",
        "tg": f"SELECT date, {keys}, unnest(generate_series(lo, hi, INTERVAL {STEP} SECOND)) AS bin FROM (SELECT date, {keys}, min(bin) AS lo, max(bin) AS hi FROM t GROUP BY ALL)",
        "qd": f"SELECT * FROM qg LEFT JOIN q USING ({on}, bin)",
        "td": f"SELECT * REPLACE (coalesce(volume, 0) AS volume) FROM tg LEFT JOIN t USING ({on}, bin)",
        "mg": f"SELECT {on}, bin AS window_start, last, last_size, volume, bid, bid_size, ask, ask_size FROM td FULL JOIN qd USING ({on}, bin)",
        "ff": f"SELECT {on}, window_start, {fill('last')}, {fill('last_size')}, {volume}, {fill('bid')}, {fill('bid_size')}, {fill('ask')}, {fill('ask_size')} FROM mg WINDOW w AS (PARTITION BY {on} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "fin": f"""SELECT * EXCLUDE (ok) FROM (SELECT *, bool_or(last IS NOT NULL AND bid IS NOT NULL AND bid <> 0 AND ask IS NOT NULL AND ask <> 0 AND bid_size IS NOT NULL AND bid_size <> 0 AND ask_size IS NOT NULL AND ask_size <> 0)
                   OVER (PARTITION BY {on} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ok FROM ff) WHERE ok""",
    }


_FF_VOLUME = "last_value(volume IGNORE NULLS) OVER w AS volume"
_STOCK = _ticks("", "ticker", "date, ticker", _FF_VOLUME)
_CONTRACT = "underlying, expiry, type, strike"
_OPTION = _ticks("option_", _CONTRACT, f"date, {_CONTRACT}", "coalesce(volume, 0) AS volume")
_STOCK_SQL = with_views("v_trades", "v_quotes", more=_STOCK)
_OPTION_SQL = with_views("v_option_trades", "v_option_quotes", more=_OPTION)
_TIMES = ("date", "window_start")
_PRICES = ("last", "bid", "ask")
_SIZES = ("volume", "last_size", "bid_size", "ask_size")


@query("q1_resample_quotes", _STOCK_SQL + " FINAL SELECT date, ticker, bin AS window_start, bid, bid_size, ask, ask_size FROM q", dbl=("bid", "ask"), txt=_TIMES)
def q1(spark, sf):
    return ticks.resample_quotes(v.quotes(spark, sf), ["ticker"], STEP)


@query("q2_resample_trades", _STOCK_SQL + " FINAL SELECT date, ticker, bin AS window_start, last, last_size, volume FROM t", dbl=("last",), txt=_TIMES, big=("volume",))
def q2(spark, sf):
    return ticks.resample_trades(v.trades(spark, sf), ["ticker"], STEP)


@query("q3_dense_bins", _STOCK_SQL + " FINAL SELECT date, ticker, bin AS window_start, last, volume FROM td", dbl=("last",), txt=_TIMES, big=("volume",))
def q3(spark, sf):
    bars = ticks.resample_trades(v.trades(spark, sf), ["ticker"], STEP)
    dense = densify(bars, ["date", "ticker"], "window_start", STEP, zero=["volume"])
    return dense.select("date", "ticker", "window_start", F.when(~F.col("is_new"), F.col("last")).alias("last"), "volume")


@query("q4_merge_sides", _STOCK_SQL + " FINAL SELECT * FROM mg", dbl=(*_PRICES, *_SIZES), txt=_TIMES)
def q4(spark, sf):
    return ticks.dense_sides(v.trades(spark, sf), v.quotes(spark, sf), ["ticker"], STEP)


@query("q5_forward_fill", _STOCK_SQL + " FINAL SELECT * FROM ff", dbl=(*_PRICES, *_SIZES), txt=_TIMES)
def q5(spark, sf):
    return ticks.fill_ticks(ticks.dense_sides(v.trades(spark, sf), v.quotes(spark, sf), ["ticker"], STEP), ["ticker"], True)


@query("q6_drop_leading", _OPTION_SQL + " FINAL SELECT date, underlying, type, strike, window_start, last, bid, ask FROM fin", dbl=(*_PRICES, "strike"), txt=_TIMES)
def q6(spark, sf):
    keys = ["underlying", "expiry", "type", "strike"]
    filled = ticks.fill_ticks(ticks.dense_sides(v.option_trades(spark, sf), v.option_quotes(spark, sf), keys, STEP), keys, False)
    return ticks.drop_leading_incomplete(filled, keys).select("date", "underlying", "type", "strike", "window_start", "last", "bid", "ask")


@query("q7_stock_tq_bars", _STOCK_SQL + " FINAL SELECT * FROM fin", dbl=_PRICES, txt=_TIMES, big=("volume",))
def q7(spark, sf):
    return ticks.stock_tq_bars(v.trades(spark, sf), v.quotes(spark, sf), STEP)


@same_rows("q7_stream_bins", "q7_stock_tq_bars")
def q7_stream(spark, sf):
    """The same bars from intervals that a stream has stored: ticks in any order, then one far ahead that moves the watermark past them."""
    base = shared_path(spark, "stream")
    sides = {"trades": v.trades(spark, sf), "quotes": v.quotes(spark, sf)}
    for name, df in sides.items():
        df.repartition(3, "seq").write.parquet(f"{base}/{name}")
    read = lambda name: spark.readStream.schema(sides[name].schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")
    for _ in range(2):
        bins = incremental.stream_bins(read("trades"), read("quotes"), ["ticker"], STEP, late="400 days")
        bins.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/bins").awaitTermination()
        for name, df in sides.items():  # taken up by the second call
            ahead = df.limit(1).withColumns({"ticker": F.lit(None).cast("string"), "ts": F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")})
            ahead.write.mode("append").parquet(f"{base}/{name}")
    return ticks.tq_bars_of_bins(spark.read.parquet(f"{base}/bins").filter("ticker IS NOT NULL"), ["ticker"], STEP, True)


@query("q8_option_tq_bars", _OPTION_SQL + " FINAL SELECT * FROM fin", dbl=(*_PRICES, "strike"), txt=_TIMES, big=("volume", "expiry"))
def q8(spark, sf):
    return ticks.option_tq_bars(v.option_trades(spark, sf), v.option_quotes(spark, sf), STEP)


_SPREADS = {
    **_STOCK,
    "ses": """SELECT date, ticker, ask - bid AS x, (ask - bid) / last AS f, CASE WHEN CAST(window_start AS TIME) BETWEEN TIME '04:00:00' AND TIME '09:29:59' THEN 'pre'
              WHEN CAST(window_start AS TIME) BETWEEN TIME '09:30:00' AND TIME '15:59:59' THEN 'day' WHEN CAST(window_start AS TIME) BETWEEN TIME '16:00:00' AND TIME '20:00:00' THEN 'post' END AS s FROM fin""",
    "rej": """SELECT date, ticker, s, CASE WHEN abs(x - avg(x) OVER w) <= 3 * stddev_samp(x) OVER w + 1e-12::DOUBLE * abs(avg(x) OVER w) THEN x END AS x,
              CASE WHEN abs(f - avg(f) OVER w) <= 3 * stddev_samp(f) OVER w + 1e-12::DOUBLE * abs(avg(f) OVER w) THEN f END AS f FROM ses WINDOW w AS (PARTITION BY date, ticker, s)""",
}
_STATS = [(s, a, n) for s in ("pre", "day", "post") for a, n in (("x", ""), ("f", "_frac"))]


@query(
    "q9_bidask_spreads",
    with_views("v_trades", "v_quotes", more=_SPREADS) + " FINAL SELECT date, ticker, " + ", ".join(f"avg({a}) FILTER (s = '{s}') AS {s}_mean{n}, stddev_samp({a}) FILTER (s = '{s}') AS {s}_std{n}" for s, a, n in _STATS) + " FROM rej GROUP BY date, ticker",
    dbl=tuple(f"{s}_{m}{n}" for s, _, n in _STATS for m in ("mean", "std")), txt=("date",),
)
def q9(spark, sf):
    return ticks.bidask_spreads(ticks.stock_tq_bars(v.trades(spark, sf), v.quotes(spark, sf), STEP))
