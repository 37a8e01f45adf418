"""Queries of option analytics and studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import times
from ..operators import options, studies
from . import views as v
from .registry import query
from .views import with_views

CHAIN = options.CHAIN
_OHLC4 = "(open + high + low + close) / 4.0"
_EXPIRY = "strptime('20' || CAST(expiry AS VARCHAR), '%Y%m%d')::DATE"


@query("o1_filter_underlying", with_views("v_option_bars") + " FINAL SELECT ticker, window_start, close FROM v_option_bars WHERE underlying IN ('SPX', 'SPXW')", dbl=("close",), txt=("window_start",))
def o1(spark, sf):
    return options.filter_underlying(v.option_bars(spark, sf), "spx").select("ticker", "window_start", "close")


_CHOOSE = f"""SELECT trade_id, expiry FROM (SELECT trade_id, expiry, row_number() OVER (PARTITION BY trade_id ORDER BY {_EXPIRY} < date + dte, abs({_EXPIRY} - (date + dte)), expiry) AS r
              FROM (SELECT t.trade_id, t.date, t.dte, e.expiry FROM v_spread_trades t JOIN (SELECT DISTINCT date, underlying, expiry FROM v_option_bars) e ON e.date = t.date AND e.underlying = t.underlying)) WHERE r = 1"""


@query("o2_choose_expiry", with_views("v_option_bars", "v_spread_trades", more={"ch": _CHOOSE}) + " FINAL SELECT t.trade_id, t.dte, ch.expiry FROM v_spread_trades t JOIN ch USING (trade_id)", big=("dte", "expiry"))
def o2(spark, sf):
    return options.with_expiry(v.spread_trades(spark, sf), v.option_bars(spark, sf)).filter(F.col("expiry").isNotNull()).select("trade_id", "dte", "expiry")


_KEYS = "date, underlying, expiry, type, strike"
_REST = ("open", "high", "low", "close", "volume", "transactions")
_CHAIN_SQL = {
    "lim": "SELECT date, underlying, expiry, min(window_start) AS lo, max(window_start) AS hi FROM v_option_bars GROUP BY 1, 2, 3",
    "g": f"SELECT k.*, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS window_start FROM (SELECT DISTINCT {_KEYS} FROM v_option_bars) k JOIN lim USING (date, underlying, expiry)",
    "cc": f"SELECT {_KEYS}, window_start, "
    + ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER w, first_value({c} IGNORE NULLS) OVER a) AS {c}" for c in _REST)
    + f" FROM g LEFT JOIN v_option_bars USING ({_KEYS}, window_start) WINDOW w AS (PARTITION BY {_KEYS} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY {_KEYS} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
}


def _chain(spark, sf):
    bars = v.option_bars(spark, sf).select(*options.CONTRACT, "window_start", *_REST)
    return options.continuous_chain(bars)


@query("o3_continuous_chain", with_views("v_option_bars", more=_CHAIN_SQL) + f" FINAL SELECT {_KEYS}, window_start, open, high, low, close, volume, transactions FROM cc", dbl=("strike", "open", "high", "low", "close"), txt=("date", "window_start"), big=("expiry",))
def o3(spark, sf):
    return _chain(spark, sf)


_LEG_ROWS = " UNION ALL ".join(
    f"SELECT * EXCLUDE (trade_type), '{leg}' AS leg, '{kind}' AS type, center + {k}::DOUBLE * width AS strike, {pos} AS pos, trade_type FROM v_spread_trades WHERE trade_type = '{t}'"
    for t, spec in options.LEGS.items()
    for leg, kind, k, pos in spec
)
_LEGS_SQL = {**_CHAIN_SQL, "ch": _CHOOSE, "lg": f"SELECT l.*, ch.expiry FROM ({_LEG_ROWS}) l LEFT JOIN ch USING (trade_id)"}
_PRICED = {
    **_LEGS_SQL,
    "pr": f"""SELECT lg.*, c.price FROM lg LEFT JOIN lim ON lim.date = lg.date AND lim.underlying = lg.underlying AND lim.expiry = lg.expiry
              LEFT JOIN (SELECT {_KEYS}, window_start, {_OHLC4} AS price FROM cc) c ON c.date = lg.date AND c.underlying = lg.underlying AND c.expiry = lg.expiry AND c.type = lg.type
              AND abs(c.strike - lg.strike) < 0.001 AND c.window_start = least(greatest(lg.entry_time, lim.lo), lim.hi)""",
    "cr": "SELECT trade_id, CASE WHEN count(price) = count(*) THEN sum(pos * price) END AS credit, count(*) - count(price) AS n_missing FROM pr GROUP BY trade_id",
}
_ALL = lambda more: with_views("v_option_bars", "v_spread_trades", more=more)


def _trades(spark, sf):
    return options.with_expiry(v.spread_trades(spark, sf), v.option_bars(spark, sf))


@query("o4_lookup_leg_prices", _ALL(_PRICED) + " FINAL SELECT trade_id, leg, strike, price FROM pr", dbl=("strike", "price"))
def o4(spark, sf):
    return options.lookup_leg_prices(v.option_bars(spark, sf), options.spread_legs(_trades(spark, sf))).select("trade_id", "leg", "strike", "price")


_DIFF = {
    **_CHAIN_SQL,
    "pv": f"SELECT date, underlying, expiry, window_start, strike, avg(p) FILTER (type = 'C') - avg(p) FILTER (type = 'P') AS d FROM (SELECT *, {_OHLC4} AS p FROM cc) GROUP BY 1, 2, 3, 4, 5",
    "nx": "SELECT *, lead(strike) OVER w AS s1, lead(d) OVER w AS d1 FROM pv WHERE d IS NOT NULL WINDOW w AS (PARTITION BY date, underlying, expiry, window_start ORDER BY strike)",
    "hit": "SELECT *, CASE WHEN d = 0 AND s1 IS NOT NULL THEN strike WHEN d * d1 < 0 THEN strike - d * ((s1 - strike) / (d1 - d)) END AS h FROM nx",
    "im": """SELECT date, underlying, expiry, window_start, coalesce(first(h ORDER BY strike) FILTER (h IS NOT NULL), first(strike ORDER BY abs(d), strike)) AS implied FROM hit GROUP BY 1, 2, 3, 4""",
}


@query("o5_implied_underlying", with_views("v_option_bars", more=_DIFF) + " FINAL SELECT * FROM im", dbl=("implied",), txt=("date", "window_start"), big=("expiry",))
def o5(spark, sf):
    return options.implied_underlying(_chain(spark, sf))


_CLOSE = {
    "pv": "SELECT date, underlying, expiry, window_start, strike, avg(close) FILTER (type = 'C') - avg(close) FILTER (type = 'P') AS d FROM v_option_bars GROUP BY 1, 2, 3, 4, 5",
    "nx": "SELECT *, lead(strike) OVER w AS s1, lead(d) OVER w AS d1 FROM pv WINDOW w AS (PARTITION BY date, underlying, expiry, window_start ORDER BY strike)",
    "hit": "SELECT *, CASE WHEN d * d1 < 0 THEN strike - d * ((s1 - strike) / (d1 - d)) END AS h FROM nx",
    "im": """SELECT date, underlying, expiry, window_start, coalesce(first(h ORDER BY strike) FILTER (h IS NOT NULL), first(strike ORDER BY abs(d), strike) FILTER (d IS NOT NULL)) AS implied FROM hit GROUP BY 1, 2, 3, 4""",
}


@query("o6_implied_underlying_close", with_views("v_option_bars", more=_CLOSE) + " FINAL SELECT * FROM im WHERE implied IS NOT NULL", dbl=("implied",), txt=("date", "window_start"), big=("expiry",))
def o6(spark, sf):
    return options.implied_underlying(v.option_bars(spark, sf), price="close")


_OPEN = {
    "fm": "SELECT * FROM (SELECT *, min(window_start) OVER (PARTITION BY date, underlying, expiry) AS f FROM v_option_bars) WHERE window_start = f",
    "od": "SELECT date, underlying, expiry, strike, abs(avg(close) FILTER (type = 'C') - avg(close) FILTER (type = 'P')) AS d FROM fm GROUP BY 1, 2, 3, 4",
    "io": "SELECT date, underlying, expiry, first(strike ORDER BY d, strike) AS implied FROM od WHERE d IS NOT NULL GROUP BY 1, 2, 3",
}


@query("o7_implied_underlying_open", with_views("v_option_bars", more=_OPEN) + " FINAL SELECT * FROM io", dbl=("implied",), txt=("date",), big=("expiry",))
def o7(spark, sf):
    return options.implied_underlying_open(v.option_bars(spark, sf))


@query("o8_spread_legs", with_views("v_spread_trades", more={"lg": _LEG_ROWS}) + " FINAL SELECT trade_id, trade_type, leg, type, strike, pos FROM lg", dbl=("strike",), big=("pos",))
def o8(spark, sf):
    return options.spread_legs(v.spread_trades(spark, sf)).select("trade_id", "trade_type", "leg", "type", "strike", "pos")


@query("o9_spread_credit", _ALL(_PRICED) + " FINAL SELECT * FROM cr", dbl=("credit",))
def o9(spark, sf):
    return options.spread_credit(_trades(spark, sf), v.option_bars(spark, sf))


_INTRINSIC = "CASE WHEN type = 'C' THEN greatest({s} - strike, 0.0) ELSE greatest(strike - {s}, 0.0) END"
_PAYOFF = {
    **_PRICED,
    "gr": "SELECT pr.*, cr.credit, i, center - 3 * width + 6 * width * (i / 199.0::DOUBLE) AS s FROM pr JOIN cr USING (trade_id), range(200) r(i) WHERE cr.credit IS NOT NULL",
}


@query("o10_spread_payoff", _ALL(_PAYOFF) + f" FINAL SELECT trade_id, i, s, first(credit) - sum(pos * {_INTRINSIC.format(s='s')}) AS payoff FROM gr GROUP BY trade_id, i, s", dbl=("s", "payoff"), big=("i",))
def o10(spark, sf):
    trades = _trades(spark, sf)
    return options.spread_payoff(trades, options.spread_credit(trades, v.option_bars(spark, sf)))


_PATH = {
    **_LEGS_SQL,
    **{k: _DIFF[k] for k in ("pv", "nx", "hit", "im")},
    "pp": f"""SELECT lg.trade_id, c.window_start, count(*) AS have, sum(pos * {_OHLC4}) AS credit, any_value(im.implied) AS implied, sum(pos * CASE WHEN lg.type = 'C' THEN greatest(im.implied - lg.strike, 0.0) ELSE greatest(lg.strike - im.implied, 0.0) END) AS owed
              FROM lg JOIN cc c ON c.date = lg.date AND c.underlying = lg.underlying AND c.expiry = lg.expiry AND c.type = lg.type AND abs(c.strike - lg.strike) < 0.001 AND c.window_start >= lg.entry_time
              JOIN im ON im.date = c.date AND im.underlying = c.underlying AND im.expiry = c.expiry AND im.window_start = c.window_start GROUP BY 1, 2""",
}


@query(
    "o11_spread_path",
    _ALL(_PATH) + " FINAL SELECT pp.trade_id, window_start, credit, implied, credit - owed AS payoff FROM pp JOIN (SELECT trade_id, count(*) AS n FROM lg GROUP BY trade_id) k ON k.trade_id = pp.trade_id WHERE have = n",
    dbl=("credit", "implied", "payoff"), txt=("window_start",),
)
def o11(spark, sf):
    bars = v.option_bars(spark, sf).select(*options.CONTRACT, "window_start", *options.OHLC)
    return options.spread_path(_trades(spark, sf), bars)


@query(
    "o12_chain_snapshot",
    with_views("v_option_bars", more={"n": "SELECT *, abs(date_diff('second', TIMESTAMP '2024-01-02 12:00:20', window_start)) AS gap FROM v_option_bars"})
    + " FINAL SELECT ticker, window_start, strike, close FROM n WHERE gap <= 300 AND gap = (SELECT min(gap) FROM n)",
    dbl=("strike", "close"), txt=("window_start",),
)
def o12(spark, sf):
    return options.chain_snapshot(v.option_bars(spark, sf), "2024-01-02 12:00:20").select("ticker", "window_start", "strike", "close")


@query(
    "o13_chain_limits",
    with_views("v_option_bars") + """ FINAL SELECT date, underlying, expiry, avg(strike) - stddev_samp(strike) AS x_min, avg(strike) + stddev_samp(strike) AS x_max, greatest(avg(close) - stddev_samp(close), -0.1) AS y_min,
        avg(close) + stddev_samp(close) AS y_max FROM v_option_bars GROUP BY 1, 2, 3""",
    dbl=("x_min", "x_max", "y_min", "y_max"), txt=("date",), big=("expiry",),
)
def o13(spark, sf):
    return options.chain_limits(v.option_bars(spark, sf))


@query(
    "o14_volume_by_strike",
    with_views(
        "v_option_bars",
        more={
            "e": f"SELECT date, underlying, expiry FROM (SELECT *, row_number() OVER (PARTITION BY date, underlying ORDER BY {_EXPIRY} < date + 10, abs({_EXPIRY} - (date + 10)), expiry) AS r FROM (SELECT DISTINCT date, underlying, expiry FROM v_option_bars)) WHERE r = 1",
            "s": "SELECT date, underlying, expiry, window_start, strike, sum(volume) AS volume FROM v_option_bars SEMI JOIN e USING (date, underlying, expiry) GROUP BY 1, 2, 3, 4, 5",
        },
    )
    + " FINAL SELECT *, max(volume) OVER (PARTITION BY date, underlying) * 1.1::DOUBLE AS y_max FROM s",
    dbl=("strike", "y_max"), txt=("date", "window_start"), big=("expiry", "volume"),
)
def o14(spark, sf):
    return options.volume_by_strike(v.option_bars(spark, sf), dte=10)


_PROFILE = {
    "s": "SELECT date, underlying, expiry, window_start, strike, sum(volume) AS v FROM v_option_bars GROUP BY 1, 2, 3, 4, 5",
    "m": "SELECT DISTINCT date, underlying, expiry, window_start FROM s",
    "c": "SELECT m.date, m.underlying, m.expiry, m.window_start, s.strike, sum(s.v) AS cum FROM m JOIN s ON s.date = m.date AND s.underlying = m.underlying AND s.expiry = m.expiry AND s.window_start <= m.window_start GROUP BY 1, 2, 3, 4, 5",
    "sh": "SELECT *, cum / sum(cum) OVER w::DOUBLE AS share FROM c WINDOW w AS (PARTITION BY date, underlying, expiry, window_start)",
    "ru": "SELECT *, sum(share) OVER (PARTITION BY date, underlying, expiry, window_start ORDER BY strike) AS run, sum(strike * share) OVER (PARTITION BY date, underlying, expiry, window_start) AS mu FROM sh",
}


@query(
    "o15_volume_profile",
    with_views("v_option_bars", more=_PROFILE)
    + " FINAL SELECT date, underlying, expiry, window_start, first(mu) AS mean, sqrt(sum(share * power(strike - mu, 2))) AS std, min(strike) FILTER (run >= 0.5 - 1e-12) AS median, first(strike ORDER BY cum DESC, strike) AS mode FROM ru GROUP BY 1, 2, 3, 4",
    dbl=("mean", "std", "median", "mode"), txt=("date", "window_start"), big=("expiry",),
)
def o15(spark, sf):
    return options.volume_profile(v.option_bars(spark, sf))


_SURFACE = {
    "cl": f"SELECT {_KEYS}, window_start, avg(close) AS close FROM v_option_bars GROUP BY ALL",
    "lim": _CHAIN_SQL["lim"],
    "g": f"SELECT k.*, lo, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS window_start FROM (SELECT DISTINCT {_KEYS} FROM cl) k JOIN lim USING (date, underlying, expiry)",
    "f": f"SELECT {_KEYS}, lo, window_start, coalesce(last_value(close IGNORE NULLS) OVER w, first_value(close IGNORE NULLS) OVER a) AS close FROM g LEFT JOIN cl USING ({_KEYS}, window_start) WINDOW w AS (PARTITION BY {_KEYS} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY {_KEYS} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
    "su": "SELECT date, underlying, expiry, window_start, date_diff('minute', lo, window_start) AS minutes, strike, max(close) FILTER (type = 'C') + max(close) FILTER (type = 'P') AS straddle FROM f GROUP BY date, underlying, expiry, window_start, lo, strike",
}


@query("o16_straddle_surface", with_views("v_option_bars", more=_SURFACE) + " FINAL SELECT * FROM su", dbl=("strike", "straddle"), txt=("date", "window_start"), big=("expiry", "minutes"))
def o16(spark, sf):
    return options.straddle_surface(v.option_bars(spark, sf))


_SLOPES = {
    **_SURFACE,
    **_OPEN,
    "st": "SELECT *, row_number() OVER (PARTITION BY date, underlying, expiry ORDER BY strike) AS r FROM (SELECT DISTINCT date, underlying, expiry, strike FROM su)",
    "ce": "SELECT date, underlying, expiry, first(r ORDER BY abs(strike - implied), r) AS c FROM st JOIN io USING (date, underlying, expiry) GROUP BY 1, 2, 3",
    "nr": "SELECT date, underlying, expiry, strike FROM st JOIN ce USING (date, underlying, expiry) WHERE abs(r - c) <= 2",
}


@query(
    "o17_straddle_slopes",
    with_views("v_option_bars", more=_SLOPES)
    + """ FINAL SELECT date, underlying, expiry, strike, CASE WHEN count(y) >= 2 THEN regr_slope(y, minutes) END AS slope, CASE WHEN count(y) >= 2 THEN regr_intercept(y, minutes) END AS intercept
          FROM (SELECT *, CASE WHEN CAST(window_start AS TIME) <= TIME '10:30:00' THEN straddle END AS y FROM su SEMI JOIN nr USING (date, underlying, expiry, strike)) GROUP BY 1, 2, 3, 4""",
    dbl=("strike", "slope", "intercept"), txt=("date",), big=("expiry",),
)
def o17(spark, sf):
    return options.straddle_slopes(v.option_bars(spark, sf))


@query(
    "o18_surface_stats",
    with_views("v_option_bars", more=_SURFACE)
    + """ FINAL SELECT * FROM (SELECT date, underlying, expiry, avg(strike) AS strike_mean, stddev_pop(strike) AS strike_std FROM (SELECT DISTINCT date, underlying, expiry, strike FROM su) GROUP BY 1, 2, 3)
          JOIN (SELECT date, underlying, expiry, avg(straddle) AS price_mean, stddev_pop(straddle) AS price_std FROM su GROUP BY 1, 2, 3) USING (date, underlying, expiry)""",
    dbl=("strike_mean", "strike_std", "price_mean", "price_std"), txt=("date",), big=("expiry",),
)
def o18(spark, sf):
    return options.surface_stats(options.straddle_surface(v.option_bars(spark, sf)))


# ---- studies

_PAIR = {
    "d": "SELECT *, CAST(window_start AS DATE) AS date FROM v_day_bars",
    "p": "SELECT date, a.close AS ca, b.close AS cb FROM (SELECT * FROM d WHERE ticker = 'S1') a JOIN (SELECT * FROM d WHERE ticker = 'S2') b USING (date)",
    "r": "SELECT date_diff('day', DATE '0001-01-01', date) + 1 AS x, ca / cb AS y FROM p WHERE date >= (SELECT max(date) FROM p) - INTERVAL 60 MONTH",
    "mo": "SELECT regr_intercept(y, x) AS intercept, regr_slope(y, x) AS slope FROM r",
}


def _pair(spark, sf):
    days = v.day_bars(spark, sf)
    days = days.withColumn("date", times.ny_date(days, "window_start"))
    return [days.filter(F.col("ticker") == t).select("date", "close") for t in ("S1", "S2")]


@query("r1_fit_ratio", with_views("v_day_bars", more=_PAIR) + " FINAL SELECT * FROM mo", dbl=("intercept", "slope"))
def r1(spark, sf):
    return studies.fit_ratio(*_pair(spark, sf), months=60)


@query(
    "r2_predict_ratio",
    with_views("v_day_bars", more=_PAIR) + " FINAL SELECT date, close, (intercept + slope * (date_diff('day', DATE '0001-01-01', date) + 1)) * close AS predicted FROM (SELECT date, close FROM d WHERE ticker = 'S2'), mo",
    dbl=("close", "predicted"), txt=("date",),
)
def r2(spark, sf):
    a, b = _pair(spark, sf)
    return studies.predict_ratio(b, studies.fit_ratio(a, b, months=60))


@query(
    "r3_event_windows",
    with_views("v_minute_bars") + """ FINAL SELECT e.event_id, b.ticker, b.window_start, b.close FROM events e JOIN v_minute_bars b ON b.ticker = e.event_type
        AND b.window_start BETWEEN e.ts - INTERVAL 900 SECOND AND e.ts + INTERVAL 900 SECOND""",
    dbl=("close",), txt=("window_start",),
)
def r3(spark, sf):
    events = v.table(spark, sf, "events").select("event_id", F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp_ntz").alias("event_ts"))
    return studies.event_windows(v.minute_bars(spark, sf), events).select("event_id", "ticker", "window_start", "close")


@query(
    "r4_parse_event_ts",
    "SELECT event_id, CASE event_id % 3 WHEN 2 THEN NULL ELSE date_trunc('second', ts) - INTERVAL 5 HOUR END AS event_at FROM events",
    txt=("event_at",),
)
def r4(spark, sf):
    e = v.table(spark, sf, "events")
    unix = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts").cast("timestamp_ntz")).cast("string")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(F.col("event_id") % 3 == 0, unix).when(F.col("event_id") % 3 == 1, iso).otherwise("soon")
    return e.select("event_id", times.parse_event_ts(text).alias("event_at"))
