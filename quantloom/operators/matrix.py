"""Dense minute tables with indicators, in long form: one row per (date, window_start, ticker)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.series import decayed_sums, densify, ewm_gaps, ewm_means, ffill_bfill, growing, top_n_by
from ..functions.times import ny_date, ny_wall, seconds, session_filter

OHLC = ("open", "high", "low", "close")
KEY = ("date", "ticker")
METRICS = ("open", "high", "low", "close", "volume", "ema12", "ema26", "macd", "rsi", "vwap", "atv")
#: Index roots that are always valid underlyings.
INDEX_UNDERLYINGS = ("SPX", "SPXW", "XSP", "XSPW", "VIX", "VIXW")


def _growing():
    return growing(KEY, ["window_start"])


def dense_bars(bars: DataFrame, top_n: int = 0) -> DataFrame:
    """Regular-session bars of each date's top tickers on one minute grid: from the first to the last minute of the date.

    Prices are filled forward, then backward; volume and transactions are 0 where there was no bar.
    """
    inside = session_filter(bars, "window_start")
    inside = inside.withColumns({"date": ny_date(inside, "window_start"), "window_start": ny_wall(inside, "window_start")})
    zero = [c for c in ("volume", "transactions") if c in bars.columns]
    if "volume" in bars.columns:
        inside = top_n_by(inside, ["date"], "ticker", F.col("close") * F.col("volume"), top_n)
    ends = inside.groupBy("date").agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"))
    kept = inside.select(*KEY, "window_start", *OHLC, *zero).join(ends, "date")
    return densify(kept, KEY, "window_start", 60, bounds=("lo", "hi"), fill=OHLC, zero=zero).drop("lo", "hi", "is_new")


def macd(df: DataFrame) -> DataFrame:
    df = ewm_means(df, KEY, ["window_start"], {"ema12": (F.col("close"), 2 / 13), "ema26": (F.col("close"), 2 / 27)})
    return df.withColumn("macd", F.col("ema12") - F.col("ema26"))


def rsi(df: DataFrame, n: int = 14) -> DataFrame:
    """Wilder's relative strength index; 100 where there are gains and no losses, else filled where undefined."""
    order = Window.partitionBy(*KEY).orderBy("window_start")
    change = F.col("close") - F.lag("close").over(order)
    df = df.withColumns({"__gain": F.coalesce(F.greatest(change, F.lit(0.0)), F.lit(0.0)), "__loss": F.coalesce(F.greatest(-change, F.lit(0.0)), F.lit(0.0))})
    df = ewm_means(df, KEY, ["window_start"], {"__up": (F.col("__gain"), 1 / n), "__down": (F.col("__loss"), 1 / n)})
    raw = F.when((F.col("__down") == 0) & (F.col("__up") > 0), F.lit(100.0)).when(
        F.col("__down") > 0, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide("__up", "__down"))
    )
    df = df.withColumn("rsi", raw)
    return df.withColumn("rsi", ffill_bfill("rsi", KEY, ["window_start"])).drop("__gain", "__loss", "__up", "__down")


def vwap(df: DataFrame) -> DataFrame:
    """Running volume-weighted typical price; filled where no volume came yet, 0 without a volume column."""
    if "volume" not in df.columns:
        return df.withColumn("vwap", F.lit(0.0))
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    w = _growing()
    df = df.withColumn("vwap", F.try_divide(F.sum(typical * F.col("volume")).over(w), F.sum("volume").over(w)))
    return df.withColumn("vwap", ffill_bfill("vwap", KEY, ["window_start"]))


def atv(df: DataFrame) -> DataFrame:
    """Average trade volume; 0 without transactions."""
    if not {"volume", "transactions"} <= set(df.columns):
        return df.withColumn("atv", F.lit(0.0))
    return df.withColumn("atv", F.when(F.col("transactions") > 0, F.col("volume") / F.col("transactions")).otherwise(0.0))


def stocks_matrix(bars: DataFrame, top_n: int = 1024, indicators: bool = True) -> DataFrame:
    """The dense minute table of each date's top tickers with EMA, MACD, RSI, VWAP and ATV."""
    dense = dense_bars(bars, top_n)
    if indicators:
        dense = atv(vwap(rsi(macd(dense))))
    return dense.select("date", "window_start", "ticker", *[c for c in METRICS if c in dense.columns])


#: Columns beyond which a table is made wide through arrays instead of one pivot.
WIDE = 1000


def wide_tickers(df: DataFrame, n: int) -> list[str]:
    """The first ``n`` tickers in order, n rows at most to the driver."""
    return [r.ticker for r in df.select("ticker").distinct().orderBy("ticker").limit(n).collect()]


def to_arrays(df: DataFrame, tickers: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(date, window_start, cells): one row per minute with an array of structs of the metrics, by position of the ticker in ``tickers``.

    Two levels of some square root of the tickers each, so that no aggregate has an expression for every ticker: a ticker's
    place in its block, then the block's. Rows of other tickers don't count; a minute without any of them has no row.
    """
    size = max(1, math.isqrt(max(0, len(tickers) - 1)) + 1)
    places = df.sparkSession.createDataFrame([(t, i // size, i % size) for i, t in enumerate(tickers)], "ticker string, __block int, __place int")
    minute = ["date", "window_start"]
    one = df.groupBy(*minute, "ticker").agg(*[F.first(m, ignorenulls=True).alias(m) for m in metrics]).join(F.broadcast(places), "ticker")
    at = lambda c, k, v: F.first(F.when(F.col(c) == k, v), ignorenulls=True)
    cell = F.struct(*metrics)
    blocks = one.groupBy(*minute, "__block").agg(F.array(*[at("__place", k, cell) for k in range(size)]).alias("__cells"))
    empty = F.array_repeat(F.lit(None).cast(blocks.schema["__cells"].dataType.elementType), size)
    whole = blocks.groupBy(*minute).agg(F.array(*[F.coalesce(at("__block", k, F.col("__cells")), empty) for k in range(-(-len(tickers) // size))]).alias("__blocks"))
    return whole.select(*minute, F.flatten("__blocks").alias("cells"))


def to_wide(df: DataFrame, tickers: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per minute with a column for each ticker and metric, in sorted order.

    Beyond ``WIDE`` columns the columns are made once at the end, from the arrays of ``to_arrays``: some 100 kB a minute with
    1,024 tickers of 11 metrics, and a task holds one minute at a time.
    """
    tickers, metrics = sorted(tickers), sorted(metrics)
    if len(tickers) * len(metrics) > WIDE:
        cells = to_arrays(df, tickers, metrics)
        return cells.selectExpr("date", "window_start", *[f"cells[{i}].`{m}` AS `{t}_{m}`" for i, t in enumerate(tickers) for m in metrics])  # as text: one call for all
    wide = df.groupBy("date", "window_start").pivot("ticker", list(tickers)).agg(*[F.first(m, ignorenulls=True).alias(m) for m in metrics])
    if len(metrics) == 1:
        wide = wide.withColumnsRenamed({t: f"{t}_{metrics[0]}" for t in tickers})
    return wide.select("date", "window_start", *[f"`{t}_{m}`" for t in tickers for m in metrics])


def options_matrix(bars: DataFrame, valid: DataFrame | None = None, min_coverage: float = 0.05) -> DataFrame:
    """(date, underlying, ticker, window_start, price, volume) on the full regular-session grid of 391 minutes.

    Price is the mean of the prices that aren't null. Contracts with a price in ``min_coverage`` of the minutes or fewer
    are dropped; ``valid`` (underlying) restricts to those underlyings and the index roots.
    """
    inside = session_filter(bars, "window_start")
    inside = inside.withColumns({"date": ny_date(inside, "window_start"), "window_start": ny_wall(inside, "window_start")})
    if valid is not None:
        roots = bars.sparkSession.createDataFrame([(u,) for u in INDEX_UNDERLYINGS], "underlying string")
        inside = inside.join(valid.select("underlying").unionByName(roots).distinct(), "underlying", "left_semi")
    given = F.array_compact(F.array(*OHLC))
    price = F.try_divide(F.aggregate(given, F.lit(0.0), lambda a, x: a + x), F.size(given))
    keys = ["date", "underlying", "ticker"]
    day = F.col("date").cast("timestamp_ntz")
    priced = inside.select(*keys, "window_start", price.alias("price"), "volume").withColumns({"lo": day + seconds(34200), "hi": day + seconds(57600)})
    often = priced.withColumn("__n", F.count("price").over(Window.partitionBy(*keys))).filter(F.col("__n") / 391 > min_coverage).drop("__n")
    dense = densify(often, keys, "window_start", 60, bounds=("lo", "hi"), fill=["price"], zero=["volume"])
    return dense.select(*keys, "window_start", "price", "volume")


def option_flow_matrix(bars: DataFrame, n: int = 1024, span: int = 10) -> DataFrame:
    """Call and put volume and volume-weighted average strike (recursive EMA) of the top underlyings, every minute 09:30-16:00.

    A minute in which no underlying has bars of a type counts as zero; one in which only others have is null and keeps
    the means.
    """
    day = bars if "date" in bars.columns else bars.withColumn("date", ny_date(bars, "window_start"))
    day = day.withColumn("window_start", ny_wall(bars, "window_start"))
    best = top_n_by(day, ["date"], "underlying", F.col("volume"), n)
    amounts = best.groupBy("date", "underlying", "type", "window_start").agg(F.sum("volume").alias("v"), F.sum(F.col("volume") * F.col("strike")).alias("vs"))
    # the minutes that any underlying has, by type: 391 a date at most
    any_has = amounts.groupBy("date", "type").agg(F.collect_set("window_start").alias("__any"))
    entry = F.struct("window_start", F.struct("v", "vs"))
    of_type = lambda t: F.struct(F.lit(t).alias("type"), F.map_from_entries(F.collect_list(F.when(F.col("type") == t, entry))).alias("own"))
    series = amounts.groupBy("date", "underlying").agg(F.array(of_type("C"), of_type("P")).alias("__s")).select("date", "underlying", F.inline("__s"))
    series = series.join(any_has, ["date", "type"], "left").repartition("date", "underlying")  # for all that follows
    day_start = F.col("date").cast("timestamp_ntz")
    minute = F.posexplode(F.sequence(day_start + seconds(34200), day_start + seconds(57600), seconds(60))).alias("i", "window_start")
    rows = series.select("date", "underlying", "type", "own", "__any", minute)
    rows = rows.select("date", "underlying", "type", "window_start", "i", (F.size("own") > 0).alias("__has"), F.try_element_at("own", F.col("window_start")).alias("x"), F.array_contains("__any", F.col("window_start")).alias("__any"))
    known = F.col("x").isNotNull() | ~F.coalesce("__any", F.lit(False))
    keys, order = ["date", "underlying", "type"], ["i"]
    share, decay = ewm_gaps(known, F.col("i"), keys, order, 2 / (span + 1))
    part = lambda c: F.when(known, F.col("__share") * F.coalesce(F.col(f"x.{c}").cast("double"), F.lit(0.0)))
    rows = decayed_sums(rows.withColumns({"__share": share, "__decay": decay}), keys, order, F.col("__decay"), {"__vs": part("vs"), "__v": part("v")})
    mean = F.when(F.col("__has"), F.coalesce(F.try_divide("__vs", "__v"), F.lit(0.0)))
    flat = rows.select("date", "underlying", "type", "window_start", F.coalesce("x.v", F.lit(0)).alias("n"), mean.alias("m"))
    of = lambda t, c: F.max(F.when(F.col("type") == t, F.col(c)))
    return flat.groupBy("date", "window_start", "underlying").agg(
        of("C", "n").cast("int").alias("C_volume"), of("P", "n").cast("int").alias("P_volume"), of("C", "m").alias("C_vwas_ema10"), of("P", "m").alias("P_vwas_ema10")
    )


def merge_matrices(stocks: DataFrame, options: DataFrame) -> DataFrame:
    """Stock and option tables of common dates, tickers and minutes side by side; ``options`` names its ticker ``underlying``."""
    return stocks.join(options.withColumnRenamed("underlying", "ticker"), ["date", "window_start", "ticker"])
