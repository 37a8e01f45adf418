"""Prices adjusted for splits and dividends.

The factor of a day is 1 / (split_to / split_from) times (close - dividend) / close; a bar's cumulative factor is the
product of the factors of all later days, 1 for the latest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.asof import asof_join
from ..functions.times import ny_date

PRICES = ("open", "high", "low", "close")


def _factors(daily: DataFrame, splits: DataFrame, dividends: DataFrame) -> DataFrame:
    """(ticker, date, close) with split and dividend of the day; several events of one day are combined."""
    s = splits.groupBy("ticker", F.col("execution_date").alias("date")).agg(F.product(F.col("split_to") / F.col("split_from")).alias("split"))
    d = dividends.groupBy("ticker", F.col("ex_dividend_date").alias("date")).agg(F.sum("cash_amount").alias("dividend"))
    return daily.join(s, ["ticker", "date"], "left").join(d, ["ticker", "date"], "left")


def _day_factor(zero_close: str, close: str = "close", split: str = "split", dividend: str = "dividend") -> Column:
    by_split = F.lit(1.0) / F.coalesce(split, F.lit(1.0))
    paid = F.try_divide(F.col(close) - F.coalesce(dividend, F.lit(0.0)), F.col(close))
    if zero_close == "one":
        return F.when(F.col(close) == 0, F.lit(1.0)).otherwise(by_split * paid)
    if zero_close == "split_only":
        return by_split * F.when(F.col(close) == 0, F.lit(1.0)).otherwise(paid)
    raise ValueError(f"unknown zero_close {zero_close!r}")


def _later_product(c: Column) -> Column:
    # descending, so that the frame grows; null factors are skipped
    later = Window.partitionBy("ticker").orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.product(c).over(later), F.lit(1.0))


def cumulative_factors(daily: DataFrame, splits: DataFrame, dividends: DataFrame, zero_close: str) -> DataFrame:
    """(ticker, date, cum, split_cum) of each day of ``daily`` (ticker, date, close), one row per day."""
    f = _factors(daily, splits, dividends).withColumn("__f", _day_factor(zero_close)).withColumn("__s", F.lit(1.0) / F.coalesce("split", F.lit(1.0)))
    return f.select("ticker", "date", _later_product(F.col("__f")).alias("cum"), _later_product(F.col("__s")).alias("split_cum"))


def _dated(bars: DataFrame) -> DataFrame:
    return bars if "date" in bars.columns else bars.withColumn("date", ny_date(bars, "window_start"))


def daily_closes(bars: DataFrame) -> DataFrame:
    """(ticker, date, close): the close of each day's last bar."""
    return _dated(bars).groupBy("ticker", "date").agg(F.max_by("close", "window_start").alias("close"))


def adjust_bars(bars: DataFrame, splits: DataFrame, dividends: DataFrame, zero_close: str = "one") -> DataFrame:
    """Day or minute bars with adj_open, adj_high, adj_low, adj_close. A day's reference close is that of its last bar."""
    dated = _dated(bars)
    daily = daily_closes(dated)
    cum = cumulative_factors(daily, splits, dividends, zero_close).select("ticker", "date", "cum")
    done = dated.join(cum, ["ticker", "date"], "left").withColumns({f"adj_{c}": F.col(c) * F.col("cum") for c in PRICES})
    return done.select(*dated.columns, *[f"adj_{c}" for c in PRICES])


def adjust_day_bars(bars: DataFrame, splits: DataFrame, dividends: DataFrame) -> DataFrame:
    """As adjust_bars, but a close of zero leaves the split in force."""
    return adjust_bars(bars, splits, dividends, zero_close="split_only")


def adjust_combined(bars: DataFrame, splits: DataFrame, dividends: DataFrame, volume_mode: str = "reference") -> DataFrame:
    """Day bars of all tickers, keyed (date, ticker), with adjusted prices and adj_volume (whole number, towards zero).

    volume_mode "reference" multiplies volume by the product of 1 / split, "inverse" divides by it.
    """
    if volume_mode not in ("reference", "inverse"):
        raise ValueError(f"unknown volume_mode {volume_mode!r}")
    dated = _dated(bars)
    cum = cumulative_factors(dated.select("ticker", "date", "close"), splits, dividends, "split_only")
    scale = F.col("split_cum") if volume_mode == "reference" else F.try_divide(F.lit(1.0), F.col("split_cum"))
    done = dated.join(cum, ["ticker", "date"], "left").withColumns(
        {f"adj_{c}": F.col(c) * F.col("cum") for c in PRICES} | {"adj_volume": (F.col("volume") * scale).cast("long")}
    )
    return done.drop("cum", "split_cum", "window_start")


def factor_intervals(daily: DataFrame, splits: DataFrame, dividends: DataFrame, zero_close: str = "one") -> DataFrame:
    """(ticker, date, cum, split_cum) of every event day that has a bar: what bars before that date, and from the event before on, are multiplied by.

    ``daily`` holds (ticker, date, close), or bars, of which a day's last one counts. Bars and events are stacked and aggregated
    by day at once, by hash, so no bar is sorted or joined. The table has a row for each event, so it stays small beside the
    bars, and a late event changes rows of its own ticker only.
    """
    daily, none = _dated(daily), F.lit(None)
    at = F.col("window_start" if "window_start" in daily.columns else "date")

    def stacked(df: DataFrame, day: str, event: bool, **values: Column) -> DataFrame:
        more = {"__at": none, "close": none, "split": none, "dividend": none} | values
        return df.select("ticker", F.col(day).alias("date"), F.lit(event).alias("__event"), *[c.alias(n) for n, c in more.items()])

    rows = stacked(daily, "date", False, __at=at, close=F.col("close"))
    rows = rows.unionByName(stacked(splits, "execution_date", True, split=F.col("split_to") / F.col("split_from")))
    rows = rows.unionByName(stacked(dividends, "ex_dividend_date", True, dividend=F.col("cash_amount")))
    f = rows.groupBy("ticker", "date").agg(
        F.max_by("close", "__at").alias("close"), F.product("split").alias("split"), F.sum("dividend").alias("dividend"), F.bool_or("__event").alias("__event"), F.bool_and("__event").alias("__no_bar")
    )
    f = f.filter(F.col("ticker").isNotNull() & F.col("date").isNotNull() & F.col("__event") & ~F.col("__no_bar"))
    f = f.withColumns({"__f": _day_factor(zero_close), "__s": F.lit(1.0) / F.coalesce("split", F.lit(1.0))})
    on = Window.partitionBy("ticker").orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return f.select("ticker", "date", *[F.coalesce(F.product(c).over(on), F.lit(1.0)).alias(n) for c, n in (("__f", "cum"), ("__s", "split_cum"))])


def late_events(intervals: DataFrame, daily: DataFrame, splits: DataFrame, dividends: DataFrame, tickers: DataFrame, zero_close: str = "one") -> DataFrame:
    """The intervals after events came in for ``tickers``: theirs are made anew from all their events, the others stay as they are."""
    asked = tickers.select("ticker").distinct()
    own = lambda df: df.join(asked, "ticker", "left_semi")
    return intervals.join(asked, "ticker", "left_anti").unionByName(factor_intervals(own(daily), own(splits), own(dividends), zero_close))


def adjust_by_intervals(bars: DataFrame, intervals: DataFrame, volume_mode: str | None = None) -> DataFrame:
    """``adjust_bars`` from a stored interval table: each bar takes the factor of its ticker's next event after its date.

    An as-of join, linear in bars and events; no close is looked up and no product is built over bars. With a volume_mode
    also adj_volume, as ``adjust_combined`` has it.
    """
    if volume_mode not in (None, "reference", "inverse"):
        raise ValueError(f"unknown volume_mode {volume_mode!r}")
    dated = _dated(bars)
    found = intervals.select("ticker", F.col("date").alias("__on"), F.col("cum").alias("__cum"), F.col("split_cum").alias("__split"))
    done = asof_join(dated, found, ["ticker"], "date", "__on", ["__cum", "__split"], "forward", exact=False)
    return done.select(*dated.columns, *_scaled(F.coalesce("__cum", F.lit(1.0)), F.coalesce("__split", F.lit(1.0)), volume_mode))


def _scaled(cum: Column, split: Column, volume_mode: str | None) -> list[Column]:
    more = [(F.col(c) * cum).alias(f"adj_{c}") for c in PRICES]
    if volume_mode:
        scale = split if volume_mode == "reference" else F.try_divide(F.lit(1.0), split)
        more.append((F.col("volume") * scale).cast("long").alias("adj_volume"))
    return more


def adjust_with_events(bars: DataFrame, other_days: DataFrame, splits: DataFrame, dividends: DataFrame, zero_close: str = "one", volume_mode: str | None = None) -> DataFrame:
    """``bars`` adjusted as by ``factor_intervals`` and ``adjust_by_intervals``, but shuffled and sorted once only.

    Bars and event days are stacked by ticker, from the latest day back; an event stands behind its day's bars, the last of
    which is the one before it and gives the close, and what has been multiplied up to a bar are the factors of later days.
    ``other_days``: bars of days that ``bars`` doesn't have, for the closes of events on them; they aren't returned.
    """
    if volume_mode not in (None, "reference", "inverse"):
        raise ValueError(f"unknown volume_mode {volume_mode!r}")
    dated, none = _dated(bars), F.lit(None).cast("double")
    paid = dividends.select("ticker", F.col("ex_dividend_date").alias("date"), none.alias("__split"), F.col("cash_amount").alias("__dividend"))
    events = splits.select("ticker", F.col("execution_date").alias("date"), (F.col("split_to") / F.col("split_from")).alias("__split"), none.alias("__dividend")).unionByName(paid)
    events = events.filter(F.col("ticker").isNotNull() & F.col("date").isNotNull()).groupBy("ticker", "date").agg(F.product("__split").alias("__split"), F.sum("__dividend").alias("__dividend"))
    at = [c for c in ("window_start",) if c in dated.columns]
    rows = dated.withColumn("__side", F.lit(0)).unionByName(_dated(other_days).select("ticker", "date", *at, "close", F.lit(1).alias("__side")), allowMissingColumns=True)
    rows = rows.unionByName(events.withColumn("__side", F.lit(2)), allowMissingColumns=True)
    back = Window.partitionBy("ticker").orderBy(F.col("date").desc(), "__side", *[F.col(c).asc_nulls_first() for c in at])
    # windows are ordered by plain columns: expressions would have each sort anew
    has_bar = (F.col("__side") == 2) & (F.lag("date").over(back) == F.col("date"))
    rows = rows.withColumns({"__has_bar": has_bar, "__close": F.lag("close").over(back)})
    factors = {"__f": _day_factor(zero_close, "__close", "__split", "__dividend"), "__s": F.lit(1.0) / F.coalesce("__split", F.lit(1.0))}
    rows = rows.withColumns({n: F.when(F.col("__has_bar"), c) for n, c in factors.items()})
    so_far = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = rows.withColumns({n: F.product(c).over(so_far) for n, c in (("__cum", "__f"), ("__split_cum", "__s"))}).filter("__side = 0")
    cum, split = (F.when(F.col("date").isNotNull() & F.col(c).isNotNull(), F.col(c)).otherwise(F.lit(1.0)) for c in ("__cum", "__split_cum"))
    return done.select(*dated.columns, *_scaled(cum, split, volume_mode))
