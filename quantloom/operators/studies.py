"""Ratio regressions between two series and bars around events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import ny_wall, seconds


def ordinal(date: Column) -> Column:
    """Days since 0001-01-01, that day counting 1."""
    return F.datediff(date, F.lit("0001-01-01").cast("date")) + 1


def fit_ratio(a: DataFrame, b: DataFrame, months: int = 6) -> DataFrame:
    """One row (intercept, slope): least squares of close_a / close_b on the date's ordinal.

    Inputs are (date, close); dates in common, the last ``months`` before the latest of them.
    """
    both = a.select("date", F.col("close").alias("ca")).join(b.select("date", F.col("close").alias("cb")), "date")
    latest = both.select(F.max("date")).scalar()
    recent = both.filter(F.col("date") >= F.add_months(latest, -months)).select(ordinal(F.col("date")).alias("x"), F.try_divide("ca", "cb").alias("y"))
    # the ordinals are large: fit around their mean in double for the sake of the digits
    return recent.agg(F.regr_intercept("y", "x").alias("intercept"), F.regr_slope("y", "x").alias("slope"))


def predict_ratio(df: DataFrame, model: DataFrame, price_col: str = "close") -> DataFrame:
    """Rows (date, price) with ``predicted``: (intercept + slope * ordinal) * price. The model is one row and is broadcast."""
    value = (F.col("intercept") + F.col("slope") * ordinal(F.col("date"))) * F.col(price_col)
    return df.crossJoin(F.broadcast(model.limit(1))).withColumn("predicted", value).drop("intercept", "slope")


def event_windows(bars: DataFrame, events: DataFrame, before: int = 900, after: int = 900) -> DataFrame:
    """Bars of an event's ticker from ``before`` seconds before it to ``after`` seconds after, ends included.

    An equi-join on (ticker, time bucket): an event is listed in every bucket that its window touches, so no theta join.
    """
    size = before + after
    bucket = lambda t: F.floor(F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), t) / F.lit(size))
    timed = bars.withColumn("window_start", ny_wall(bars, "window_start"))
    timed = timed.withColumn("__b", bucket(F.col("window_start")))
    at = F.col("event_ts")
    asked = events.withColumns({"__lo": at - seconds(before), "__hi": at + seconds(after)})
    asked = asked.withColumn("__b", F.explode(F.sequence(bucket(F.col("__lo")), bucket(F.col("__hi")))))
    return timed.join(asked, ["ticker", "__b"]).filter(F.col("window_start").between(F.col("__lo"), F.col("__hi"))).drop("__b", "__lo", "__hi")
