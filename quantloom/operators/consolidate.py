"""Consolidation of bars over days and tickers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.series import latest_per_key, upsert
from ..functions.times import ny_date, recent_days


def last_n_day_aggs(bars: DataFrame, n: int) -> DataFrame:
    """Bars of the last n calendar days by New York date, keyed (date, ticker); null tickers dropped, window_start replaced by date."""
    dated = bars.withColumn("date", ny_date(bars, "window_start"))
    recent = recent_days(dated, n)
    rest = [c for c in bars.columns if c not in ("ticker", "window_start", "date")]
    return recent.filter(F.col("ticker").isNotNull()).select("date", "ticker", *rest)


def append_bars(existing: DataFrame, new: DataFrame, key: str = "ticker", ts: str = "window_start", mode: str = "upsert", order: Sequence[str] | None = None) -> DataFrame:
    """Existing and new bars with one row per (key, ts); the new one wins, of several the last in ``order`` (default: the other columns).

    mode "newer_only" first drops new rows that aren't later than the latest existing one of their key.
    """
    if mode not in ("upsert", "newer_only"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "newer_only":
        high = existing.groupBy(key).agg(F.max(ts).alias("__high"))
        new = new.join(high, key, "left").filter(F.col("__high").isNull() | (F.col(ts) > F.col("__high"))).drop("__high")
    return upsert(existing, new, [key, ts], keep="last", order=order)


#: Key and dates of the corporate actions, and the months that a refresh goes back.
ACTIONS = {
    "splits": (("ticker", "execution_date"), ("execution_date",), 6),
    "dividends": (("ticker", "ex_dividend_date"), ("ex_dividend_date", "pay_date", "record_date", "declaration_date"), 2),
}


def refresh_start(modified: Column, kind: str) -> Column:
    """The date from which actions are asked for again, given when the table was last written."""
    return F.add_months(F.to_date(modified), -ACTIONS[kind][2])


def load_actions(new: DataFrame, kind: str, old: DataFrame | None = None) -> DataFrame:
    """Splits or dividends as delivered, added to the table so far: one row per key, the old one if there is one.

    Dates that don't parse become null, the vendor's ``id`` goes. Of several new rows of one key the first in order of the
    other columns counts. Sorted by key within partitions.
    """
    keys, dates, _ = ACTIONS[kind]
    typed = new.withColumns({c: F.col(c).try_cast("date") for c in dates if c in new.columns}).drop("id")
    done = upsert(old if old is not None else typed.limit(0), typed, list(keys))
    return done.sortWithinPartitions(*keys)


def normalize_assets(df: DataFrame) -> DataFrame:
    """Asset master with fixed types: flags, numbers (null where they don't parse), text, the attribute list as JSON."""
    flags = ("tradable", "marginable", "shortable", "easy_to_borrow", "fractionable")
    numbers = ("maintenance_margin_requirement", "min_order_size", "min_trade_increment", "price_increment")
    have = set(df.columns)
    out = {c: F.col(c).try_cast("boolean") for c in flags if c in have} | {c: F.col(c).try_cast("double") for c in numbers if c in have}
    kinds = dict(df.dtypes)
    for c in df.columns:
        if kinds[c].startswith(("array", "struct", "map")):
            out[c] = F.to_json(c)
        elif c not in out:
            out[c] = F.col(c).cast("string")
    return df.withColumns(out)


def normalize_holdings(df: DataFrame) -> DataFrame:
    """Fund holdings: ``3.2%`` as 0.032 (null where it doesn't parse), symbol as ticker, asOf as timestamp, the latest row per ticker."""
    rest = [c for c in df.columns if c not in ("symbol", "weight", "asOf")]
    weight = F.regexp_replace("weight", "%", "").try_cast("double") / 100
    typed = df.select(F.col("symbol").alias("ticker"), weight.alias("weight"), F.try_to_timestamp("asOf").cast("timestamp_ntz").alias("as_of"), *rest)
    return latest_per_key(typed, ["ticker"], [F.col("as_of").desc_nulls_last(), *[F.col(c) for c in ("weight", *rest)]])


def count_nulls(df: DataFrame, columns=None) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def assert_no_nulls(df: DataFrame, columns=None, by=("date",), series=("date", "ticker")) -> DataFrame:
    """The rows, failing the job if a date has a null in one of ``columns``.

    A series (say, a ticker's day) that is null throughout in a column isn't held against its date.
    """
    columns = columns or [c for c in df.columns if c not in (*by, *series)]
    w = Window.partitionBy(*series)
    bad = F.lit(False)
    for c in columns:
        bad = bad | (F.col(c).isNull() & (F.count(c).over(w) > 0))
    failing = F.when(bad, F.raise_error(F.concat(F.lit("nulls remain on "), F.concat_ws(", ", *[F.col(c).cast("string") for c in by])))).otherwise(F.lit(True))
    return df.withColumn("__gate", failing).filter(F.col("__gate").cast("boolean")).drop("__gate")
