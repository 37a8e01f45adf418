"""Queries of the daily run: derived tables after two runs, the second with new dates, against the SQL of the operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import times
from ..functions.shared import shared_path
from ..sources import sinks
from . import queries_bars  # noqa: F401  its queries have the SQL
from . import stale
from . import views as v
from .registry import same_rows


def _after_two_runs(spark, market: stale.Market, raw: dict, target: str, by: str = "date"):
    """Raw rows up to the last but one partition, a run, the rest, another run; what the table then holds."""
    base = shared_path(spark, "daily")
    steps = stale.steps_of(market, by)
    for late in (False, True):
        for name, df in raw.items():
            last = df.select(F.max(by)).scalar()
            sinks.write_table(df.filter(F.col(by) == last if late else F.col(by) < last), f"{base}/{name}", [by])
        stale.refresh(spark, base, steps, [target])
    return spark.read.parquet(f"{base}/{target}")


def _dated(df, name):
    return df.withColumn("date", times.ny_date(df, name))


@same_rows("i14_adjusted_day_bars", "a3_adjust_combined")
def i14_day(spark, sf):
    month = lambda df, c: df.withColumn("month", F.trunc(c, "month"))
    raw = {
        "day_bars": month(_dated(v.day_bars(spark, sf), "window_start"), "date"),
        "splits": month(v.splits(spark, sf), "execution_date"),
        "dividends": month(v.dividends(spark, sf), "ex_dividend_date"),
    }
    return _after_two_runs(spark, stale.STOCKS, raw, "adjusted_day_bars", "month").drop("window_start", "month")


@same_rows("i14_stocks_matrix", "m10_stocks_matrix")
def i14_matrix(spark, sf):
    return _after_two_runs(spark, replace(stale.STOCKS, top=4), {"minute_bars": _dated(v.minute_bars(spark, sf), "window_start")}, "matrix")


def _ticks(spark, sf):
    return {"trades": _dated(v.trades(spark, sf), "ts"), "quotes": _dated(v.quotes(spark, sf), "ts")}


@same_rows("i14_tq_bars", "q7_stock_tq_bars")
def i14_tq(spark, sf):
    return _after_two_runs(spark, stale.STOCKS, _ticks(spark, sf), "tq_bars")


@same_rows("i14_bidask_spreads", "q9_bidask_spreads")
def i14_spreads(spark, sf):
    return _after_two_runs(spark, stale.STOCKS, _ticks(spark, sf), "bidask_spreads")


@same_rows("i14_option_flow", "m12_option_flow_matrix")
def i14_flow(spark, sf):
    return _after_two_runs(spark, replace(stale.OPTIONS, flow_top=3), {"minute_bars": v.option_bars(spark, sf)}, "option_flow")
