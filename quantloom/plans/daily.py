"""The daily pipeline: raw tables to every derived table, in order.

Each step is a DataFrame plan over the tables before it; only what is listed in ``outputs`` is written. Nothing is
collected, and a step that isn't asked for isn't run.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.times import ny_date
from ..operators import adjust, consolidate, matrix, ticks
from ..sources.sinks import write_table


@dataclass(frozen=True)
class DailyConfig:
    """Histories in calendar days, interval in seconds, tickers of the matrix (0: all)."""

    history_days: int = 730
    interval: int = 10
    top_stocks: int = 1024
    top_underlyings: int = 1024


def run_daily(tables: Mapping[str, DataFrame], config: DailyConfig = DailyConfig(), out: str | None = None, outputs: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Derived tables by name from ``day_bars``, ``minute_bars``, ``splits``, ``dividends``, ``trades``, ``quotes`` and ``option_bars``.

    With ``out``, each of ``outputs`` (default: all) is written to ``out``/name by date and read from there by later steps.
    """
    spark = next(iter(tables.values())).sparkSession
    done: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> None:
        if out is not None and (outputs is None or name in outputs):
            write_table(df, f"{out}/{name}", ["date"])
            df = spark.read.parquet(f"{out}/{name}")
        done[name] = df

    put("last_n_day_bars", consolidate.last_n_day_aggs(tables["day_bars"], config.history_days))
    put("adjusted_day_bars", adjust.adjust_combined(done["last_n_day_bars"], tables["splits"], tables["dividends"]))
    minutes = tables["minute_bars"].withColumn("date", ny_date(tables["minute_bars"], "window_start"))
    put("adjusted_minute_bars", adjust.adjust_bars(minutes, tables["splits"], tables["dividends"]))
    put("stocks_matrix", matrix.stocks_matrix(tables["minute_bars"], config.top_stocks))
    put("stock_tq", ticks.stock_tq_bars(tables["trades"], tables["quotes"], config.interval))
    put("bidask_spreads", ticks.bidask_spreads(done["stock_tq"]))
    put("options_matrix", matrix.options_matrix(tables["option_bars"]))
    put("option_flow", matrix.option_flow_matrix(tables["option_bars"], config.top_underlyings))
    return done
