"""The daily run as a graph of stored tables: each run rewrites the dates whose inputs have changed, and no other.

Raw and derived tables lie under one folder, partitioned by date. For each date of a derived table the signature of what it
was made from is kept: the names, sizes and times of the input files of that date and, where corporate actions count, of
all later action dates too (and of the bars of those days, whose closes the factors need), so that a new split makes every
earlier adjusted date stale. Signatures come from folder listings; no data is read to find out what is stale.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import NEW_YORK
from ..operators import adjust, matrix, ticks
from ..sources import readers, sinks, stored


@dataclass(frozen=True)
class Market:
    """What differs between markets: the time zone of its days, the tickers of its matrix (0: all; None: no matrix) and indicators."""

    name: str
    tz: str = NEW_YORK
    top: int | None = None
    indicators: bool = False
    actions: bool = False
    ticks: bool = False
    options: bool = False
    interval: int = 10
    flow_top: int = 1024


#: The markets of the daily run.
STOCKS = Market("stocks", top=1024, indicators=True, actions=True, ticks=True)
OPTIONS = Market("options", options=True)
INDICES = Market("indices", top=0)
CRYPTO, FOREX = Market("crypto", tz="UTC"), Market("forex", tz="UTC")
MARKETS = (STOCKS, OPTIONS, INDICES, CRYPTO, FOREX)
#: The histories of day bars in calendar days.
HISTORIES = (365, 730, 1460, 2920)


@dataclass(frozen=True)
class Step:
    """A derived table: ``build`` gets the rows of the stale dates of ``by_date`` and all of ``later``.

    ``by`` names the partition column of the table and of what it reads. Where that is coarser than a day, events of the same
    partition count as later ones.
    """

    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    by_date: tuple[str, ...]
    later: tuple[str, ...] = ()
    closes: str | None = None
    by: str = "date"


def _with_factors(bars: str, volume_mode: str | None, zero_close: str):
    def build(t):
        # only the bars of action days are read for the factors, whatever is stale
        intervals = adjust.factor_intervals(t["all_day_bars"], t["splits"], t["dividends"], zero_close)
        return adjust.adjust_by_intervals(t[bars], intervals, volume_mode)

    return build


def _with_own_events(t):
    return adjust.adjust_with_events(t["day_bars"], t["other_day_bars"], t["splits"], t["dividends"], "split_only", "reference")


def steps_of(market: Market, by: str = "date") -> list[Step]:
    """The derived tables of a market, each after those that it reads; ``by``: how the adjusted day bars are partitioned."""
    out = []
    if market.actions:
        out.append(Step("adjusted_day_bars", _with_own_events, ("day_bars",), ("splits", "dividends"), "day_bars", by))
        out.append(Step("adjusted_minute_bars", _with_factors("minute_bars", None, "one"), ("minute_bars",), ("splits", "dividends"), "day_bars"))
    if market.top is not None:
        out.append(Step("matrix", lambda t: matrix.stocks_matrix(t["minute_bars"], market.top, market.indicators), ("minute_bars",)))
    if market.ticks:
        out.append(Step("tq_bars", lambda t: ticks.stock_tq_bars(t["trades"], t["quotes"], market.interval), ("trades", "quotes")))
        out.append(Step("bidask_spreads", lambda t: ticks.bidask_spreads(t["tq_bars"]), ("tq_bars",)))
    if market.options:
        out.append(Step("options_matrix", lambda t: matrix.options_matrix(t["minute_bars"]), ("minute_bars",)))
        out.append(Step("option_flow", lambda t: matrix.option_flow_matrix(t["minute_bars"], market.flow_top), ("minute_bars",)))
    return out


def ingest_bars(spark: SparkSession, csv, base: str, market: Market, table: str = "minute_bars") -> None:
    """Bar files of a market into its raw table, by the date of the market's time zone; dates that the files have are replaced."""
    read = readers.read_option_bars_csv if market.options else lambda s, p: readers.read_bars_csv(s, p, tz=market.tz)
    sinks.write_table(read(spark, csv), f"{base}/{table}", ["date"], ["ticker", "window_start"])


def history(spark: SparkSession, base: str, days: int, table: str = "day_bars") -> DataFrame:
    """The last calendar days of a stored table, as one of ``HISTORIES``."""
    return stored.read_recent(spark, f"{base}/{table}", days)


def _digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def wanted(spark: SparkSession, base: str, step: Step) -> dict[str, str]:
    """For each date that the step's table should have the signature of what it is made from."""
    own = [stored.signatures(spark, f"{base}/{name}", step.by) for name in step.by_date]
    dates = sorted(set.intersection(*map(set, own)), reverse=True)
    actions = [stored.signatures(spark, f"{base}/{name}", step.by) for name in step.later]
    closes = stored.signatures(spark, f"{base}/{step.closes}", step.by) if step.closes else {}
    events = sorted({d for a in actions for d in a}, reverse=True)
    out, so_far, k = {}, "", 0
    for d in dates:  # from the latest one back: what is later has been gathered
        while k < len(events) and (events[k] > d or step.by != "date" and events[k] == d):
            so_far, k = _digest(so_far, events[k], closes.get(events[k], ""), *[a.get(events[k], "") for a in actions]), k + 1
        out[d] = _digest(so_far, *[s[d] for s in own])
    return out


def _state(spark: SparkSession, base: str, name: str) -> dict[str, str]:
    path = f"{base}/_state/{name}"
    if not stored.exists(spark, path):
        return {}
    rows = spark.read.parquet(path).groupBy("date").agg(F.max_by("signature", "run").alias("signature"))
    return {r.date: r.signature for r in rows.collect()}  # a row for each stored date


def stale_dates(spark: SparkSession, base: str, step: Step) -> list[str]:
    have = _state(spark, base, step.name)
    return sorted(d for d, s in wanted(spark, base, step).items() if have.get(d) != s)


def refresh(spark: SparkSession, base: str, steps: Sequence[Step], targets: Sequence[str] | None = None, run: int | None = None) -> dict[str, list[str]]:
    """Brings derived tables up to date, in order; returns the dates that were rewritten, by table.

    ``targets``: the tables that are asked for, with those that they read (default: all). A run that is cut off is made up
    for by the next: a date's signature is noted after its rows.
    """
    known = {s.name: s for s in steps}
    needed = set(known if targets is None else targets)
    for s in reversed(steps):
        needed |= {n for n in s.by_date if n in known} if s.name in needed else set()
    done = {}
    for step in steps:
        if step.name not in needed:
            continue
        want, have = wanted(spark, base, step), _state(spark, base, step.name)
        stale = sorted(d for d, s in want.items() if have.get(d) != s)
        path = f"{base}/{step.name}"
        stored.drop_partitions(spark, path, [d for d in stored.partition_values(spark, path, step.by) if d not in want], step.by)
        done[step.name] = stale
        if not stale:
            continue
        tables = {n: stored.read_values(spark, f"{base}/{n}", stale, step.by) for n in step.by_date}
        tables |= {n: spark.read.parquet(f"{base}/{n}").drop(step.by) for n in step.later}
        if step.closes:
            events = {d for n in step.later for d in stored.partition_values(spark, f"{base}/{n}", step.by)}
            # where the closes' table is adjusted itself, its stale dates are read with the others only once
            name = "other_day_bars" if step.closes in step.by_date else "all_day_bars"
            tables[name] = stored.read_values(spark, f"{base}/{step.closes}", sorted(events - set(stale) if step.closes in step.by_date else events), step.by)
        before = stored.signatures(spark, path, step.by)
        sinks.write_table(step.build(tables), path, [step.by])
        after = stored.signatures(spark, path, step.by)
        # a date that has no rows any more isn't overwritten, so what it had goes
        stored.drop_partitions(spark, path, [d for d in stale if d in before and after.get(d) == before[d]], step.by)
        number = run if run is not None else max([0, *stored.numbers(spark, f"{base}/_state/{step.name}", "run")]) + 1
        rows = spark.createDataFrame([(d, want[d]) for d in stale], "date string, signature string")
        rows.withColumn("run", F.lit(number).cast("long")).coalesce(1).write.mode("append").partitionBy("run").parquet(f"{base}/_state/{step.name}")
    return done


def expire(spark: SparkSession, base: str, table: str, days: int) -> int:
    """Deletes dates of a raw table that are more than ``days`` before its latest; returns how many."""
    values = stored.partition_values(spark, f"{base}/{table}")
    old = [v for v in values if date.fromisoformat(v) < date.fromisoformat(values[-1]) - timedelta(days=days)]
    stored.drop_partitions(spark, f"{base}/{table}", old)
    return len(old)
