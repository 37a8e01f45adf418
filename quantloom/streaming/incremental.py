"""Incremental work: only files or dates that weren't processed yet, and tick bars over a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ticks

#: A day of files counts as complete above so many tickers or underlyings.
COMPLETE = {"stock_quotes": 9000, "stock_trades": 9000, "option_trades": 3000, "option_quotes": 100}


def process_new(spark: SparkSession, source: str, sink: Callable[[DataFrame, int], None], checkpoint: str, schema=None, file_format: str = "parquet", **options) -> None:
    """Passes every file that arrived since the last call to ``sink(rows, batch)`` once (at least once if a call is cut off), then ends.

    The checkpoint remembers what was done and numbers the batches. ``sink`` should key its output by the batch, as
    ``sinks.write_batch`` does: then a repeat does no harm, and a late file of a known date adds to it.
    """
    schema = schema or spark.read.format(file_format).options(**options).load(source).schema
    stream = spark.readStream.format(file_format).schema(schema).options(**options).load(source)
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(sink).start()
    query.awaitTermination()


def new_dates(df: DataFrame, done: DataFrame, date_col: str = "date", more_than: int = 0, of: str = "ticker") -> DataFrame:
    """Rows of the dates that ``done`` doesn't have, or has with ``more_than`` different values of ``of`` at most: such a date isn't complete."""
    if more_than:
        counted = done.groupBy(date_col).agg(F.count_distinct(of).alias("__n")).filter(F.col("__n") > more_than)
    else:
        counted = done.select(date_col).distinct()
    return df.join(counted.select(date_col), date_col, "left_anti")


def stream_trade_bars(trades: DataFrame, interval: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """Last price, last size and volume per ticker and tumbling window of a stream of trades; later rows than ``late`` are left out."""
    order = F.struct("ts", "seq")
    trades = trades.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need instants
    bars = trades.withWatermark("ts", late).groupBy("ticker", F.window("ts", interval).alias("w"))
    return bars.agg(F.max_by("price", order).alias("last"), F.max_by("size", order).alias("last_size"), F.sum("size").alias("volume")).select(
        "ticker", F.col("w.start").alias("window_start"), "last", "last_size", "volume"
    )


def stream_bins(trades: DataFrame, quotes: DataFrame, keys: Sequence[str], interval: int = 10, late: str = "1 minute") -> DataFrame:
    """Intervals of two tick streams that have ticks, each once, when the watermark has passed it.

    Holds the last values of open intervals only. Ticks later than ``late`` are left out and counted in the query's progress
    (numRowsDroppedByWatermark). ``ticks.tq_bars_of_bins`` makes the dense bars of finished days from what a sink has stored.
    """
    both = ticks.stacked(trades, quotes, keys).withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need instants
    bins = both.withWatermark("ts", late).groupBy(*keys, F.window("ts", f"{interval} seconds").alias("w")).agg(*ticks.bin_values())
    start = F.col("w.start").cast("timestamp_ntz")
    return bins.select(F.to_date(start).alias("date"), *keys, start.alias("window_start"), *[c for c in bins.columns if c not in (*keys, "w")])
