"""Partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition: Sequence[str] = ("date",), sort: Sequence[str] = ()) -> None:
    """Overwrites the partitions that ``df`` has and leaves the others; rows of one partition are dealt out by it and by ``sort``.

    Shuffling by partition values avoids a file per task and partition; AQE splits what is too large.
    """
    dealt = df.hint("rebalance", *partition)
    if sort:
        dealt = dealt.sortWithinPartitions(*partition, *sort)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def write_batch(df: DataFrame, path: str, batch: int, partition: Sequence[str] = ("date",), sort: Sequence[str] = ()) -> None:
    """Adds a batch beside what ``path`` has, in partitions of its own (``partition``, batch).

    A later batch with rows of a known date takes nothing away, and a batch that is repeated replaces itself. Readers get
    ``batch`` as a column, by which newer rows of one key can be told from older ones.
    """
    write_table(df.withColumn("batch", F.lit(batch).cast("long")), path, (*partition, "batch"), sort)
