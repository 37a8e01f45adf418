"""Stored tables that grow: merges that rewrite only what new rows touch, versions that are merged on reading, compaction.

Partition values are read off the names of folders, so finding the latest date, or whether a date exists, opens no data file.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.series import latest_per_key, upsert
from .sinks import write_table

#: Where a partition has no value.
_NONE = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    at, files = _folder(spark, path)
    if not files.exists(at):
        return []
    return [p.toString().rsplit("/", 1)[1] for p in spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(at))]


def folders(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    """Folders of a stored table by the value of its outermost partition column, in order; none if there is no table yet."""
    names = _names(spark, path)
    found = {unquote(n.split("=", 1)[1]): n for n in names if n.startswith(f"{name}=") and not n.endswith(_NONE)}
    return dict(sorted(found.items()))


def partition_values(spark: SparkSession, path: str, name: str = "date") -> list[str]:
    """The values, as text and in order, of the outermost partition column of a stored table."""
    return list(folders(spark, path, name))


def latest_value(spark: SparkSession, path: str, name: str = "date") -> str | None:
    """The greatest value of the outermost partition column."""
    return max(partition_values(spark, path, name), default=None)


def read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The rows of some folders; no other is listed or opened."""
    if not folders:
        return spark.read.parquet(path).filter(F.lit(False))
    return spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])


def read_latest(spark: SparkSession, path: str, name: str = "date") -> DataFrame:
    """The rows of the latest date of a stored table."""
    return read_folders(spark, path, list(folders(spark, path, name).values())[-1:])


def read_recent(spark: SparkSession, path: str, days: int, name: str = "date") -> DataFrame:
    """The dates from ``days`` calendar days before the latest one on, both ends inclusive."""
    found = {date.fromisoformat(v): f for v, f in folders(spark, path, name).items()}
    return read_folders(spark, path, [f for v, f in found.items() if v >= max(found) - timedelta(days=days)])


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _folder(spark, path)
    return files.exists(at)


def signatures(spark: SparkSession, path: str, name: str = "date") -> dict[str, str]:
    """For each partition value of a stored table a digest of its files' paths, sizes and times: a row for each comes to the driver, and no file is opened."""
    if not partition_values(spark, path, name):
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    value = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    one = F.concat_ws(" ", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    found = files.filter(value != "").groupBy(value.alias("v")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(one)), "\n"), 256).alias("s"))
    return {unquote(r.v): r.s for r in found.collect()}


def numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    return [int(v) for v in partition_values(spark, path, name)]


def read_values(spark: SparkSession, path: str, values: Sequence[str], name: str = "date") -> DataFrame:
    """The rows of some partition values; no other folder is listed or opened."""
    found = folders(spark, path, name)
    return read_folders(spark, path, [found[v] for v in values if v in found])


def drop_partitions(spark: SparkSession, path: str, values: Sequence[str], name: str = "date") -> None:
    found = folders(spark, path, name) if values else {}
    for value in values:
        if value in found:
            at, files = _folder(spark, f"{path}/{found[value]}")
            files.delete(at, True)


def _touched(new: DataFrame, name: str) -> list:
    """Partition values of new rows: days, so as many as the calendar has and not as there are rows."""
    return [r[0] for r in new.select(name).distinct().collect()]


def newer_only(new: DataFrame, marks: DataFrame | None, key: str, ts: str) -> DataFrame:
    """New rows later than the latest one of their key in ``marks`` (key, high)."""
    if marks is None:
        return new
    high = marks.groupBy(F.col(key).alias("__key")).agg(F.max("high").alias("__high"))
    known = new.join(high, F.col(key).eqNullSafe(F.col("__key")), "left")
    return known.filter(F.col("__high").isNull() | (F.col(ts) > F.col("__high"))).drop("__key", "__high")


def merge_into(
    new: DataFrame, path: str, keys: Sequence[str] = ("ticker", "window_start"), partition: str = "date", keep: str = "last", sort: Sequence[str] = (), marks: str | None = None, order: Sequence[str] | None = None
) -> None:
    """Merges ``new`` into the table at ``path``, one row per key and partition: the new one (keep "last") or the old one ("first").

    Only partitions that ``new`` has are read and rewritten; the files of all others stay as they are. The partition must
    follow from the key, as a date does from a time. With ``marks``, a path, only rows later than the latest time of their
    first key count: the latest times are a small table of their own that each merge adds to, so the bars aren't read for
    them. It is written after the bars, so a merge that is cut off can be repeated.
    """
    spark = new.sparkSession
    key, ts = keys[0], keys[-1]
    if marks is not None:
        at, files = _folder(spark, marks)
        new = newer_only(new, spark.read.parquet(marks) if files.exists(at) else None, key, ts)
    there = set(partition_values(spark, path, partition))
    touched = _touched(new, partition) if there else []
    if touched:
        old = spark.read.parquet(path)
        old = old.filter(F.col(partition).isin(touched) | (F.col(partition).isNull() if None in touched else F.lit(False)))
        merged = upsert(old, new, [*keys, partition], keep=keep, order=order)
    else:
        merged = upsert(new.limit(0), new, [*keys, partition], keep=keep, order=order)
    write_table(merged, path, [partition], sort or keys)
    if marks is not None:
        seen = spark.read.parquet(path)
        seen = seen.filter(F.col(partition).isin(touched)) if touched else seen
        seen.groupBy(key).agg(F.max(ts).alias("high")).coalesce(1).write.mode("append").parquet(marks)


def write_version(df: DataFrame, path: str, batch: int, partition: str = "date", sort: Sequence[str] = ()) -> None:
    """Adds a batch as a version of its own of the partitions that it has; repeating a batch replaces it."""
    write_table(df.withColumn("version", F.lit(2 * batch).cast("long")), path, (partition, "version"), sort)


def read_current(spark: SparkSession, path: str, keys: Sequence[str], partition: str = "date") -> DataFrame:
    """The table as of now: of each key the row of the newest version (of one version: the last in order of the other columns)."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*keys, "version", partition)]
    order = [F.col("version").desc(), *[F.col(f"`{c}`").desc_nulls_last() for c in rest]]
    return latest_per_key(df, [*keys, partition], order).drop("version")


def _versions(spark: SparkSession, path: str, partition: str) -> dict[str, list[int]]:
    """Versions of each partition value, from the names of folders."""
    out = {}
    for name in _names(spark, path):
        if name.startswith(f"{partition}="):
            out[name] = sorted(int(v.split("=", 1)[1]) for v in _names(spark, f"{path}/{name}") if v.startswith("version="))
    return out


def compact(spark: SparkSession, path: str, keys: Sequence[str], partition: str = "date", sort: Sequence[str] = ()) -> int:
    """Merges partitions with several versions into one new version each; returns how many.

    The new version is odd, so it stands above all that it was made from and below the next batch, and its rows are those
    that ``read_current`` gives anyway. Whoever reads meanwhile, even half of it, gets the same rows. The older versions
    stay until ``vacuum``; the list of finished compactions (``_compacted``) is written last.
    """
    several = {name: v for name, v in _versions(spark, path, partition).items() if len(v) > 1}
    if not several:
        return 0
    df = spark.read.parquet(path)
    tops = spark.createDataFrame([(unquote(n.split("=", 1)[1]), v[-1]) for n, v in several.items()], "__value string, __top long")
    value = F.coalesce(F.col(partition).cast("string"), F.lit(_NONE))
    rows = df.withColumn("__value", value).join(F.broadcast(tops), "__value").filter("version <= __top")  # a row for each stored day
    rest = [c for c in df.columns if c not in (*keys, "version", partition)]
    order = [F.col("version").desc(), *[F.col(f"`{c}`").desc_nulls_last() for c in rest]]
    merged = latest_per_key(rows, [*keys, partition], order)
    merged = merged.withColumn("version", F.when(F.col("__top") % 2 == 0, F.col("__top") + 1).otherwise(F.col("__top") + 2)).drop("__value", "__top")
    write_table(merged, path, (partition, "version"), sort or keys)
    done = [(n, v[-1] + 1 if v[-1] % 2 == 0 else v[-1] + 2) for n, v in several.items()]
    spark.createDataFrame(done, "folder string, version long").coalesce(1).write.mode("append").parquet(f"{path}/_compacted")
    return len(several)


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes versions that a finished compaction has taken up; returns how many. To be run when no reader of them is left."""
    at, files = _folder(spark, f"{path}/_compacted")
    if not files.exists(at):
        return 0
    gone = 0
    marks = spark.read.parquet(f"{path}/_compacted").groupBy("folder").agg(F.max("version").alias("version")).collect()  # a row for each stored day
    for mark in marks:
        folder, _ = _folder(spark, f"{path}/{mark.folder}")
        for s in files.listStatus(folder):
            name = s.getPath().getName()
            if name.startswith("version=") and int(name.split("=", 1)[1]) < mark.version:
                files.delete(s.getPath(), True)
                gone += 1
    return gone
