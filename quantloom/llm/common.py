"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of plain words: space and the five ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null id where ids are ordered: after every other.
LAST_ID = 2**63 - 1
#: Rows of a task of a small table on average, and its fewest tasks.
TASK_ROWS, LEAST_TASKS = 1 << 14, 12
#: Tables in the shared folder that clean_up deletes.
_WRITTEN: list[str] = []


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once per row, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, separator: str = SPACE) -> Column:
    """Words between separators; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separator), lambda w: w != "")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a folder of this machine only where none is set, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if shared is None and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quantloom-checkpoint-"))
    return shared or context.getCheckpointDir()


def work_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder for a table that cuts lineage."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/quantloom-{what}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def tasks_for(spark: SparkSession, size: float) -> int:
    """Shuffle partitions for ``size`` bytes: the session's number at least, and more where a task would get over 64 MB."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), (int(size) >> 26) + 1)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """The rows in no more tasks than so many rows need: a task writes files for each shuffle, hundreds of them for a small table are mostly empty blocks on disk."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS)))


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder: later jobs read them instead of running the plan again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark notice shuffles that nothing refers to any more, so that their files go before the next step writes its own."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, what: str) -> DataFrame:
    """The rows, written to a table in the shared folder and read from it: cuts lineage, and earlier shuffle files can go."""
    path = work_path(df.sparkSession, what)
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table that this subpackage has written to the shared folder. (Spark has no public call for it.)"""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clean_up(spark: SparkSession) -> None:
    """Deletes all tables that this process has written to the shared folder. Results that read them must be written before."""
    while _WRITTEN:
        remove(spark, _WRITTEN.pop())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
