"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_ROUNDED: dict[str, tuple[str, ...]] = {}


def query(name: str, sql: str | None = None, dbl: tuple[str, ...] = (), txt: tuple[str, ...] = (), big: tuple[str, ...] = ()):
    """Registers a function as query ``name``. ``sql`` gives the same rows; dbl, txt and big name its columns to round, to make text, to make 64-bit."""

    def register(f):
        _ROUNDED[name] = dbl
        QUERIES[name] = lambda spark, sf_dir: presented(f(spark, sf_dir), dbl)
        if sql is not None:
            swaps = [f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in dbl] + [f"CAST({c} AS VARCHAR) AS {c}" for c in txt] + [f"CAST({c} AS BIGINT) AS {c}" for c in big]
            ORACLES[name] = _finish(sql, f"SELECT * REPLACE ({', '.join(swaps)})" if swaps else "SELECT *")
        return f

    return register


def same_rows(name: str, of: str):
    """Registers a function as query ``name`` that gives the rows of query ``of`` another way, under the same SQL."""

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: presented(f(spark, sf_dir), _ROUNDED[of])
        ORACLES[name] = ORACLES[of]
        return f

    return register


def _finish(sql: str, select: str) -> str:
    """The body of ``sql`` (after its last FINAL mark) under the outer select."""
    head, mark, body = sql.rpartition("FINAL")
    return f"{head}{select} FROM ({body})" if mark else f"{select} FROM ({sql})"


def presented(df: DataFrame, dbl: tuple[str, ...] = ()) -> DataFrame:
    """Doubles (and ``dbl``) rounded to 6 places, decimals as double, times and dates as text, whole numbers as long."""
    out = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in dbl or isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out[f.name] = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = c.cast("long")
    return df.withColumns(out)
