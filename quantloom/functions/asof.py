"""As-of join: each row of one table with the values that another table had at its time.

Both tables are stacked by key and sorted once by time, and a growing window carries the last values forward, so the work is
linear in the rows of both, however many of either a key has; there is no range join and no list of rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .times import seconds

DIRECTIONS = ("backward", "forward", "nearest", "filled")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    columns: Sequence[str],
    direction: str = "backward",
    tolerance: int | None = None,
    exact: bool = True,
    first_of: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``left`` once, with ``columns`` of ``right`` as of ``left_on``: each column's value that isn't null, by itself.

    direction: "backward" takes the last one at or before the time, "forward" the first one at or after it, "nearest" the
    closer of both (half way: the earlier), "filled" the last one before it or else the first of all. ``tolerance``: the
    furthest distance in seconds. ``exact``: whether rows of just the same time count. Of several rows of ``right`` with one
    key and time only the first in order of ``first_of`` counts (default: all its other columns).

    Rows of ``left`` with a null key or time stay, with nulls. Columns that ``left`` has too aren't allowed.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"unknown direction {direction!r}")
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"columns in both tables: {', '.join(sorted(clash))}")
    keys = [f"__k{i}" for i in range(len(by))]
    ties = list(first_of) if first_of is not None else [c for c in right.columns if c not in (*by, right_on)]
    known = F.col(right_on).isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    given = right.filter(known).select(*[F.col(k).alias(n) for k, n in zip(by, keys, strict=True)], F.col(right_on).alias("__t"), F.struct(*[F.col(c) for c in columns]).alias("__v"), F.struct(*[F.col(c) for c in ties] or [F.lit(0).alias("x")]).alias("__o"))
    # a null key is a group of its own, in which there is nothing of right
    asking = left.select(*[F.col(k).alias(n) for k, n in zip(by, keys, strict=True)], F.col(left_on).alias("__t"), row.alias("__row"))
    both = given.withColumn("__side", F.lit(1)).unionByName(asking.withColumn("__side", F.when(F.col("__t").isNull(), 0).otherwise(2 if exact else 0)), allowMissingColumns=True)
    order = ["__t", "__side", "__o"]
    up = Window.partitionBy(*keys).orderBy(*order)
    # the other way round; rows that ask stand behind those of their time here too
    down = Window.partitionBy(*keys).orderBy(F.col("__t").desc(), "__side", F.col("__o").desc())
    # of rows of one time the first in order counts: it stands first upwards and last downwards; a forward join sorts once, downwards
    beside, way = (F.lead, down) if direction == "forward" else (F.lag, up)
    again = (F.col("__side") == 1) & (beside("__t").over(way) == F.col("__t")) & (beside("__side").over(way) == 1)
    both = both.withColumn("__v", F.when(~F.coalesce(again, F.lit(False)), F.col("__v")))
    before = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = {}
    for i, c in enumerate(columns):
        at = F.when(F.col(f"__v.{c}").isNotNull(), F.struct("__t", F.col(f"__v.{c}").alias("v")))
        if direction != "forward":
            found[f"__b{i}"] = F.last(at, ignorenulls=True).over(before)
        if direction in ("forward", "nearest"):
            found[f"__a{i}"] = F.last(at, ignorenulls=True).over(after)
        if direction == "filled":
            found[f"__a{i}"] = F.first(at, ignorenulls=True).over(everything)
    done = both.withColumns(found).filter("__side <> 1")

    def near(pair: str) -> Column:
        gap = F.abs(F.timestamp_diff("MICROSECOND", F.col(f"{pair}.__t").cast("timestamp_ntz"), F.col("__t").cast("timestamp_ntz")))
        fits = F.col(pair).isNotNull() if tolerance is None else gap <= tolerance * 1_000_000
        return F.when(fits, F.struct(gap.alias("gap"), F.lit(int(pair.startswith("__a"))).alias("side"), F.col(f"{pair}.v").alias("v")))

    values = []
    for i, c in enumerate(columns):
        pairs = [p for p in (f"__b{i}", f"__a{i}") if p in found]
        if direction == "nearest":
            value = F.array_min(F.array_compact(F.array(*[near(p) for p in pairs])))["v"]
        else:
            value = F.coalesce(*[near(p)["v"] for p in pairs])
        values.append(F.when(F.col("__t").isNotNull(), value).alias(c))
    return done.select("__row.*", *values)


def shifted(at: Column, step: int) -> Column:
    """The grid time of ``step`` seconds that is nearest to ``at``; half way, the earlier."""
    floor = F.date_trunc("day", at).cast("timestamp_ntz") + seconds(F.floor((F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)) / F.lit(step)) * step)
    return F.when(F.timestamp_diff("MICROSECOND", floor, at) > step * 500_000, floor + seconds(step)).otherwise(floor)
