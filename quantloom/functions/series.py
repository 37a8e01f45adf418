"""Time-series building blocks on windows: gap filling, exponential means, ranking, upserts.

Everything grows forward (``unboundedPreceding`` to the current row), so each row is linear work, and all of it can share
one partitioning by key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .times import seconds


def growing(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def ffill(c: str | Column, w: WindowSpec) -> Column:
    """The last value that isn't null so far; ``w`` must be growing."""
    return F.last(c, ignorenulls=True).over(w)


def ffill_bfill(c: str, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Forward fill, then the first value for what leads it."""
    return F.coalesce(ffill(c, growing(keys, order)), F.first(c, ignorenulls=True).over(whole(keys, order)))


def densify(df: DataFrame, keys: Sequence[str], ts: str, step: int, bounds: Sequence[str] | None = None, fill: Sequence[str] = (), zero: Sequence[str] = ()) -> DataFrame:
    """A row every ``step`` seconds per key: gaps are filled in by stretching each row to the next one, without a join.

    ``bounds`` names the columns of the first and last time of the key's grid (times inside them only are generated);
    without it the key's own first and last time. ``fill`` columns are filled forward, then backward; ``zero`` columns are
    0 in new rows and where null. Other columns repeat. ``is_new`` tells generated rows.
    """
    order = [ts]
    w = Window.partitionBy(*keys).orderBy(*order)
    filled = df.withColumns({c: ffill_bfill(c, keys, order) for c in fill})
    begin = F.when(F.row_number().over(w) == 1, F.col(bounds[0])).otherwise(F.col(ts)) if bounds else F.col(ts)
    end = F.coalesce(F.lead(ts).over(w) - seconds(step), F.col(bounds[1]) if bounds else F.col(ts))
    spread = filled.withColumns({"__begin": begin, "__end": end}).filter("__begin <= __end")  # repeated times: one of them stands
    spread = spread.withColumn("__at", F.explode(F.sequence("__begin", "__end", seconds(step))))
    new = F.col("__at") != F.col(ts)
    return (
        spread.withColumns({c: F.when(new, F.lit(0)).otherwise(F.coalesce(c, F.lit(0))).cast(df.schema[c].dataType) for c in zero})
        .withColumns({"is_new": new, ts: F.col("__at")})
        .drop("__begin", "__end", "__at")
    )


#: Natural logarithm of the weights that stand side by side in one block of an exponential mean: e^200 is far from overflow.
_SPAN = 200.0


def ewm_means(df: DataFrame, keys: Sequence[str], order: Sequence[str], means: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """Adds exponentially weighted means with adjusted weights, ``means`` by name as (values without nulls, alpha), for series of any length.

    A scan in two levels on one exchange: rows go in blocks, short enough for the closed form (the sum of x_k r^-k, with
    r = 1 - alpha) to keep its digits; what the block before has gathered is carried in with its decay. What lies further
    back has a weight below r^block, at most 1e-16 of the newest row's for any of the alphas (or there is a block for each alpha).
    """
    if not all(0 < alpha < 1 for _, alpha in means.values()):
        raise ValueError("alpha must lie between 0 and 1")
    rates = [-math.log1p(-alpha) for _, alpha in means.values()]
    if max(rates) > 5 * min(rates):  # a block that suits the fastest is too short for the slowest
        for name, one in means.items():
            df = ewm_means(df, keys, order, {name: one})
        return df
    rows = max(1, int(_SPAN / max(rates)))
    i = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    df = df.withColumn("__i", i).withColumns({"__b": F.floor((F.col("__i") - 1) / F.lit(rows)), "__j": (F.col("__i") - 1) % rows})
    inside = growing([*keys, "__b"], order)
    line = Window.partitionBy(*keys).orderBy("__b", *order)
    power = lambda alpha, n: F.exp(F.lit(math.log1p(-alpha)) * n)
    df = df.withColumns({f"__n{k}": F.sum(c / power(alpha, F.col("__j"))).over(inside) * power(alpha, F.col("__j")) for k, (c, alpha) in enumerate(means.values())})
    df = df.withColumns({f"__c{k}": F.when(F.col("__j") == 0, F.lag(f"__n{k}").over(line)) for k in range(len(means))})
    out = {}
    for k, (name, (_, alpha)) in enumerate(means.items()):
        carried = F.coalesce(F.first(f"__c{k}").over(inside), F.lit(0.0)) * power(alpha, F.col("__j") + 1)
        weights = -F.expm1(F.lit(math.log1p(-alpha)) * F.col("__i")) / F.lit(alpha)
        out[name] = (F.col(f"__n{k}") + carried) / weights
    return df.withColumns(out).drop("__i", "__b", "__j", *[f"__{c}{k}" for k in range(len(means)) for c in "nc"])


def decayed_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], decay: Column, sums: Mapping[str, Column]) -> DataFrame:
    """Adds running sums y = decay * (y before) + x, ``sums`` by name as x (null: 0), for series of any length.

    ``decay`` lies in [0, 1] and is never null. As in ``ewm_means``, rows go in blocks, here ended by the decay that has come
    together: a block holds a factor of e^-200 at most, and the sum at the end of the block before is carried in. What lies
    further back has decayed by more than e^200.
    """
    line = growing(keys, order)
    df = df.withColumn("__d", decay).withColumn("__l", F.sum(-F.ln(F.greatest("__d", F.lit(1e-300)))).over(line))
    df = df.withColumn("__b", F.floor(F.col("__l") / _SPAN))
    inside = growing([*keys, "__b"], order)
    first = F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(*order)) == 1
    df = df.withColumn("__first", first).withColumn("__p", F.product(F.when(F.col("__first"), F.lit(1.0)).otherwise(F.col("__d"))).over(inside))
    df = df.withColumns({f"__n{k}": F.sum(F.coalesce(x, F.lit(0.0)) / F.col("__p")).over(inside) * F.col("__p") for k, x in enumerate(sums.values())})
    ordered = Window.partitionBy(*keys).orderBy("__b", *order)
    df = df.withColumns({f"__c{k}": F.when(F.col("__first"), F.lag(f"__n{k}").over(ordered) * F.col("__d")) for k in range(len(sums))})
    out = {name: F.col(f"__n{k}") + F.coalesce(F.first(f"__c{k}").over(inside), F.lit(0.0)) * F.col("__p") for k, name in enumerate(sums)}
    return df.withColumns(out).drop("__d", "__l", "__b", "__first", "__p", *[f"__{c}{k}" for k in range(len(sums)) for c in "nc"])


def ewm_gaps(known: Column, position: Column, keys: Sequence[str], order: Sequence[str], alpha: float) -> tuple[Column, Column]:
    """(share, decay) of a recursive exponential mean (first value whole) over rows of which only some are ``known``.

    After k unknown rows the old mean has weight (1 - alpha)^(k + 1) against alpha. The mean is the ``decayed_sums`` of
    share x value over the known rows.
    """
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    gap = position - F.max(F.when(known, position)).over(before)
    kept = F.pow(F.lit(1 - alpha), gap)
    r = F.when(known, kept / (kept + F.lit(alpha)))  # null for the first known row, which takes all
    return (1 - F.coalesce(r, F.lit(0.0))), F.coalesce(r, F.lit(1.0))


def top_n_by(df: DataFrame, group: Sequence[str], key: str, value: Column, n: int) -> DataFrame:
    """Rows of the n keys per group with the largest sum of ``value`` (ties: the smaller key); n = 0 keeps all."""
    if not n:
        return df
    sums = df.groupBy(*group, key).agg(F.sum(value).alias("__v"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("__v").desc(), F.col(key)))
    best = sums.withColumn("__r", rank).filter(F.col("__r") <= n).select(*group, key)
    return df.join(best, [*group, key], "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__r", rank).filter("__r = 1").drop("__r")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], keep: str = "first", order: Sequence[str] | None = None) -> DataFrame:
    """Union of both with one row per key: the old one (keep="first") or the new one ("last").

    Of several rows of one side the first or last in ``order`` counts (default: the columns that aren't keys), nulls first.
    """
    if order is None:
        order = [c for c in [*old.columns, *(c for c in new.columns if c not in old.columns)] if c not in keys]
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    by = [F.col("__side"), *[F.col(c) for c in order]]
    return latest_per_key(both, keys, [c.asc_nulls_first() if keep == "first" else c.desc_nulls_last() for c in by]).drop("__side")
