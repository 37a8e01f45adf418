"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, few_tasks, release


def _with_least(pairs: DataFrame, rows: int) -> DataFrame:
    """Each (u, v) of ``rows`` with ``m``: the least of u and its neighbours. A join, so that Spark can split a node of many links."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return few_tasks(pairs.join(least, "u"), rows)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node that it is linked to, itself included.

    Loops and repeated or reversed edges do no harm; without edges there are no rows. Every round is cut by a checkpoint, after
    which the shuffle files of the one before can go.
    """
    now = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            break
        seen, n = mark, mark["n"]
        release(edges.sparkSession)
        now = few_tasks(now, n)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = few_tasks(_with_least(both, n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), n)
        small = _with_least(large, n)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = cut(few_tasks(small, n))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
