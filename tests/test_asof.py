"""The as-of join against a plain search for every row."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quantloom.functions.asof import asof_join, shifted

T0 = dt.datetime(2024, 3, 8, 9, 30)
LEFT = "id long, k string, at timestamp_ntz, v string"
RIGHT = "k string, t timestamp_ntz, p double, q long"


def tables(n_left=120, n_right=200, seed=4):
    r = random.Random(seed)
    when = lambda: T0 + dt.timedelta(seconds=r.randrange(300), microseconds=r.choice([0, 0, 500_000]))
    left = [(i, r.choice(["a", "b", "c", None, "none"]), r.choice([when(), when(), when(), None]), "x") for i in range(n_left)]
    right = [(r.choice(["a", "b", "c", None]), r.choice([when(), when(), None]), r.choice([None, r.random()]), r.choice([None, r.randrange(9)])) for _ in range(n_right)]
    right += [("a", T0 + dt.timedelta(seconds=30), float(k), k) for k in range(400)]  # a hot time: only the first one counts
    return left, right


def plain(left, right, direction, tolerance, exact):
    one = {}
    for k, t, p, q in right:
        if k is not None and t is not None:
            key = lambda v: tuple((x is not None, x or 0) for x in v)
            if (k, t) not in one or key((p, q)) < key(one[k, t]):
                one[k, t] = (p, q)
    out = []
    for i, k, at, v in left:
        found = []
        for c in (0, 1):
            rows = [(t, x[c]) for (kk, t), x in one.items() if kk == k and x[c] is not None] if at is not None else []
            gap = lambda t: abs((t - at).total_seconds())
            rows = [(t, x) for t, x in rows if (tolerance is None or gap(t) <= tolerance)]
            before = [(gap(t), 0, x) for t, x in rows if t < at or exact and t == at]
            after = [(gap(t), 1, x) for t, x in rows if t > at or exact and t == at]
            if direction == "filled":
                every = [(kk_t, x) for kk_t, x in rows]
                found.append(min(before)[2] if before else min(every)[1] if every else None)
            else:
                some = {"backward": before, "forward": after, "nearest": before + after}[direction]
                found.append(min(some)[2] if some else None)
        out.append((i, k, at, v, *found))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize(("direction", "tolerance", "exact"), [("backward", None, True), ("backward", 20, False), ("forward", None, True), ("forward", 20, False), ("nearest", None, True), ("nearest", 7, True), ("nearest", 7, False), ("filled", None, True)])
def test_matches_a_plain_search(spark, direction, tolerance, exact):
    left, right = tables()
    got = asof_join(spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(3), ["k"], "at", "t", ["p", "q"], direction, tolerance, exact)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == plain(left, right, direction, tolerance, exact)


def test_empty_sides_clashes_and_directions(spark):
    left, right = spark.createDataFrame(tables()[0], LEFT), spark.createDataFrame([], RIGHT)
    assert asof_join(left, right, ["k"], "at", "t", ["p"]).filter("p is null").count() == left.count()
    assert asof_join(left.limit(0), right, ["k"], "at", "t", ["p"]).count() == 0
    with pytest.raises(ValueError, match="both"):
        asof_join(left, right.withColumnRenamed("p", "v"), ["k"], "at", "t", ["v"])
    with pytest.raises(ValueError, match="direction"):
        asof_join(left, right, ["k"], "at", "t", ["p"], "sideways")


def test_one_exchange_for_both_tables(spark):
    left, right = tables()
    plan = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "at", "t", ["p", "q"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(("step", "cases"), [(60, [("09:30:30", "09:30:00"), ("09:30:30.1", "09:31:00"), ("09:30:00", "09:30:00"), ("23:59:45", "00:00:00")]), (10, [("09:30:05", "09:30:00"), ("09:30:06", "09:30:10")])])
def test_shifted_takes_the_nearest_grid_time(spark, step, cases):
    rows = spark.createDataFrame([(f"2024-03-08 {a}", b) for a, b in cases], "a string, b string")
    got = rows.select(F.date_format(shifted(F.col("a").cast("timestamp_ntz"), step), "HH:mm:ss").alias("got"), "b").collect()
    assert [r.got for r in got] == [r.b for r in got]


def test_a_forward_join_sorts_once(spark):
    left, right = tables()
    plan = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "at", "t", ["p", "q"], "forward", exact=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
