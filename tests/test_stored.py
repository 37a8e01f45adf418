"""Stored tables: merges that touch only what they must, versions, compaction, and dates without a scan."""

import datetime as dt
import random
import re
from pathlib import Path

import pytest

from quantloom.operators import consolidate
from quantloom.sources import sinks, stored

SCHEMA = "ticker string, window_start timestamp_ntz, close double, date date"
D = [dt.date(2024, 1, d) for d in range(1, 6)]


def bars(spark, rows):
    return spark.createDataFrame([(t, dt.datetime.combine(d, dt.time(9, m)), float(c), d) for t, d, m, c in rows], SCHEMA)


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet") if "_compacted" not in str(p)}


def content(df):
    return sorted((r.ticker, r.window_start, r.close) for r in df.collect())


def test_merges_leave_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.merge_into(bars(spark, [("A", d, m, 1) for d in D for m in range(3)]), path)
    before = files(path)
    new = bars(spark, [("A", D[2], 1, 7), ("B", D[2], 0, 8), ("B", D[4], 0, 9)])
    stored.merge_into(new, path)
    after = files(path)
    same = {f for f in before if not re.match(r"date=2024-01-0[35]/", f)}
    assert same <= after and len(same) == 3 and not (before - same) & after
    want = content(consolidate.append_bars(bars(spark, [("A", d, m, 1) for d in D for m in range(3)]), new))
    assert content(spark.read.parquet(path)) == want
    stored.merge_into(new, path)  # repeated: nothing changes
    assert content(spark.read.parquet(path)) == want
    stored.merge_into(bars(spark, [("A", D[2], 1, 99), ("C", D[2], 1, 5)]), path, keep="first")
    got = {r.ticker: r.close for r in spark.read.parquet(path).filter("date = '2024-01-03' and minute(window_start) = 1").collect()}
    assert got == {"A": 7.0, "C": 5.0}


def test_only_touched_partitions_are_read(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "t"), []
    stored.merge_into(bars(spark, [("A", d, 0, 1) for d in D]), path)
    real = stored.write_table
    monkeypatch.setattr(stored, "write_table", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a)))
    stored.merge_into(bars(spark, [("A", D[1], 0, 2)]), path)
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-02|PartitionFilters: \[[^\]]*date#\d+ = \d+|PartitionFilters: \[[^\]]*IN", plans[0])


def test_marks_hold_back_what_is_not_later(spark, tmp_path):
    path, marks = str(tmp_path / "t"), str(tmp_path / "marks")
    r = random.Random(3)
    steps = [[(r.choice("AB"), r.choice(D), r.randrange(40), k) for _ in range(25)] for k in range(4)]
    steps = [list({(t, d, m): (t, d, m, c) for t, d, m, c in s}.values()) for s in steps]
    want = None
    for step in steps:
        stored.merge_into(bars(spark, step), path, marks=marks)
        want = bars(spark, step) if want is None else consolidate.append_bars(want, bars(spark, step), mode="newer_only")
    assert content(spark.read.parquet(path)) == content(want)
    highs = {r.ticker: r.high for r in spark.read.parquet(marks).groupBy("ticker").agg({"high": "max"}).withColumnRenamed("max(high)", "high").collect()}
    assert highs == {t: max(w for tt, w, _ in content(want) if tt == t) for t in "AB"}


def test_compaction_is_invisible_to_readers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored.write_version(bars(spark, [("A", d, m, 1) for d in D for m in range(3)]), path, 0)
    stored.write_version(bars(spark, [("A", D[1], 0, 2), ("B", D[1], 0, 2)]), path, 1)
    stored.write_version(bars(spark, [("A", D[1], 0, 3), ("A", D[3], 2, 3)]), path, 2)
    keys = ["ticker", "window_start"]
    want = content(stored.read_current(spark, path, keys))
    assert len(want) == 16 and ("A", dt.datetime(2024, 1, 2, 9, 0), 3.0) in want
    untouched = {f for f in files(path) if re.match(r"date=2024-01-0[135]/", f)}
    assert stored.compact(spark, path, keys) == 2
    assert content(stored.read_current(spark, path, keys)) == want and untouched <= files(path)
    with_old = files(path)
    # half of the compacted rows only, as a reader in the middle of the commit would see: still the same
    half = next(f for f in sorted(with_old) if "date=2024-01-04/version=5" in f)
    Path(path, half).rename(tmp_path / "aside")
    assert content(stored.read_current(spark, path, keys)) == want
    (tmp_path / "aside").rename(Path(path, half))
    assert stored.vacuum(spark, path) == 5
    assert content(stored.read_current(spark, path, keys)) == want and untouched <= files(path) and len(files(path)) < len(with_old)
    stored.write_version(bars(spark, [("A", D[1], 0, 4)]), path, 3)  # later than the compaction
    assert ("A", dt.datetime(2024, 1, 2, 9, 0), 4.0) in content(stored.read_current(spark, path, keys))
    assert stored.compact(spark, path, keys) == 1 and stored.vacuum(spark, path) == 2 and stored.compact(spark, path, keys) == 0


def test_vacuum_before_any_compaction_does_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.write_version(bars(spark, [("A", D[0], 0, 1)]), path, 0)
    assert stored.vacuum(spark, path) == 0 and stored.compact(spark, path, ["ticker", "window_start"]) == 0 and len(files(path)) == 1


def test_dates_come_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored.partition_values(spark, path) == [] and stored.latest_value(spark, path) is None
    sinks.write_table(bars(spark, [("A", d, 0, 1) for d in D]), path)
    for f in Path(path).rglob("date=2024-01-01/*.parquet"):
        f.write_bytes(b"not parquet")  # whoever opens it fails
    assert stored.partition_values(spark, path) == [str(d) for d in D]
    assert content(stored.read_latest(spark, path)) == [("A", dt.datetime(2024, 1, 5, 9, 0), 1.0)]
    assert len(content(stored.read_recent(spark, path, 2))) == 3
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("names"))
    spark.sparkContext.setJobGroup("names", "")
    try:
        assert stored.latest_value(spark, path) == "2024-01-05" and jobs() == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("keep", ["first", "last"])
def test_an_empty_load_changes_nothing(spark, tmp_path, keep):
    path = str(tmp_path / "t")
    stored.merge_into(bars(spark, [("A", d, 0, 1) for d in D]), path, keep=keep)
    before = files(path)
    stored.merge_into(bars(spark, []), path, keep=keep)
    assert files(path) == before
