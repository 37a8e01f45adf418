"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from quantloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def as_text(con, relation):
    """Columns of a relation as text, numbers with fractions rounded to 5 places."""
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE SELECT * FROM {relation}").fetchall()}
    real = lambda k: k in ("DOUBLE", "FLOAT") or k.startswith("DECIMAL")
    return {c: f"printf('%.5f', CAST(\"{c}\" AS DOUBLE))" if real(k) else f'CAST("{c}" AS VARCHAR)' for c, k in kinds.items()}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"i14_daily_pipeline"}))  # that one has a test of its own
def test_query(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    if name not in catalog.ORACLES:
        assert got.count() > 0
        return
    con.register("got", got.toArrow())  # results of the tick queries have a million rows
    con.execute(f"CREATE OR REPLACE TABLE want AS {catalog.ORACLES[name]}")
    mine, theirs = as_text(con, "got"), as_text(con, "want")
    assert sorted(mine) == sorted(theirs)
    side = lambda what, columns: "SELECT " + ", ".join(columns[c] for c in sorted(columns)) + f" FROM {what}"
    for one, other in ((side("got", mine), side("want", theirs)), (side("want", theirs), side("got", mine))):
        assert con.execute(f"({one}) EXCEPT ALL ({other}) LIMIT 3").fetchall() == []


def test_every_inventory_id_is_registered():
    have = {n.split("_")[0] for n in catalog.QUERIES}
    want = {f"{k}{i}" for k, n in (("i", 14), ("t", 6), ("a", 3), ("m", 13), ("q", 9), ("o", 18), ("r", 4)) for i in range(1, n + 1)}
    assert want <= have


def test_entry_module_works_without_the_optional_operators(tmp_path):
    import subprocess
    import sys

    for item in ("__spark_entry__.py",):
        (tmp_path / item).write_text(open(f"{os.path.dirname(__file__)}/../{item}").read())
    import shutil

    shutil.copytree(f"{os.path.dirname(__file__)}/../quantloom", tmp_path / "quantloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q7_stock_tq_bars' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_day_bars_are_aggregated_by_hash(spark):
    """Lines aren't sorted for the first and last price of a day."""
    from quantloom.plans import views

    plan = views.day_bars(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_option_bars_are_aggregated_by_hash(spark):
    """Ordered by a struct, first and last prices would have all lines sorted."""
    from quantloom.plans import views

    plan = views.option_bars(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
