"""The daily pipeline's query writes every derived table."""

from quantloom.plans import catalog, queries_sources

TABLES = {"last_n_day_bars", "adjusted_day_bars", "adjusted_minute_bars", "stocks_matrix", "stock_tq", "bidask_spreads", "options_matrix", "option_flow"}


def test_all_tables_are_written_and_summed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_sources, "shared_path", lambda spark, what: f"{tmp_path}/{what}")
    rows = catalog.QUERIES["i14_daily_pipeline"](spark, "/root/testdata/sf0.001").collect()
    assert {p.name for p in (tmp_path / "daily").iterdir()} == TABLES
    counted = {name: sum(r.n_rows for r in rows if r.derived_table == name) for name in TABLES}
    assert {name: spark.read.parquet(f"{tmp_path}/daily/{name}").count() for name in TABLES} == counted
    assert {r.derived_table for r in rows if r.digest} == TABLES
