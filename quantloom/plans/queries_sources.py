"""Queries of sources, sinks, normalisation and the pipeline. Files are derived from the tables and written to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..functions.series import upsert
from ..functions.shared import shared_path
from ..operators import consolidate, options
from ..sources import readers, sinks, stored
from ..streaming import incremental
from . import views as v
from .daily import DailyConfig, run_daily
from .registry import query
from .views import with_views

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ns(name: str):
    """Nanosecond epoch of a wall clock taken as UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col(name)) * 1000


def _file(spark, df, what: str, absent=()):
    """Files with two headers: one half of the tickers (names of even length) in reverse order with a column more, the others without ``absent``."""
    path = shared_path(spark, what)
    out = lambda rows: rows.write.mode("append").option("header", True).option("compression", "gzip").csv(path)
    even = F.length("ticker") % 2 == 0
    out(df.filter(even).withColumn("venue", F.lit("x")).select("venue", *reversed(df.columns)))
    out(df.filter(~even).drop(*absent))
    return path


def _one_gzip(spark, df, what: str):
    """All rows in one gzip file, as the large feeds come; made by all tasks, only written by one."""
    path = shared_path(spark, what)
    df.repartition(1).write.option("header", True).option("compression", "gzip").csv(path)
    return path


_F32 = lambda c: f"CAST({c} AS FLOAT) AS {c}"


@query("i1_bars_csv", with_views("v_minute_bars") + f" FINAL SELECT ticker, {', '.join(map(_F32, ('open', 'high', 'low', 'close')))}, CASE WHEN length(ticker) % 2 = 0 THEN volume END AS volume, CASE WHEN length(ticker) % 2 = 0 THEN transactions END AS transactions, epoch_us(window_start) AS us, CAST(window_start - INTERVAL 5 HOUR AS DATE) AS date FROM v_minute_bars", dbl=("open", "high", "low", "close"), txt=("date",))
def i1(spark, sf):
    bars = v.minute_bars(spark, sf).select("ticker", "volume", "open", "close", "high", "low", ns("window_start").alias("window_start"), "transactions")
    got = readers.read_bars_csv(spark, _file(spark, bars, "bars", ["volume", "transactions"]), mixed=True)
    return got.select("ticker", "open", "high", "low", "close", "volume", "transactions", F.unix_micros("window_start").alias("us"), "date")


@query("i2_option_ticker", with_views("v_option_bars") + " FINAL SELECT ticker, window_start, underlying, expiry, type, strike FROM v_option_bars", dbl=("strike",), txt=("window_start",), big=("expiry",))
def i2(spark, sf):
    return options.parse_option_ticker(v.option_bars(spark, sf).select("ticker", "window_start"))


def _quotes(df, ticker):
    return df.select(ticker.alias("ticker"), F.lit(1).alias("ask_exchange"), F.col("ask").alias("ask_price"), "ask_size", F.lit(2).alias("bid_exchange"), F.col("bid").alias("bid_price"), "bid_size", ns("ts").alias("sip_timestamp"))


@query("i3_stock_quotes_csv", with_views("v_quotes") + " FINAL SELECT ticker, CAST(ask AS FLOAT) AS ask_price, ask_size, CAST(bid AS FLOAT) AS bid_price, bid_size, epoch_us(ts) * 1000 AS sip_ns, CAST(ts - INTERVAL 5 HOUR AS DATE) AS date FROM v_quotes", dbl=("ask_price", "bid_price"), txt=("date",), big=("ask_size", "bid_size"))
def i3(spark, sf):
    got = readers.read_stock_quotes_csv(spark, _file(spark, _quotes(v.quotes(spark, sf), F.col("ticker")), "quotes", ["ask_exchange"]), mixed=True)
    return got.select("ticker", "ask_price", "ask_size", "bid_price", "bid_size", "sip_ns", "date")


@query("i4_stock_trades_csv", with_views("v_trades") + " FINAL SELECT ticker, CAST(price AS FLOAT) AS price, size, seq AS sequence_number, epoch_us(ts) * 1000 AS sip_ns, epoch_us(ts) AS participant_us, CAST(ts - INTERVAL 5 HOUR AS DATE) AS date FROM v_trades", dbl=("price",), txt=("date",), big=("size",))
def i4(spark, sf):
    t = v.trades(spark, sf)
    null = F.lit(None).cast("long")
    rows = t.select("ticker", F.lit("1,2").alias("conditions"), F.lit(0).alias("correction"), F.lit(4).alias("exchange"), F.col("seq").alias("id"), ns("ts").alias("participant_timestamp"), "price", F.col("seq").alias("sequence_number"), ns("ts").alias("sip_timestamp"), "size", F.lit(1).alias("tape"), null.alias("trf_id"), null.alias("trf_timestamp"))
    got = readers.read_stock_trades_csv(spark, _file(spark, rows, "trades", ["trf_id", "tape"]), mixed=True)
    return got.select("ticker", "price", "size", "sequence_number", "sip_ns", F.unix_micros("participant_timestamp").alias("participant_us"), "date")


def _symbol():
    return F.format_string("O:%s%d%s%08d", F.upper("underlying"), "expiry", "type", (F.col("strike") * 1000).cast("long"))


@query("i5_option_quotes_csv", with_views("v_option_quotes") + " FINAL SELECT upper(underlying) AS underlying, expiry, type, strike, CAST(bid AS FLOAT) AS bid_price, bid_size, epoch_us(ts) * 1000 AS sip_ns FROM v_option_quotes", dbl=("strike", "bid_price"), big=("expiry", "bid_size"))
def i5(spark, sf):
    rows = _quotes(v.option_quotes(spark, sf), _symbol())
    junk = rows.withColumn("ticker", F.lit("O:NOT AN OPTION"))  # dropped by the reader
    return readers.read_option_quotes_csv(spark, _one_gzip(spark, rows.unionByName(junk), "option-quotes")).select("underlying", "expiry", "type", "strike", "bid_price", "bid_size", "sip_ns")


@query("i6_option_trades_csv", with_views("v_option_trades") + " FINAL SELECT upper(underlying) AS underlying, expiry, type, strike, price, size, epoch_us(ts) * 1000 AS sip_ns FROM v_option_trades", dbl=("strike", "price"), big=("expiry", "size"))
def i6(spark, sf):
    t = v.option_trades(spark, sf)
    rows = t.select(_symbol().alias("ticker"), F.lit("209").alias("conditions"), F.lit(0).alias("correction"), F.lit(4).alias("exchange"), ns("ts").alias("participant_timestamp"), "price", ns("ts").alias("sip_timestamp"), "size")
    return readers.read_option_trades_csv(spark, _file(spark, rows, "option-trades", ["correction"]), mixed=True).select("underlying", "expiry", "type", "strike", "price", "size", "sip_ns")


@query("i7_press_json", "SELECT event_type AS ticker, date_trunc('second', ts) - INTERVAL 5 HOUR AS stamp, 'title ' || event_id AS title, props AS text FROM events", txt=("stamp",))
def i7(spark, sf):
    e = v.table(spark, sf, "events")
    rows = e.select(F.col("event_type").alias("ticker"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.concat(F.lit("title "), F.col("event_id").cast("string")).alias("title"), F.col("props").alias("text"))
    path = shared_path(spark, "press")
    rows.write.json(path)  # one object per line here; a file of one object reads alike
    return readers.read_press_json(spark, path, multi_line=False).withColumnRenamed("timestamp", "stamp")


@query("i8_press_pages", "SELECT page_id, list_extract(string_split(rtrim(url, '/'), '/'), -1) AS slug, CAST(NULL AS VARCHAR) AS time_text, '' AS text FROM pages")
def i8(spark, sf):
    return readers.extract_press(v.table(spark, sf, "pages").select("page_id", "url", "html"), split_inline=True).select("page_id", "slug", "time_text", "text")


@query("i8_press_time", "SELECT event_id, date_trunc('minute', ts) + INTERVAL 5 HOUR AS published FROM events", txt=("published",))
def i8_time(spark, sf):
    e = v.table(spark, sf, "events")
    text = F.concat(F.date_format("ts", "MMM d, yyyy h:mm"), F.when(F.hour("ts") < 12, "am").otherwise("PM"), F.lit(" EST"))
    return e.select("event_id", times.parse_press_time(text).alias("published"))


@query(
    "i8_press_built",
    """SELECT event_id, 'story-' || event_id AS slug, strftime(ts, '%b %-d, %Y %-I:%M%p') || ' EST' AS time_text, date_trunc('minute', ts) + INTERVAL 5 HOUR AS stamp,
              'Title ' || event_id || chr(10) || 'inner ' || event_type || chr(10) || 'more' || chr(10) || 'tail & ' || event_id AS text FROM events""",
    txt=("stamp",),
)
def i8_built(spark, sf):
    """A page for every event, with several paragraphs, nested divs, an entity, and divs before and behind the body."""
    e = v.table(spark, sf, "events")
    parts = (
        '<html><div class="nav">menu<div>x</div></div><time class="timestamp__date">', F.date_format("ts", "MMM d, yyyy h:mma"), ' EST</time><div class="body__content"><p>Title ', F.col("event_id").cast("string"),
        '</p><div class="a"><div>inner ', F.col("event_type"), "</div><!-- <div> --><p>more</p></div><script>var s = '</div>';</script>tail &amp; ", F.col("event_id").cast("string"), '</div><div>footer</div></html>',
    )
    html = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    pages = e.select("event_id", F.concat(F.lit("https://example.com/news/story-"), F.col("event_id").cast("string"), F.lit("/")).alias("url"), html.alias("html"))
    return readers.extract_press(pages).select("event_id", "slug", "time_text", F.col("timestamp").alias("stamp"), "text")


_UPSERT = {
    "o": "SELECT ticker, execution_date AS date, split_to AS amount FROM v_splits",
    "n": "SELECT ticker, ex_dividend_date AS date, cash_amount AS amount FROM v_dividends",
}


@query("i9_upsert", with_views("v_splits", "v_dividends", more=_UPSERT) + " FINAL SELECT * FROM o UNION ALL SELECT n.* FROM n ANTI JOIN o USING (ticker, date)", dbl=("amount",), txt=("date",))
def i9(spark, sf):
    old = v.splits(spark, sf).select("ticker", F.col("execution_date").alias("date"), F.col("split_to").alias("amount"))
    new = v.dividends(spark, sf).select("ticker", F.col("ex_dividend_date").alias("date"), F.col("cash_amount").alias("amount"))
    return upsert(old, new, ["ticker", "date"], order=["amount"])


_SPLITS_SQL = "SELECT ticker, TRY_CAST(CASE WHEN year(execution_date) % 3 = 0 THEN 'soon' ELSE CAST(execution_date AS VARCHAR) END AS DATE) AS execution_date, split_from, split_to FROM v_splits"
_LOADED = {
    "n": _SPLITS_SQL,
    "o": "SELECT ticker, execution_date, split_from, split_to + 1 AS split_to FROM v_splits WHERE year(execution_date) % 3 = 1",
    "k": "SELECT *, row_number() OVER (PARTITION BY ticker, execution_date ORDER BY side, split_from, split_to) AS r FROM (SELECT *, 0 AS side FROM o UNION ALL SELECT *, 1 FROM n)",
}


@query("i9_load_splits", with_views("v_splits", more=_LOADED) + " FINAL SELECT ticker, execution_date, split_from, split_to FROM k WHERE r = 1", dbl=("split_from", "split_to"), txt=("execution_date",))
def i9_load(spark, sf):
    known = v.splits(spark, sf)
    old = known.filter(F.year("execution_date") % 3 == 1).withColumn("split_to", F.col("split_to") + 1)
    text = F.when(F.year("execution_date") % 3 == 0, "soon").otherwise(F.col("execution_date").cast("string"))
    new = known.select(F.concat("ticker", F.col("execution_date").cast("string")).alias("id"), "ticker", text.alias("execution_date"), "split_from", "split_to")
    return consolidate.load_actions(new, "splits", old)


@query(
    "i10_assets",
    """SELECT c_name AS symbol, CASE c_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS tradable, CASE WHEN c_nationkey % 5 > 0 THEN c_acctbal END AS price_increment,
       '["' || c_mktsegment || '","' || c_nationkey || '"]' AS attributes FROM customer""",
    dbl=("price_increment",),
)
def i10(spark, sf):
    c = v.table(spark, sf, "customer")
    flag = F.when(F.col("c_nationkey") % 3 == 0, "true").when(F.col("c_nationkey") % 3 == 1, "false").otherwise("maybe")
    number = F.when(F.col("c_nationkey") % 5 > 0, F.col("c_acctbal").cast("string")).otherwise("n/a")
    raw = c.select(F.col("c_name").alias("symbol"), flag.alias("tradable"), number.alias("price_increment"), F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("attributes"))
    return consolidate.normalize_assets(raw)


@query(
    "i11_holdings",
    """SELECT ticker, weight, as_of FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY as_of DESC, weight, name) AS r FROM (
       SELECT 'T' || (c_nationkey * 10 + c_custkey % 10) AS ticker, c_acctbal / 100 AS weight, CAST(TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 28 AS INTEGER)) AS TIMESTAMP) AS as_of, c_name AS name FROM customer)) WHERE r = 1""",
    dbl=("weight",), txt=("as_of",),
)
def i11(spark, sf):
    c = v.table(spark, sf, "customer")
    raw = c.select(
        F.concat(F.lit("T"), (F.col("c_nationkey") * 10 + F.col("c_custkey") % 10).cast("string")).alias("symbol"),
        F.concat(F.col("c_acctbal").cast("string"), F.lit("%")).alias("weight"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 28).cast("int")).cast("string").alias("asOf"),
        F.col("c_name").alias("name"),
    )
    return consolidate.normalize_holdings(raw).select("ticker", "weight", "as_of")


@query("i12_process_new", with_views("v_trades") + " FINAL SELECT ticker, CAST(ts AS DATE) AS date, count(*) AS n, sum(size) AS volume FROM v_trades GROUP BY 1, 2", txt=("date",), big=("volume",))
def i12(spark, sf):
    base = shared_path(spark, "incremental")
    trades = v.trades(spark, sf).withColumn("date", F.to_date("ts"))
    schema = trades.schema
    early = F.col("seq") % 3 > 0  # every date has rows in the first files and late ones
    trades.filter(early).write.parquet(f"{base}/in")
    sink = lambda df, batch: sinks.write_batch(df, f"{base}/out", batch)
    incremental.process_new(spark, f"{base}/in", sink, f"{base}/state", schema)
    trades.filter(~early).write.mode("append").parquet(f"{base}/in")
    incremental.process_new(spark, f"{base}/in", sink, f"{base}/state", schema)  # only the new files
    return spark.read.parquet(f"{base}/out").groupBy("ticker", "date").agg(F.count("*").alias("n"), F.sum("size").alias("volume"))


_NEWEST = """ FINAL SELECT ticker, CAST(ts AS DATE) AS date, seq, CASE WHEN seq % 5 = 0 THEN price + 2 WHEN seq % 3 = 0 THEN price + 1 ELSE price END AS price FROM v_trades"""


def _three_versions(spark, sf) -> str:
    """All trades, then corrections of every third, then of every fifth of them."""
    path = shared_path(spark, "versions")
    trades = v.trades(spark, sf).select("ticker", F.to_date("ts").alias("date"), "seq", "price")
    for batch, (step, more) in enumerate(((1, 0), (3, 1), (5, 2))):
        stored.write_version(trades.filter(F.col("seq") % step == 0).withColumn("price", F.col("price") + more), path, batch)
    return path


@query("i12_versions_before_compaction", with_views("v_trades") + _NEWEST, dbl=("price",), txt=("date",))
def i12_versions(spark, sf):
    return stored.read_current(spark, _three_versions(spark, sf), ["ticker", "seq"])


@query("i12_versions_after_compaction", with_views("v_trades") + _NEWEST, dbl=("price",), txt=("date",))
def i12_compacted(spark, sf):
    path = _three_versions(spark, sf)
    stored.compact(spark, path, ["ticker", "seq"])
    stored.vacuum(spark, path)
    return stored.read_current(spark, path, ["ticker", "seq"])


@query("i13_partitioned_sink", with_views("v_minute_bars") + " FINAL SELECT ticker, window_start, close, CAST(window_start AS DATE) AS date FROM v_minute_bars", dbl=("close",), txt=("window_start", "date"))
def i13(spark, sf):
    path = shared_path(spark, "table")
    bars = v.minute_bars(spark, sf).select("ticker", "window_start", "close")
    sinks.write_table(bars.withColumn("date", times.ny_date(bars, "window_start")), path, sort=["ticker", "window_start"])
    return spark.read.parquet(path)


@query("i14_daily_pipeline")
def i14(spark, sf):
    tables = {
        "day_bars": v.day_bars(spark, sf), "minute_bars": v.minute_bars(spark, sf), "splits": v.splits(spark, sf), "dividends": v.dividends(spark, sf),
        "trades": v.trades(spark, sf), "quotes": v.quotes(spark, sf), "option_bars": v.option_bars(spark, sf),
    }
    done = run_daily(tables, DailyConfig(), shared_path(spark, "daily"))
    rows = None
    for name, df in done.items():
        numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        # every number is read back, so that no column is pruned
        digest = sum((F.coalesce(F.sum(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0))), F.lit(0.0)) for c in numbers), F.lit(0.0))
        one = df.groupBy("date").agg(F.count("*").alias("n_rows"), digest.alias("digest")).select(F.lit(name).alias("derived_table"), "date", "n_rows", "digest")
        rows = one if rows is None else rows.unionByName(one)
    return rows
