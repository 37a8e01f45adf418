"""Vendor files as typed tables: columns by header name, declared types, nanosecond stamps kept as the ordering column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import NEW_YORK, parse_press_time
from ..operators.options import parse_option_ticker

#: The columns of the vendor's files and their types; files may have them in any order, with others, or lack some.
BARS = "ticker string, volume double, open double, close double, high double, low double, window_start long, transactions long"
QUOTES = "ticker string, ask_exchange short, ask_price float, ask_size int, bid_exchange short, bid_price float, bid_size int, sip_timestamp long"
TRADES = (
    "ticker string, conditions string, correction byte, exchange short, id long, participant_timestamp long, price float, sequence_number long, "
    "sip_timestamp long, size int, tape byte, trf_id long, trf_timestamp long"
)
OPTION_TRADES = "ticker string, conditions string, correction byte, exchange short, participant_timestamp long, price double, sip_timestamp long, size int"


def instant(name: str) -> Column:
    """Timestamp of a column of nanosecond epochs, cut to microseconds (whole-number division: doubles lose digits here)."""
    return F.expr(f"timestamp_micros(`{name}` div 1000)")


#: Most columns of a file whose header may differ from the others'.
WIDEST = 64


#: Lines of a file that are dealt out together.
DEALT_LINES = 1 << 15


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("ignoreCorruptFiles", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def deal_lines(spark: SparkSession, path, lines: int = DEALT_LINES) -> DataFrame:
    """(file, line) of text files, plain or gzip, dealt over tasks in blocks of ``lines`` consecutive lines of a file.

    A gzip file can't be split: one task has to unpack it. Here it does no more than that; it streams the lines on as they
    come, holding one block of the codec, and everything after (fields, types, tickers, sorting) is spread by the bytes of the
    blocks, however few files there are. The file is read once.
    """
    text = _lines(spark, path)
    block = F.struct("file", F.expr(f"monotonically_increasing_id() div {lines}"))
    return text.filter("line <> ''").withColumn("__block", F.xxhash64(block)).hint("rebalance", "__block").drop("__block")


def _csv(spark: SparkSession, path, schema: str, keys: tuple[str, ...], mixed: bool, deal: bool = False) -> DataFrame:
    """CSV by header names, gzip or plain, with a null column for each that is absent; unreadable and empty files give no rows.

    ``deal``: lines are dealt over tasks before they are parsed, for few large gzip files; a field then can't hold a line break.

    All files must have one header, and the job fails at a file with another; with ``mixed`` every file's own header
    counts (headers are a scan of their own). A file without one of the ``keys`` fails, or the call does. (Spark's own
    check of headers can't be used: a file that fails it counts as corrupt and would be skipped.)
    """
    columns = [c.split() for c in schema.split(", ")]
    raw = spark.read.option("mode", "PERMISSIVE").option("ignoreCorruptFiles", True)
    expected = [] if mixed else [c.strip() for c in raw.option("header", True).csv(path).columns]
    missing = [k for k in keys if k not in expected]
    if expected and missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}; there are {', '.join(expected)}")
    names = [f"c{i}" for i in range(len(expected) + 1 if expected else WIDEST)]
    fields = ", ".join(f"{n} string" for n in names)
    if deal:
        # as a generator, which no filter is pushed through: as a plain column each line is parsed anew for each of its cells
        parsed = F.inline(F.array(F.from_csv("line", fields, {"mode": "PERMISSIVE"})))
        cells_of = lambda text: text.select("file", "line", parsed).select("file", "line", F.array(*names).alias("cells"))
        lines = cells_of(deal_lines(spark, path))
    else:
        cells = raw.option("header", False).schema(fields).csv(path)
        lines = cells.select(F.col("_metadata.file_path").alias("file"), F.array(*names).alias("cells"))
    trimmed = F.transform("cells", lambda c: F.trim(c))
    is_head = F.array_contains(trimmed, keys[0])
    if deal:  # few lines need a look at their cells
        is_head = F.contains("line", F.lit(keys[0])) & is_head
    fails = lambda text: F.raise_error(F.concat(F.lit(text), "file")).cast("boolean")
    if expected:
        same = trimmed == F.array(*[F.lit(c) for c in expected], F.lit(None).cast("string"))
        rows = lines.filter(F.when(~F.coalesce(is_head, F.lit(False)), F.lit(True)).when(same, F.lit(False)).otherwise(fails("another header than in the first file: ")))
        pick = {n: F.col("cells")[expected.index(n)] if n in expected else F.lit(None).cast("string") for n, _ in columns}
    else:
        # files with a header have a row here, and lines of the others meet none; a row for each file is small, and files
        # may be few, so it is broadcast and no line is shuffled by its file
        heads = cells_of(_lines(spark, path).filter(F.contains("line", F.lit(keys[0])))) if deal else lines
        heads = heads.filter(is_head).groupBy("file").agg(F.first(trimmed).alias("head"))
        rows = lines.filter(~F.coalesce(is_head, F.lit(False))).join(F.broadcast(heads), "file", "left").withColumn("head", F.coalesce("head", F.array(F.lit(""))))
        checked = F.col("cells")
        for key in keys:
            failing = F.raise_error(F.concat(F.lit(f"no column {key} in "), "file")).cast("array<string>")
            checked = F.when(F.array_contains("head", key), checked).otherwise(failing)
        rows = rows.withColumn("cells", checked)
        pick = {n: F.get("cells", F.array_position("head", n).cast("int") - 1) for n, _ in columns}
    return rows.select(*[pick[n].try_cast(kind).alias(n) for n, kind in columns])


_BAR_KEYS, _TICK_KEYS = ("ticker", "window_start"), ("ticker", "sip_timestamp")


def read_bars_csv(spark: SparkSession, path, tz: str = NEW_YORK, mixed: bool = False) -> DataFrame:
    """Bars with prices as float and window_start as instant, sorted by key within partitions; null volume and transactions where files have none.

    Volume is a whole number, except with tz "UTC" (currencies), where it keeps its fraction.
    """
    volume = F.col("volume") if tz == "UTC" else F.col("volume").cast("long")
    df = _csv(spark, path, BARS, _BAR_KEYS, mixed).filter(F.col("ticker").isNotNull()).select(
        "ticker", *[F.col(c).cast("float").alias(c) for c in ("open", "high", "low", "close")], volume.alias("volume"), "transactions", instant("window_start").alias("window_start")
    )
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.convert_timezone(None, F.lit("UTC"), F.col("window_start").cast("timestamp_ntz")))
    return df.withColumn("date", F.to_date(local)).sortWithinPartitions("ticker", "window_start")


def read_option_bars_csv(spark: SparkSession, path, on_invalid: str = "error", mixed: bool = False) -> DataFrame:
    """Option bars keyed by underlying, expiry, type, strike and window_start; a bad ticker fails the job unless told otherwise."""
    df = parse_option_ticker(read_bars_csv(spark, path, mixed=mixed), on_invalid=on_invalid)
    return df.sortWithinPartitions("underlying", "expiry", "type", "strike", "window_start")


def _ticks(df: DataFrame) -> DataFrame:
    stamped = df.withColumns({"sip_ns": F.col("sip_timestamp"), "sip_timestamp": instant("sip_timestamp")})
    return stamped.withColumn("date", F.to_date(F.convert_timezone(None, F.lit(NEW_YORK), F.col("sip_timestamp").cast("timestamp_ntz"))))


def read_stock_quotes_csv(spark: SparkSession, path, mixed: bool = False) -> DataFrame:
    """Stock quotes sorted by ticker and time within partitions."""
    return _ticks(_csv(spark, path, QUOTES, _TICK_KEYS, mixed)).sortWithinPartitions("ticker", "sip_ns")


def read_stock_trades_csv(spark: SparkSession, path, mixed: bool = False) -> DataFrame:
    """Stock trades; the participant's stamp becomes an instant too, the reporting facility's stays a number."""
    df = _ticks(_csv(spark, path, TRADES, _TICK_KEYS, mixed)).withColumn("participant_timestamp", instant("participant_timestamp"))
    return df.sortWithinPartitions("ticker", "sip_ns", "sequence_number")


def _by_underlying(ticks: DataFrame, *order: str) -> DataFrame:
    """Sorted runs of each date and underlying: an underlying with many rows is split over tasks, small ones share one."""
    return ticks.hint("rebalance", "date", "underlying").sortWithinPartitions("date", "underlying", *order)


def read_option_quotes_csv(spark: SparkSession, path, mixed: bool = False, deal: bool = True) -> DataFrame:
    """Option quotes by underlying and time; tickers that don't parse are dropped.

    A feed of one large gzip file is read once and dealt over all tasks (``deal``). Each task returns sorted runs; an
    underlying that is larger than a task's share lies in several.
    """
    df = parse_option_ticker(_ticks(_csv(spark, path, QUOTES, _TICK_KEYS, mixed, deal)), on_invalid="drop")
    return _by_underlying(df, "sip_ns")


def read_option_trades_csv(spark: SparkSession, path, on_invalid: str = "error", mixed: bool = False, deal: bool = True) -> DataFrame:
    """Option trades by underlying, expiry, type, strike and time, dealt as quotes are; a bad ticker fails the job unless told otherwise."""
    df = parse_option_ticker(_ticks(_csv(spark, path, OPTION_TRADES, _TICK_KEYS, mixed, deal)), on_invalid=on_invalid)
    return _by_underlying(df, "expiry", "type", "strike", "sip_ns")


def read_press_json(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """Press releases, one JSON object per file (or per line); unreadable ones are skipped. Stamps become New York wall clock."""
    schema = "ticker string, timestamp string, title string, text string, _bad string"
    raw = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    at = F.try_to_timestamp("timestamp")
    return raw.filter(F.col("_bad").isNull()).drop("_bad").withColumn("timestamp", F.convert_timezone(None, F.lit(NEW_YORK), at.cast("timestamp_ntz"))).sortWithinPartitions("ticker", "timestamp")


def url_slug(url: Column) -> Column:
    """Last path segment of a url."""
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


#: Tags that stand inside a line.
_INLINE = r"(?i)</?(?:a|abbr|b|big|cite|code|em|font|i|ins|label|mark|q|s|small|span|strong|sub|sup|u)(?:\s[^>]*)?/?>"


def _plain(text: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))


def strip_tags(html: Column) -> Column:
    """Text of an HTML fragment: tags out, the five basic entities resolved, blanks trimmed."""
    return _plain(F.regexp_replace(html, r"(?s)<[^>]*>", ""))


def text_lines(html: Column, split_inline: bool = False) -> Column:
    """Text of an HTML fragment with a line for each piece between tags, trimmed, blank ones dropped; inline tags split lines only if asked for."""
    pieces = F.split(html if split_inline else F.regexp_replace(html, _INLINE, ""), r"</?[a-zA-Z!?][^>]*>")
    return F.array_join(F.filter(F.transform(pieces, _plain), lambda p: p != ""), "\n")


def _inside_div(tail: Column) -> Column:
    """What stands before the closing tag of a div whose opening tag is just before ``tail``; all of it without one."""
    pieces = F.split(tail, r"(?i)(?=</?div[\s/>])")

    def step(state, piece):
        move = F.when(piece.rlike(r"(?i)^</div[\s/>]"), -1).when(piece.rlike(r"(?i)^<div[\s>/]") & ~piece.rlike(r"(?i)^<div[^>]*/>"), 1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + move).otherwise(0)
        return F.struct(depth.cast("int").alias("depth"), (state["n"] + (depth > 0).cast("int")).alias("n"))

    n = F.aggregate(pieces, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), step, lambda state: state["n"])
    return F.array_join(F.slice(pieces, F.lit(1), n), "")


def extract_press(pages: DataFrame, url_col: str = "url", html_col: str = "html", split_inline: bool = False) -> DataFrame:
    """Adds slug, time_text (null without the tag), timestamp (UTC wall clock, null where unparsed) and text ("" without a body).

    The time stands in ``<time class="timestamp__date">``, the body in ``<div class="body__content">`` up to the closing
    tag at the same depth. Comments, scripts and styles don't count. Each piece of the body is a line; the reference also
    starts one at inline tags, as with ``split_inline``.
    """
    html = F.regexp_replace(html_col, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "<!>")
    stamp = F.nullif(F.regexp_extract(html, r'(?s)<time[^>]*class="[^"]*\btimestamp__date\b[^"]*"[^>]*>(.*?)</time>', 1), F.lit(""))
    tail = F.regexp_extract(html, r'(?s)<div[^>]*class="[^"]*\bbody__content\b[^"]*"[^>]*>(.*)', 1)
    when = strip_tags(stamp)
    text = F.coalesce(text_lines(_inside_div(tail), split_inline), F.lit(""))
    return pages.withColumns({"slug": url_slug(F.col(url_col)), "time_text": when, "timestamp": parse_press_time(when), "text": text})
