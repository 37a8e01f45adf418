"""One large gzip file with a hot underlying: unpacked by one task, everything else spread over all."""

import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quantloom.sources import readers

HEAD = "ticker,ask_exchange,ask_price,ask_size,bid_exchange,bid_price,bid_size,sip_timestamp"
N = 120_000


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    """Every third row is of one underlying."""
    path = tmp_path_factory.mktemp("feed") / "quotes.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write(HEAD + "\n")
        for i in range(N):
            name = "SPX" if i % 3 == 0 else f"U{chr(65 + i % 26)}{chr(65 + i % 17)}"
            f.write(f"O:{name}240216{'CP'[i % 2]}{100_000 + 5_000 * (i % 9):08d},1,{i % 97}.5,2,3,{i % 89}.25,4,{1_704_205_800_000_000_000 + 7_919 * (i * 31 % N)}\n")
            if i % 1000 == 0:
                f.write("\n" if i % 2000 else "O:NOT AN OPTION,1,1,1,1,1,1,1704205800000000000\n")
    return str(path)


@pytest.fixture
def small_shares(spark):
    """Tasks of 8 kB (compressed) instead of 64 MB, over 32 partitions."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shares(df):
    """Rows of each task; every column is read, so that none is pruned from what is dealt."""
    marked = df.select(F.spark_partition_id().alias("p"), F.xxhash64(*df.columns).alias("h"))
    return [r.n for r in marked.groupBy("p").agg(F.count("*").alias("n"), F.max("h")).collect()]


def test_no_task_gets_more_than_a_tenth(spark, feed, small_shares):
    lines = shares(readers.deal_lines(spark, feed, lines=500).select("line"))
    assert sum(lines) == N + 61 and max(lines) <= 0.1 * N
    rows = readers.read_option_quotes_csv(spark, feed)
    counts = shares(rows)
    assert sum(counts) == N and max(counts) <= 0.1 * N and len(counts) >= 10
    hot = shares(rows.filter("underlying = 'SPX'"))
    assert sum(hot) == N // 3 and len(hot) >= 4


def test_rows_and_runs_are_those_of_the_plain_reader(spark, feed):
    columns = ["date", "underlying", "expiry", "type", "strike", "bid_price", "ask_price", "bid_size", "sip_ns"]
    digest = lambda df: df.select(F.count("*"), *[F.sum(F.xxhash64(c).cast("decimal(30,0)")) for c in columns], F.sum(F.xxhash64(*columns).cast("decimal(30,0)"))).first()
    dealt, plain = readers.read_option_quotes_csv(spark, feed), readers.read_option_quotes_csv(spark, feed, deal=False)
    assert digest(dealt) == digest(plain)
    runs = dealt.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), "date", "underlying", "sip_ns")
    by = {}
    for r in sorted(runs.collect(), key=lambda r: (r.p, r.i)):
        by.setdefault(r.p, []).append((r.date, r.underlying, r.sip_ns))
    assert all(rows == sorted(rows) for rows in by.values())


def test_the_file_is_scanned_once(spark, feed):
    plan = readers.read_option_quotes_csv(spark, feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "rangepartitioning" not in plan


def test_quoted_fields_absent_columns_and_bad_files(spark, tmp_path):
    path = tmp_path / "trades"
    path.mkdir()
    rows = ['O:SPX240216C00100000,"209,227",0,4,1704205800000000000,1.5,1704205800000000001,3', 'O:A240216P00100000,209,0,4,1704205800000000000,2.5,1704205800000000000,1']
    with gzip.open(path / "a.csv.gz", "wt") as f:
        f.write("ticker,conditions,correction,exchange,participant_timestamp,price,sip_timestamp,size\n" + "\n".join(rows) + "\n")
    (path / "broken.csv.gz").write_bytes(b"\x1f\x8bnot gzip")
    (path / "empty.csv.gz").write_bytes(b"")
    got = readers.read_option_trades_csv(spark, str(path / "[ae]*.gz")).collect()
    assert Counter((r.underlying, r.conditions, r.price, r["size"]) for r in got) == Counter([("SPX", "209,227", 1.5, 3), ("A", "209", 2.5, 1)])
    mixed = readers.read_option_trades_csv(spark, str(path), mixed=True)
    assert mixed.count() == 2
    with gzip.open(path / "a2.csv.gz", "wt") as f:  # another header: by its own names
        f.write("size,ticker,sip_timestamp\n7,O:A240216P00100000,1704205800000000005\n")
    got = readers.read_option_trades_csv(spark, str(path / "a*.gz"), mixed=True)
    assert Counter((r.underlying, r.price, r["size"]) for r in got.collect()) == Counter([("SPX", 1.5, 3), ("A", 2.5, 1), ("A", None, 7)])


def test_each_line_is_parsed_once(spark, tmp_path):
    """No filter repeats the parser, and none of its cells does; a file without the key's header still fails."""
    (tmp_path / "a").mkdir()
    for name, head in (("x", "ticker,size,sip_timestamp,price"), ("y", "price,ticker,venue,sip_timestamp,size")):
        values = {"ticker": "O:SPX240216C00100000", "size": "3", "sip_timestamp": "1704205800000000000", "price": "1.5", "venue": '"a,b"'}
        with gzip.open(tmp_path / "a" / f"{name}.csv.gz", "wt") as f:
            f.write(head + "\n" + (",".join(values[c] for c in head.split(",")) + "\n") * 5)
    got = readers.read_option_trades_csv(spark, str(tmp_path / "a"), mixed=True)
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    parsed = [line for line in plan if "from_csv" in line]
    assert parsed and all("Generate" in line for line in parsed)
    assert {(r.underlying, r.size, r.price) for r in got.collect()} == {("SPX", 3, 1.5)} and got.count() == 10
    (tmp_path / "a" / "z.csv").write_text("name,sip_timestamp\nO:SPX240216C00100000,1704205800000000000\n")
    with pytest.raises(Exception, match="no column"):
        readers.read_option_trades_csv(spark, str(tmp_path / "a"), mixed=True).collect()
