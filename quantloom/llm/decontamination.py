"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every window of the training text.

Windows are compared by a 64-bit hash first; every hit is verified word by word against the benchmark window before it
counts, and verified hits remove spans or whole documents. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, stored, words

#: Separators: every ASCII character but digits and lower-case letters (texts are lower-cased first).
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Test n-grams that are broadcast at a time; a larger set is probed slice by slice, a scan each.
BROADCAST_WINDOWS = 1_000_000
#: Hits that are broadcast to the documents they belong to; more go by the shuffle.
BROADCAST_HITS = 200_000
#: Bytes of either, words of any length included.
BROADCAST_BYTES = 1 << 27


def normal_words(text: Column) -> Column:
    return words(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR)


def window_hash(w: Column, i: Column, n: int) -> Column:
    return F.xxhash64(*[F.element_at(w, i + k) for k in range(n)])


def all_windows(n: int):
    """Hashes of all windows of an array of words; null if it has fewer words."""
    return lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: window_hash(w, i, n)))


def benchmark_windows(items: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(n, h, window, items): every distinct window of the items with the ids of the items that hold it.

    A window is n consecutive words; an item of fewer words, but not none, is one window. Null texts have no words.
    """
    split = items.select(F.col(id_col).alias("item"), normal_words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.lit(n), F.size("w"))
    cut = split.select("item", size.alias("n"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size))).alias("window"))
    return cut.groupBy("n", "window").agg(F.collect_set("item").alias("items"))


def window_bytes(window: Column, items: Column) -> Column:
    """What a window and its items take in a broadcast, about."""
    return F.octet_length(F.array_join(window, " ")).cast("long") + 16 * F.size(window) + 8 * F.size(items) + 64


def contaminated_words(docs: DataFrame, items: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", whole_rows: bool = False) -> DataFrame:
    """Every row of ``docs`` as (__doc, __id, __text, words, hits): the row itself, its id and text, its normalised words,
    and (p, n, items) of each benchmark window in it.

    Null texts have no words, an empty text none either, and neither is hit. Repeated rows and rows that share an id are
    judged one by one. With no benchmark windows no document is hit. Other columns stay inside ``__doc``, so they
    can't clash.
    """
    bench = stored(benchmark_windows(items, n, item_id, item_text), "benchmark")
    by_length = bench.groupBy("n").agg(F.count("*").alias("windows"), F.sum(window_bytes(F.col("window"), F.col("items"))).alias("bytes")).collect()  # n rows at most
    lengths, total, size = sorted(r.n for r in by_length), sum(r.windows for r in by_length), sum(r.bytes for r in by_length)
    # a row is known by id and text: equal rows have equal hits
    columns = [F.col(f"`{c}`") for c in docs.columns] if whole_rows else [F.col(id_col)]
    rows = docs.select(F.struct(*columns).alias("__doc"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).withColumn("__key", F.xxhash64("__text", "__id"))
    if not lengths:
        return rows.select("__doc", "__id", "__text", normal_words(F.col("__text")).alias("words"), F.array().cast("array<struct<p:int,n:int,items:array<bigint>>>").alias("hits"))
    # hashes of all windows of all lengths in one scan
    hashes = let(normal_words(F.col("__text")), lambda w: F.array(*[F.struct(F.lit(k).alias("n"), all_windows(k)(w).alias("h")) for k in lengths]))
    scan = rows.select("__key", F.inline(hashes)).select("__key", "n", F.posexplode("h").alias("p", "h"))
    pick = F.lit(None)
    for k in lengths:
        pick = F.coalesce(pick, F.when(F.col("n") == k, window_hash(F.col("window"), F.lit(1), k)))
    test = bench.select("n", pick.alias("h"), "window", "items")
    slices = max(-(-total // BROADCAST_WINDOWS), -(-size // BROADCAST_BYTES))
    found = None
    for k in range(slices):
        some = scan.join(F.broadcast(test.filter(F.pmod("h", F.lit(slices)) == k)), ["n", "h"]).select("__key", (F.col("p") + 1).alias("p"), "n", "window", "items")
        found = some if found is None else found.unionByName(some)
    # one row for each row that was hit; at most a row's own windows times the (few) windows of one hash
    found = stored(found.groupBy("__key").agg(F.collect_set(F.struct("p", "n", "window", "items")).alias("__hits")), "hits")
    sizes = F.aggregate("__hits", F.lit(0).cast("long"), lambda a, x: a + window_bytes(x["window"], x["items"]))
    n_hits, size = found.agg(F.coalesce(F.sum(F.size("__hits")), F.lit(0)), F.coalesce(F.sum(sizes), F.lit(0))).first()
    found = F.broadcast(found) if n_hits <= BROADCAST_HITS and size <= BROADCAST_BYTES else found
    joined = rows.join(found, "__key", "left").withColumn("words", normal_words(F.col("__text")))
    verified = let(
        F.struct(F.col("words").alias("w"), F.coalesce("__hits", F.array()).alias("h")),
        lambda x: F.transform(
            F.filter(x["h"], lambda h: F.slice(x["w"], h["p"], h["n"]) == h["window"]),
            lambda h: F.struct(h["p"].alias("p"), h["n"].alias("n"), h["items"].alias("items")),
        ),
    )
    return joined.select("__doc", "__id", "__text", "words", verified.alias("hits"))


def covered(hits: Column) -> Column:
    """Number of words inside any hit."""
    ends = F.sort_array(F.transform(hits, lambda h: F.struct(h["p"].alias("p"), (h["p"] + h["n"]).alias("e"))))
    return F.aggregate(
        ends,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, h: F.struct(
            (a["n"] + F.greatest(F.lit(0), h["e"] - F.greatest(a["to"], h["p"]))).alias("n"), F.greatest(a["to"], h["e"]).alias("to")
        ),
        lambda a: a["n"].cast("long"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, most_hit_share: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose share of hit words is at most ``most_hit_share``; columns unchanged.

    Null and empty texts have no words and stay. Repeated rows stay or go together; an empty table gives no rows, and an
    empty benchmark leaves all.
    """
    spans = contaminated_words(docs, items, n, id_col, text_col, whole_rows=True)
    return spans.filter(covered(F.col("hits")) <= F.lit(most_hit_share) * F.size("words")).select("__doc.*").select(*[f"`{c}`" for c in docs.columns])


def remove_spans(docs: DataFrame, items: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every hit word cut out: the words left, normalised, joined by one space.

    A text without a hit, null and empty ones too, stays as it is. Repeated rows stay repeated; an empty table gives none.
    """
    spans = contaminated_words(docs, items, n, id_col, text_col)
    inside = lambda i: F.exists(F.col("hits"), lambda h: (i + 1 >= h["p"]) & (i + 1 < h["p"] + h["n"]))
    left = F.when(F.size("hits") == 0, F.col("words")).otherwise(F.filter("words", lambda w, i: ~inside(i)))
    return spans.select(F.col("__id").alias(id_col), F.when(F.size("hits") == 0, F.col("__text")).otherwise(F.array_join(left, " ")).alias(text_col))
