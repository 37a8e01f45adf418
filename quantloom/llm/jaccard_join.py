"""Similarity join on sets of word n-grams by rare-first prefix filtering.

A text's set is that of its distinct ``SHINGLE``-word shingles, A-Z lower-cased, as 62-bit hashes; a shorter text is one
shingle, one without words has an empty set and no link. Two sets link when 100 |A and B| >= 80 |A or B|. Texts with equal
sets are one class (by a 64-bit hash of the set).

Order: every set is sorted rare first, by how often a shingle is estimated to occur (a count-min sketch over all texts with
the levels ``LEVELS``) and then by its hash. Any such order gives right results; the sketch has a size bound, and where it
fills up the order gets poorer, nothing else. Prefix: similar sets share a shingle among the first |A| - ceil(0.8 |A|) + 1,
and the smaller one has it among its first |A| - ceil(8/9 |A|) + 1. Prefix shingles that occur once join nothing and are
left out, by the sketch and then exactly. Length: the smaller set has 0.8 of the larger one's size at least. Position: what
can still be common behind a common shingle, and before it, must be enough. Suffix: a shingle in the middle of one set splits
both, and sizes of the parts bound what they share. A pair that passes is verified once, on whole sets.

``jaccard_links`` gives every link. ``jaccard_components`` needs only what connects, so a group of n near copies doesn't take
n^2 pairs: in each list of sets with a common prefix shingle, all are first verified against one hub (the set with the fewest
rarer shingles, mostly the one that the others were made from), then what is still apart against a second one, then every
pair of the list that lies in different components. A list's hubs and members come from joins and partial aggregates on the
shingle, so a shingle that a third of all sets share is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sketch
from .common import cut, stored, tasks_for
from .components import connected_components
from .substring_dedup import hash_words, window_hashes

SHINGLE = 5
#: Similarity in percent.
SIMILAR = 80
#: Estimated occurrences from which a shingle counts as more frequent: it is in two texts at least, in several, in many.
LEVELS = (2, 8, 64)
#: Most cells in a row of the sketch: 64 MB for each level.
MAX_WIDTH = 1 << 28
FACTOR = 0x9FB21C651E98DF25
#: How deep the suffix filter splits.
DEPTH = 3


def shingles(text: bytes | None, n: int = SHINGLE) -> np.ndarray:
    """Distinct 62-bit hashes of the shingles of a text, sorted."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, and only the six ASCII blanks split
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(hash_words(words), min(n, len(words)), FACTOR) >> np.uint64(2))


def class_of(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.astype("<u8").tobytes())


def _share(n: int, percent: int) -> int:
    """The least whole number that is at least ``percent`` of n."""
    return -(-n * percent // 100)


def least_common(a: int, b: int) -> int:
    """How many shingles sets of these sizes must share to be linked."""
    return -(-SIMILAR * (a + b) // (100 + SIMILAR))


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = DEPTH) -> int:
    """No more values than this are in both sorted arrays."""
    if not len(a) or not len(b) or depth == 0:
        return min(len(a), len(b))
    mid = len(a) // 2
    at = int(np.searchsorted(b, a[mid]))
    there = at < len(b) and b[at] == a[mid]
    return suffix_bound(a[:mid], b[:at], depth - 1) + int(there) + suffix_bound(a[mid + 1 :], b[at + there :], depth - 1)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    need = least_common(len(a), len(b))
    if not len(a) or not len(b) or min(len(a), len(b)) < need or suffix_bound(a, b) < need:
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) >= need


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for at in range(0, batch.num_rows, 256):
        yield from batch.slice(at, 256).column(column).cast(pa.binary()).to_pylist()


def _marks(docs: DataFrame) -> DataFrame:
    """(id, k, cls, n, toks, poss) of every row: k tells texts of one id apart; toks: prefix shingles that may be in other texts too, rare first."""
    width = int(min(MAX_WIDTH, sketch.width_for(sketch.text_bytes(docs, "text") / 6)))

    def hashes(batches):
        for batch in batches:
            held, size = [], 0
            for text in _texts(batch, 0):
                held.append(shingles(text))
                size += len(held[-1])
                if size > 1 << 16:
                    yield np.concatenate(held)
                    held, size = [], 0
            if size:
                yield np.concatenate(held)

    levels = sketch.merged_sketch(docs.select("text"), hashes, width, LEVELS)
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # bounded by MAX_WIDTH

    def marked(ids, ks, texts):
        sets = [shingles(t) for t in texts]
        sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        often = np.zeros(len(every), np.uint64)
        rest = np.arange(len(every))
        for bits in sent.value:  # a shingle that misses a level misses those above it
            rest = rest[sketch.reached(bits, every[rest], width)]
            often[rest] += np.uint64(1)
        ordered, at = every | (often << np.uint64(62)), 0
        out: list[list] = [[], [], [], []]
        for s, n in zip(sets, sizes.tolist(), strict=True):
            own = np.sort(ordered[at : at + n])[: n - _share(n, SIMILAR) + 1 if n else 0]
            at += n
            some = np.flatnonzero(own >> np.uint64(62))
            for column, value in zip(out, (class_of(s), n, own[some].view(np.int64), some), strict=True):
                column.append(value)
        cls, n, toks, poss = out
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in toks])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*c, np.zeros(0, np.int64)]).astype(t))) for c, t in ((toks, np.int64), (poss, np.int32))]
        return pa.RecordBatch.from_arrays([ids, ks, pa.array(np.array(cls, np.uint64).view(np.int64)), pa.array(n, pa.int64()), *lists], names=["id", "k", "cls", "n", "toks", "poss"])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                yield marked(some.column(0), some.column(1), some.column(2).cast(pa.binary()).to_pylist())

    return stored(docs.mapInArrow(run, "id long, k long, cls long, n long, toks array<long>, poss array<int>"), "marks")


def _lists(marks: DataFrame) -> DataFrame:
    """(tok, cls, n, pos, rank, prev) of prefix shingles that several classes have; hub: the member with the fewest rarer shingles.

    rank: how many of the ``pos`` shingles before it are in other texts' prefixes too; prev: the last of these.
    """
    rows = marks.select("cls", "n", F.posexplode(F.arrays_zip("toks", "poss")).alias("rank", "e")).select(F.col("e.toks").alias("tok"), "cls", "n", F.col("e.poss").alias("pos"), "rank")
    rows = stored(rows.distinct(), "prefixes")  # copies are one class
    of = rows.groupBy("tok").agg(F.count("*").alias("m"), F.min(F.struct("pos", "n", "cls", "rank")).alias("hub")).filter("m > 1").select("tok", "hub")
    own = Window.partitionBy("cls").orderBy("pos")
    ranked = rows.join(of, "tok").withColumns({"rank": F.row_number().over(own) - 1, "prev": F.lag("tok").over(own)})
    return stored(ranked, "lists")


def _passes(x: dict[str, Column], y: dict[str, Column], first: bool) -> Column:
    """Length, prefix and position of a common shingle of two sets; ``first``: linked sets have no common one before it.

    Else what is common before it is bounded by both ranks.
    """
    swap = (x["n"] > y["n"]) | ((x["n"] == y["n"]) & (x["pos"] > y["pos"]))
    small = {c: F.when(swap, y[c]).otherwise(x[c]) for c in ("n", "pos")}
    large = {c: F.when(swap, x[c]).otherwise(y[c]) for c in ("n", "pos")}
    up = lambda n, num, den: F.floor((n * num + (den - 1)) / den)
    need = up(x["n"] + y["n"], SIMILAR, 100 + SIMILAR)
    before = F.lit(0) if first else F.least(x["rank"], y["rank"])
    return (
        (small["n"] * 100 >= large["n"] * SIMILAR)
        & (small["pos"] <= small["n"] - up(small["n"], 2 * SIMILAR, 100 + SIMILAR))
        & (before + 1 + F.least(x["n"] - x["pos"] - 1, y["n"] - y["pos"] - 1) >= need)
    )


def _sets(docs: DataFrame, marks: DataFrame, lists: DataFrame) -> DataFrame:
    """(cls, grams) of the classes in ``lists``, each from one text."""
    one = marks.join(lists.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("id", "k")).alias("one")).select("cls", "one.id", "one.k")
    texts = docs.dropDuplicates(["id", "k"])  # on the key of the join: no shuffle more
    found = texts.join(one, texts["id"].eqNullSafe(one["id"]) & (texts["k"] == one["k"])).select("cls", "text")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                grams = [shingles(t).astype("<u8").tobytes() for t in some.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(grams, pa.binary())], names=["cls", "grams"])

    return stored(found.mapInArrow(run, "cls long, grams binary"), "sets")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, grams) sorted by a and b, with b null for a's own set: the linked pairs."""
    own = None
    for batch in batches:
        keep = []
        a, b = (batch.column(c).to_pylist() for c in range(2))
        for k, grams in enumerate(batch.column(2)):
            values = np.frombuffer(grams.as_buffer(), "<u8")
            if b[k] is None:
                own = (a[k], values.copy())
            elif own[0] == a[k] and linked(own[1], values):
                keep.append(k)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are linked. The b of one a are dealt over tasks; each task gets a's set once."""
    salt = F.pmod(F.xxhash64("b", F.lit(5)), F.lit(16)).cast("int").alias("salt")
    left = pairs.select("a", salt).distinct().join(sets.withColumnRenamed("cls", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "grams")
    right = pairs.join(sets.withColumnRenamed("cls", "b"), "b").select("a", salt, "b", "grams")
    rows = left.unionByName(right).repartition(tasks_for(pairs.sparkSession, 0), "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.select("a", "b", "grams").mapInArrow(_verified, "a long, b long")


def _of(prefix: str) -> dict[str, Column]:
    return {c: F.col(f"{prefix}.{c}") for c in ("pos", "n", "rank")}


def _ordered_pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _candidates(some: DataFrame, lists: DataFrame, apart: Column | None = None) -> DataFrame:
    """Pairs (a, b) of a set of ``some`` and one of ``lists`` that pass all filters at their first common prefix shingle, each once."""
    x, y = some.alias("x"), lists.alias("y")
    # sets that have the same shingle before this one have met there already; their first common one is never left out
    which = ~F.coalesce(F.col("x.prev") == F.col("y.prev"), F.lit(False)) & ((F.col("x.cls") != F.col("y.cls")) if apart is None else apart)
    ordered = F.col("x.cls") < F.col("y.cls")
    ends = [F.when(ordered, F.col(f"{p}.{c}")).otherwise(F.col(f"{q}.{c}")).alias(f"{c}_{k}") for k, p, q in (("a", "x", "y"), ("b", "y", "x")) for c in ("cls", "n", "pos")]
    # a pair that fails at one common shingle is not linked, so what is found at the others of it does no harm
    met = x.join(y, (F.col("x.tok") == F.col("y.tok")) & which & _passes(_of("x"), _of("y"), False)).select(*ends)
    firsts = met.groupBy(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).agg(F.first("n_a").alias("na"), F.first("n_b").alias("nb"), F.min(F.struct("pos_a", "pos_b")).alias("at"))
    one, other = ({"n": F.col(f"n{k}"), "pos": F.col(f"at.pos_{k}")} for k in "ab")
    return firsts.filter(_passes(one, other, True)).select("a", "b")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): the class and set size of every row, (id, cls, n), and every linked pair (a, b) of different classes, a < b.

    Equal sets are linked by being one class. Rows without words have a class of size 0 without links.
    """
    source, marks, lists, sets = _prepared(docs, id_col, text_col)
    some = lists.select("tok", "cls", "n", "pos", "rank", "prev")
    pairs = _candidates(some, some, F.col("x.cls") < F.col("y.cls"))
    return marks.select(F.col("id").alias(id_col), "cls", "n"), _links(cut(pairs), sets)


def _prepared(docs: DataFrame, id_col: str, text_col: str):
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("text"))
    marks = _marks(source)
    lists = _lists(marks)
    return source, marks, lists, _sets(source, marks, lists)


def _spanning_links(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all links."""
    member, hub = {c: F.col(c) for c in ("pos", "n", "rank")}, _of("hub")
    stars = lists.filter((F.col("cls") != F.col("hub.cls")) & _passes(member, hub, False)).select(*_ordered_pairs(F.col("cls"), F.col("hub.cls")), "cls", "hub.cls")
    # of a set's hubs the one that it shares most prefix shingles with
    votes = stars.toDF("a", "b", "cls", "hub").groupBy("a", "b", "cls", "hub").count()
    done = cut(votes.groupBy("cls").agg(F.max_by(F.struct("a", "b"), F.struct("count", "hub")).alias("p")).select("p.a", "p.b").distinct())
    links = cut(_links(done, sets))
    for last in (False, True):
        found = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        rooted = lists.select("tok", "cls", "n", "pos", "rank", "prev").join(found, F.col("cls") == F.col("node"), "left").select("tok", "cls", "n", "pos", "rank", "prev", F.coalesce("root", "cls").alias("comp"))
        by = rooted.groupBy("tok", "comp").agg(F.count("*").alias("c"), F.min(F.struct(F.xxhash64("cls"), "pos", "n", "cls", "rank")).alias("some"))
        # of each list that is still apart the component with most members, and a member of it
        apart = by.groupBy("tok").agg(F.count("*").alias("comps"), F.max_by(F.struct("comp", "some"), F.struct("c", "comp")).alias("main")).filter("comps > 1")
        open_lists = cut(rooted.join(apart.select("tok", F.col("main.comp").alias("main"), F.col("main.some").alias("hub")), "tok"))
        others = open_lists.filter("comp <> main")
        if last:  # every pair that is apart has one set outside the main component; of two such sets each pair once
            differ = (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.cls") < F.col("y.cls")))
            pairs = _candidates(others, open_lists, differ)
        else:
            pairs = others.filter(_passes(member, hub, False)).select(*_ordered_pairs(F.col("cls"), F.col("hub.cls"))).distinct()
        new = cut(pairs.join(done, ["a", "b"], "left_anti"))
        done = done.unionByName(new)
        links = links.unionByName(cut(_links(new, sets)))
    return links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component) of every row of ``docs``: the size of its set and the smallest id that links reach from it.

    Rows without words are linked with nothing, not even with one another: their component is their own id. Rows with a null
    id take part, but are never the smallest; a component of such rows alone is null. Repeated rows each get a row; an empty
    table gives none. Other columns aren't read.
    """
    source, marks, lists, sets = _prepared(docs, id_col, text_col)
    found = connected_components(_spanning_links(lists, sets).select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = marks.filter("n > 0").groupBy("cls").agg(F.min("id").alias("least"))
    rooted = least.join(found, least["cls"] == found["node"], "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root").select("cls", "component")
    words = marks.filter("n > 0").select("id", "n", "cls").join(named, "cls").select("id", "n", "component")
    return words.unionByName(marks.filter("n = 0").select("id", "n", F.col("id").alias("component"))).withColumnRenamed("id", id_col)
