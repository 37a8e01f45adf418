"""SimHash near-dedup by BK-trees.

Distinct 64-bit fingerprints are dealt into shards so that any two within the radius meet in at least one: a fingerprint
is cut into ``radius + 1`` blocks, two fingerprints within the radius agree on at least one of them, and the low bits of
each block are a shard key. As many bits are taken as leave a shard ``TREE_NODES`` fingerprints, however many there are in
all, so the work for one fingerprint stays the same as the table grows. Each shard has a BK-tree (children keyed by their
Hamming distance to the parent); the trees are broadcast while all of them together keep within ``BROADCAST_BYTES``, and
beyond go to those that ask them by the shuffle. A query follows only the edges whose distance differs from its own by the
radius at most. A shard with more than ``SHARD_NODES`` fingerprints is cut into trees of that size at most, and each of
these is asked by all of the shard's fingerprints. Links are joined inside a tree, so it gives at most one edge for each
fingerprint that asks; the edges go through connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, tasks_for
from .components import connected_components

#: Most nodes that a tree has on average, and most of all.
TREE_NODES = 1 << 12
SHARD_NODES = 1 << 15
#: Trees that are broadcast, 13 bytes a node.
BROADCAST_BYTES = 64 << 20
#: Queries that walk a tree together.
QUERIES = 512


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text: a bit is set if it is set in over half of the shingles' XXH64 (seed 42); no words: 0."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, and only ASCII blanks split
    return majority(shingle_hashes(words, shingle))


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of all shingles, repeats included; fewer words are one shingle, no words none."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = (np.fromiter(map(len, words), np.int64, len(words)) + 1).cumsum()
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), (ends[min(shingle, len(words)) - 1 :] - 1).tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of every row; fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


class BKTree:
    """Over distinct unsigned 64-bit values; the first one is the root, the others hang in order of insertion."""

    def __init__(self, values: np.ndarray, links: tuple[np.ndarray, np.ndarray] | None = None):
        self.values = values
        self.parent, self.distance = links or self._hang(values)
        self.child = np.full((len(values), 65), -1, np.int32)
        self.child[self.parent[1:], self.distance[1:]] = np.arange(1, len(values))

    @staticmethod
    def _hang(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parent of each node and the distance to it, all nodes of one level at a time."""
        parent, distance = np.zeros(len(values), np.int32), np.zeros(len(values), np.uint8)
        nodes, under = np.arange(1, len(values)), np.zeros(max(0, len(values) - 1), np.int64)
        while len(nodes):
            d = np.bitwise_count(values[nodes] ^ values[under])
            by = np.lexsort((nodes, d, under))
            nodes, under, d = nodes[by], under[by], d[by]
            new = np.concatenate([[True], (under[1:] != under[:-1]) | (d[1:] != d[:-1])])
            heads = nodes[new]  # the first one on an edge is the child, the others go below it
            parent[heads], distance[heads] = under[new], d[new]
            nodes, under = nodes[~new], heads[new.cumsum()[~new] - 1]
        return parent, distance

    def to_bytes(self) -> bytes:
        return self.values.astype("<u8").tobytes() + self.parent.astype("<i4").tobytes() + self.distance.tobytes()

    @staticmethod
    def values_of(data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u8", len(data) // 13)

    @classmethod
    def from_bytes(cls, data: bytes) -> BKTree:
        n = len(data) // 13
        return cls(cls.values_of(data), (np.frombuffer(data, "<i4", n, 8 * n), np.frombuffer(data, np.uint8, n, 12 * n)))

    def search(self, queries: np.ndarray, radius: int, visited: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query positions, nodes) of all pairs within the radius; ``visited`` gets every (query positions, nodes) that is looked at."""
        asked, nodes = np.arange(len(queries)), np.zeros(len(queries), np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(asked):
            if visited is not None:
                visited.append((asked, nodes))
            distance = np.bitwise_count(queries[asked] ^ self.values[nodes]).astype(np.int64)
            near = distance <= radius
            found.append((asked[near], nodes[near]))
            nexts = [], []
            for d in range(-radius, radius + 1):
                edge = distance + d
                inside = (edge > 0) & (edge <= 64)
                to = self.child[nodes[inside], edge[inside]]
                nexts[0].append(asked[inside][to >= 0])
                nexts[1].append(to[to >= 0])
            asked, nodes = np.concatenate(nexts[0]), np.concatenate(nexts[1])
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the labels of a[i] and b[i]; ``label`` maps every node to the least node of its set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        low = np.minimum(x, y)
        np.minimum.at(label, np.maximum(x, y), low)
        while (deeper := label[label]).tobytes() != label.tobytes():
            label[:] = deeper


def _tree_edges(tree: BKTree, queries: np.ndarray, radius: int, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges (u, v) that link what one tree and its queries link; one for each fingerprint at most. ``own``: the queries are the tree's nodes."""
    label = np.arange(len(tree.values))
    for at in range(0, len(queries), QUERIES):
        some = queries[at : at + QUERIES]
        asked, nodes = tree.search(some, radius)
        by = np.argsort(asked, kind="stable")
        asked, nodes = asked[by], nodes[by]
        first = np.searchsorted(asked, np.arange(len(some)))
        has = first < len(asked)
        has[has] = asked[first[has]] == np.flatnonzero(has)
        _union(label, nodes, nodes[first[asked]])
        if not own:
            yield some[has], tree.values[nodes[first[has]]]
    other = label != np.arange(len(label))
    yield tree.values[other], tree.values[label[other]]


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, sub, fp) sorted: one row with its tree for each key and sub."""

    def planted(values):
        row = {"key": [now[0]], "sub": [now[1]], "tree": [BKTree(np.concatenate(values)).to_bytes()]}
        return pa.RecordBatch.from_pydict(row, schema=pa.schema([("key", pa.int64()), ("sub", pa.int32()), ("tree", pa.binary())]))

    now, held = None, []
    for batch in batches:
        key, sub = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (sub[1:] != sub[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(fp)], strict=True):
            if a == b:
                continue
            if now != (key[a], sub[a]):
                if held:
                    yield planted(held)
                now, held = (key[a], sub[a]), []
            held.append(fp[a:b])
    if held:
        yield planted(held)


def _ask(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (own, tree, queries): the edges that each tree gives to the nodes of another or of its own."""
    for batch in batches:
        for own, tree, queries in zip(*batch.columns, strict=True):
            for u, v in _tree_edges(BKTree.from_bytes(tree.as_py()), BKTree.values_of(queries.as_py()), radius, own.as_py()):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])


def shard_keys(fp: Column, radius: int, bits: int) -> Column:
    """One key for each of the radius + 1 blocks, from its ``bits`` lowest bits: two fingerprints within the radius share at least one."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    keys = []
    for i in range(n if bits else 1):
        low = min(bits, edges[i + 1] - edges[i], 48)
        keys.append(F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << low) - 1).cast("long")) + F.lit(i << 56).cast("long"))
    return F.array(*keys)


def plant_trees(distinct: DataFrame, radius: int, tree_nodes: int = TREE_NODES, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(key, sub, tree): the trees over the distinct fingerprints ``fp``."""
    spark = distinct.sparkSession
    n = distinct.count()
    bits = max(0, (-(-n // tree_nodes) - 1).bit_length())
    keyed = distinct.select("fp", F.explode(shard_keys(F.col("fp"), radius, bits)).alias("key"))
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > shard_nodes)
    large = large.select("key", F.ceil(F.col("n") / F.lit(shard_nodes * 0.8)).cast("int").alias("subs"))
    dealt = keyed.join(large, "key", "left").select("key", F.pmod(F.xxhash64("fp", F.lit(7)), F.coalesce("subs", F.lit(1))).cast("int").alias("sub"), "fp")
    return dealt.repartition(tasks_for(spark, 160 * n), "key", "sub").sortWithinPartitions("key", "sub", "fp").mapInArrow(_plant, "key long, sub int, tree binary")


def links(distinct: DataFrame, radius: int = 2, shard_nodes: int = SHARD_NODES, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints ``fp`` whose components are those of all pairs within the radius."""
    trees = cut(plant_trees(distinct, radius, tree_nodes, shard_nodes))
    size = trees.agg(F.sum(F.octet_length("tree").cast("long"))).first()[0] or 0
    asking = trees.select("key", F.col("sub").alias("asks"), F.col("tree").alias("queries"))
    pairs = asking.join(F.broadcast(trees) if size <= BROADCAST_BYTES else trees, "key").filter("sub <= asks")
    return pairs.select((F.col("sub") == F.col("asks")).alias("own"), "tree", "queries").mapInArrow(lambda batches: _ask(batches, radius), "u long, v long")


def simhash_components(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", shard_nodes: int = SHARD_NODES, tree_nodes: int = TREE_NODES) -> DataFrame:
    """(id, fp, component) of every row of ``docs``: component is the smallest id reachable over links within the radius.

    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id take part, but are
    never the smallest; a component of such rows alone is null. Repeated rows each get a row; an empty table gives none.
    """
    marked = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(marked.groupBy("fp").agg(F.min("id").alias("least")))
    found = connected_components(links(distinct.select("fp"), radius, shard_nodes, tree_nodes))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root").select("fp", "component")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def dedup_simhash(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component; columns unchanged.

    Rows that share an id are one document and stay or go together. Rows with a null id stay only in components without
    any id.
    """
    return one_of_each(docs, simhash_components(docs, radius, shingle, id_col, text_col), id_col)


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is that of its component in ``found`` (id, component)."""
    stay = found.filter((F.col(id_col) == F.col("component")) | F.col("component").isNull()).select(F.col(id_col).alias("__stays")).distinct()
    return docs.join(stay, docs[id_col].eqNullSafe(stay["__stays"]), "left_semi")
