"""Hard-negative mining over Parquet blocks in the order of a Hilbert curve, with zone maps.

Vectors become integers, are ordered along a Hilbert curve through all dimensions and written as blocks of ``BLOCK`` rows;
beside each block stand the least and the greatest value of every dimension and the labels it has. Anchors are ordered
the same way and go in chunks of ``CHUNK``. For an anchor a and a block, interval arithmetic bounds all scores at once: no
row scores more than ``sum(max(a*lo, a*hi))`` or less than ``sum(min(a*lo, a*hi))``. A search reads, for each anchor, the
``FIRST`` blocks with the greatest upper bounds of every group of zone maps; what it finds there sets a floor, and only
blocks whose bounds reach the floor and the anchor's windows are read then. So nothing is lost, however tight the bounds are:
on clustered vectors most blocks are left out, on uniform ones of many dimensions nearly none.

A chunk's blocks are dealt to tasks ``BLOCKS_PER_TASK`` at a time, each keeps the best rows only, and these are merged. Zone
maps are broadcast up to ``BROADCAST_BYTES``, beyond they meet the chunks by the shuffle, a group at a time.

Rows with a null label, a null vector or a null or non-finite component take no part. Shorter vectors are as if filled up
with zeros. An anchor's other rows are those of another id, a null id included, which is ordered last; a repeated row counts
each time as a candidate and once as an anchor. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, cut, stored, tasks_for

BLOCK, CHUNK = 512, 1024
#: Bits of a coordinate on the curve.
CURVE_BITS = 4
#: Zone maps that are looked at together.
GROUP = 2048
FIRST = 2
BLOCKS_PER_TASK = 64
BROADCAST_BYTES = 64 << 20
#: Lower than any score.
NONE = -(2**62)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates in [0, 2^bits), as big-endian bytes (Skilling, 2004)."""
    x = points.astype(np.int64).T.copy()  # one row per dimension
    if not len(x):
        return np.zeros((points.shape[0], 1), np.uint8)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in x:
            high = axis >> bit & 1 == 1
            swap = np.where(high, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(high, below, swap)
            axis ^= swap
    np.bitwise_xor.accumulate(x, axis=0, out=x)
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    planes = np.stack([x >> bit & 1 for bit in range(bits - 1, -1, -1)])  # bit, dimension, row
    return np.packbits(planes.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector, label) to (id, label, q, size, most) of rows that take part; q: floors of 256 x as 64-bit integers."""
    for batch in batches:
        out = []
        for i, v, label in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            if label is None or not v.is_valid or v.values.null_count:
                continue
            x = np.floor(256 * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(x).all():
                most = float(np.abs(x).max(initial=0))
                out.append((i, label, x.clip(-(2.0**62), 2.0**62).astype("<i8").tobytes(), len(x), most))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "label", "q", "size", "most"])


def _unpack(column, size: int) -> np.ndarray:
    out = np.zeros((len(column), size), np.int64)
    for row, data in zip(out, column, strict=True):
        q = np.frombuffer(data.as_buffer(), "<i8")
        row[: len(q)] = q
    return out


def _keyed(size: int, most: int) -> Callable:
    """Adds the place on the curve; coordinates are cut to CURVE_BITS of the range of all values."""

    def run(batches):
        for batch in batches:
            q = _unpack(batch.column("q"), size)
            points = ((q + most) << CURVE_BITS) // (2 * most + 1)
            key = [k.tobytes() for k in hilbert_keys(points, CURVE_BITS)]
            names = ["id", "label", "q"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(key, pa.binary())], names=[*names, "key"])

    return run


def _packed(size: int, kind: str, rows: int) -> Callable:
    """Rows in order to blocks of ``rows``: number, ids, labels, vectors, and the zone map."""

    def run(batches):
        place, held, n = TaskContext.get().partitionId() << 32, [], 0

        def block(table):
            nonlocal place
            ids = table.column("id").fill_null(LAST_ID).to_numpy()
            labels, q = table.column("label").to_numpy(), _unpack(table.column("q").combine_chunks(), size)
            by = np.argsort(ids, kind="stable")  # so that of equal scores the first one has the least id
            q, place = q[by].astype(kind), place + 1
            row = [place - 1, len(ids), ids[by].astype("<i8"), labels[by].astype("<i8"), q, q.min(axis=0), q.max(axis=0), np.unique(labels).astype("<i8")]
            names = ["block", "n", "ids", "labels", "q", "lo", "hi", "has"]
            return pa.RecordBatch.from_pydict({k: [v if isinstance(v, int) else v.tobytes()] for k, v in zip(names, row, strict=True)})

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, rows))
                held, n = table.slice(rows).to_batches(), n - rows
        if n:
            yield block(pa.Table.from_batches(held))

    return run


_BLOCKS = "block long, n long, ids binary, labels binary, q binary, lo binary, hi binary, has binary"


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps (g, block, lo, hi, has) sorted by g: one row for each g."""

    def packed(rows):
        has = [r["has"] for r in rows]
        sizes = np.array([len(h) // 8 for h in has], "<i4").tobytes()
        blocks = np.array([r["block"] for r in rows], "<i8").tobytes()
        return pa.RecordBatch.from_pydict({"g": [rows[0]["g"]], "blocks": [blocks], "lo": [b"".join(r["lo"] for r in rows)], "hi": [b"".join(r["hi"] for r in rows)], "has": [b"".join(has)], "sizes": [sizes]})

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["g"] != row["g"]:
                yield packed(held)
                held = []
            held.append(row)
    if held:
        yield packed(held)


#: A chunk of anchors: windows (low and high score of each), what was found in them so far, and the positives.
_CHUNK = "chunk long, ids binary, labels binary, q binary, low binary, high binary, scores binary, found binary, pscores binary, pfound binary"
_NAMES = [f.split()[0] for f in _CHUNK.split(", ")]


class _Chunk:
    def __init__(self, row: dict, size: int, kind: str, k: int):
        self.row, self.k = row, k
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        n = len(self.ids)
        self.q = np.frombuffer(row["q"], kind).reshape(n, size).astype(np.float64)
        self.low, self.high = (np.frombuffer(row[c], "<i8").reshape(n, -1) for c in ("low", "high"))
        shape = (*self.low.shape, k)
        self.scores = np.frombuffer(row["scores"], "<i8").reshape(shape) if row["scores"] else np.full(shape, NONE)
        self.found = np.frombuffer(row["found"], "<i8").reshape(shape) if row["found"] else np.full(shape, LAST_ID)

    def merge(self, who, scores: np.ndarray, found: np.ndarray) -> None:
        """Takes better rows for the anchors ``who``: by score, then by id."""
        scores, found = np.concatenate([self.scores[who], scores], axis=2), np.concatenate([self.found[who], found], axis=2)
        by = np.lexsort((found, -scores), axis=2)[:, :, : self.k]
        self.scores, self.found = self.scores.copy(), self.found.copy()
        self.scores[who], self.found[who] = np.take_along_axis(scores, by, 2), np.take_along_axis(found, by, 2)

    def read(self, who: np.ndarray, block: dict, size: int, kind: str, same: bool) -> None:
        """Scores a block for the anchors ``who``."""
        ids, labels = (np.frombuffer(block[c], "<i8") for c in ("ids", "labels"))
        q = np.frombuffer(block["bq"], kind).reshape(len(ids), size).astype(np.float64)
        scores = (self.q[who] @ q.T).astype(np.int64)  # exact: below 2^53
        fits = (self.labels[who, None] == labels) == same
        scores[~fits | (self.ids[who, None] == ids)] = NONE
        by = np.argsort(-scores, axis=1, kind="stable")
        scores, ids = np.take_along_axis(scores, by, 1), ids[by]
        # of each window the first k rows that aren't above it
        begin = np.stack([(scores > high[:, None]).sum(axis=1) for high in self.high[who].T], axis=1)
        at = begin[:, :, None] + np.arange(self.k)
        inside = at < scores.shape[1]
        at = np.where(inside, at, 0).reshape(len(who), -1)
        best, which = (np.take_along_axis(x, at, 1).reshape(inside.shape) for x in (scores, ids))
        inside &= best >= np.maximum(self.low[who], NONE + 1)[:, :, None]
        self.merge(who, np.where(inside, best, NONE), np.where(inside, which, LAST_ID))

    def batch(self) -> pa.RecordBatch:
        new = self.row | {"scores": self.scores.astype("<i8").tobytes(), "found": self.found.astype("<i8").tobytes()}
        return _chunk_batch(new)


def _chunk_batch(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[c]], pa.int64() if c == "chunk" else pa.binary()) for c in _NAMES], names=_NAMES)


def block_bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with a row between ``lo`` and ``hi``."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def _choose(size: int, kind: str, k: int, same: bool, again: bool) -> Callable:
    """Chunks with a group of zone maps to (chunk, block, who): the anchors, as bits, that must read the block in this round."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, size, kind, k)
                blocks = np.frombuffer(row["zblocks"], "<i8")
                lo, hi = (np.frombuffer(row[c], kind).reshape(len(blocks), size).astype(np.float64) for c in ("zlo", "zhi"))
                sizes = np.frombuffer(row["zsizes"], "<i4")
                of, labels = np.repeat(np.arange(len(blocks)), sizes), np.frombuffer(row["zhas"], "<i8")
                values, which = np.unique(chunk.labels, return_inverse=True)
                there = np.zeros((len(values), len(blocks)), bool)
                at = np.minimum(np.searchsorted(values, labels), len(values) - 1)
                known = values[at] == labels
                there[at[known], of[known]] = True
                has = there[which]
                if not same:
                    has = (sizes > 1) | ~has
                least, most = block_bounds(chunk.q, lo, hi)
                fits = has[:, None] & (chunk.low <= chunk.high)[:, :, None] & (most[:, None] >= chunk.low[:, :, None]) & (least[:, None] <= chunk.high[:, :, None])
                order = np.where(fits.any(axis=1), most, -np.inf)
                first = np.zeros(order.shape, bool)
                np.put_along_axis(first, np.argsort(-order, axis=1, kind="stable")[:, :FIRST], True, 1)
                if again:  # the blocks of the first round are done; the others must reach what it found
                    need = (fits & (most[:, None] >= chunk.scores[:, :, -1, None])).any(axis=1) & ~first
                else:
                    need = first & np.isfinite(order)
                some = np.flatnonzero(need.any(axis=0))
                who = [np.packbits(need[:, b]).tobytes() for b in some]
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(blocks[some]), pa.array(who, pa.binary())], names=["chunk", "block", "who"])

    return run


def _scored(size: int, kind: str, k: int, same: bool) -> Callable:
    """Rows (chunk, salt, kind, ...) sorted: a chunk, then the blocks it must read; gives the chunk with what it found."""

    def run(batches):
        chunk = None
        for batch in batches:
            for row in batch.to_pylist():
                if not row["kind"]:
                    if chunk:
                        yield chunk.batch()
                    chunk = _Chunk(row, size, kind, k)
                else:
                    who = np.flatnonzero(np.unpackbits(np.frombuffer(row["who"], np.uint8))[: len(chunk.ids)])
                    chunk.read(who, row, size, kind, same)
        if chunk:
            yield chunk.batch()

    return run


def _merged(size: int, kind: str, k: int) -> Callable:
    def run(batches):
        chunk = None
        for batch in batches:
            for row in batch.to_pylist():
                other = _Chunk(row, size, kind, k)
                if chunk and chunk.row["chunk"] == row["chunk"]:
                    chunk.merge(np.arange(len(chunk.ids)), other.scores, other.found)
                    continue
                if chunk:
                    yield chunk.batch()
                chunk = other
        if chunk:
            yield chunk.batch()

    return run


class _Store:
    """Blocks and zone maps of the candidates."""

    def __init__(self, keyed: DataFrame, size: int, kind: str):
        spark = keyed.sparkSession
        self.size, self.kind = size, kind
        ordered = keyed.repartitionByRange(tasks_for(spark, 0), "key", F.col("id").asc_nulls_last()).sortWithinPartitions("key", F.col("id").asc_nulls_last())
        self.blocks = stored(ordered.mapInArrow(_packed(size, kind, BLOCK), _BLOCKS), "blocks")
        n, width = self.blocks.agg(F.count("*"), F.sum(F.octet_length("lo") + F.octet_length("hi") + F.octet_length("has"))).first()
        self.groups, self.salts, self.small = max(1, -(-n // GROUP)), max(1, -(-n // BLOCKS_PER_TASK)), (width or 0) <= BROADCAST_BYTES
        zones = self.blocks.select(F.pmod(F.xxhash64("block"), F.lit(self.groups)).alias("g"), "block", "lo", "hi", "has")
        zones = zones.repartition(min(self.groups, tasks_for(spark, width or 0)), "g").sortWithinPartitions("g", "block")
        self.zones = cut(zones.mapInArrow(_grouped, "g long, zblocks binary, zlo binary, zhi binary, zhas binary, zsizes binary"))

    def search(self, chunks: DataFrame, k: int, same: bool) -> DataFrame:
        """The chunks with the best ``k`` rows of every window, in two rounds."""
        spark = chunks.sparkSession
        for again in (False, True):
            ask = chunks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1)).cast("array<long>")))
            met = ask.join(F.broadcast(self.zones) if self.small else self.zones, "g")
            pairs = met.mapInArrow(_choose(self.size, self.kind, k, same, again), "chunk long, block long, who binary")
            salt = F.pmod(F.xxhash64("block", F.lit(11)), F.lit(self.salts)).alias("salt")
            nothing = [F.lit(None).cast("binary").alias(c) for c in _NAMES if c not in ("chunk", "ids", "labels")]
            reads = pairs.join(self.blocks.select("block", "ids", "labels", F.col("q").alias("bq")), "block")
            reads = reads.select("chunk", salt, F.lit(1).alias("kind"), "who", "bq", "ids", "labels", *nothing)
            heads = chunks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1)).cast("array<long>")))
            once = {c: F.when(F.col("salt") == 0, F.col(c)).otherwise(F.lit(b"")) for c in ("scores", "found")}  # else a merge would count it twice
            heads = heads.withColumns({"kind": F.lit(0), "who": F.lit(None).cast("binary"), "bq": F.lit(None).cast("binary"), **once})
            rows = reads.unionByName(heads).repartition(tasks_for(spark, 0), "chunk", "salt").sortWithinPartitions("chunk", "salt", "kind")
            parts = rows.mapInArrow(_scored(self.size, self.kind, k, same), _CHUNK)
            whole = parts.repartition(tasks_for(spark, 0), "chunk").sortWithinPartitions("chunk")
            chunks = cut(whole.mapInArrow(_merged(self.size, self.kind, k), _CHUNK))
        return chunks


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors to chunks with one window that takes every score."""
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["ids"]) // 8
            chunk = {"chunk": row["block"], "low": np.full(n, NONE, "<i8").tobytes(), "high": np.full(n, -NONE, "<i8").tobytes(), "scores": b"", "found": b"", "pscores": b"", "pfound": b""}
            yield _chunk_batch(row | chunk)


def _windowed(size: int, kind: str, k: int, least: int, most: int) -> Callable:
    """The rows found become the positives, each with a window of percents of its score."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, size, kind, k)
                scores = chunk.scores[:, 0]
                there = scores > NONE
                low, high = np.where(there, -(-least * np.where(there, scores, 0) // 100), 1), np.where(there, most * np.where(there, scores, 0) // 100, 0)
                yield _chunk_batch(row | {"low": low.astype("<i8").tobytes(), "high": high.astype("<i8").tobytes(), "scores": b"", "found": b"", "pscores": row["scores"], "pfound": row["found"]})

    return run


def _listed(size: int, kind: str, k: int) -> Callable:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, size, kind, k)
                pscores, pfound = (np.frombuffer(row[c], "<i8").reshape(chunk.low.shape) for c in ("pscores", "pfound"))
                a, p, r = np.nonzero(chunk.scores > NONE)
                named = lambda ids: pa.array(ids, mask=ids == LAST_ID)
                columns = [pa.array(chunk.ids[a]), named(pfound[a, p]), pa.array((r + 1).astype(np.int32)), named(chunk.found[a, p, r]), pa.array(pscores[a, p]), pa.array(chunk.scores[a, p, r])]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row whose id is divisible by
    ``every`` and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other labels whose
    score is ``least`` to ``most`` percent of the positive's. Scores are integer inner products; of equal ones the smaller id is first.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("long").alias("label"))
    kept = cut(given.mapInArrow(_quantised, "id long, label long, q binary, size long, most double"))
    size, high, anchors = kept.agg(F.max("size"), F.max("most"), F.count_if(F.col("id") % every == 0)).first()
    if not anchors:
        return spark.createDataFrame([], schema)
    if high * high * max(1, size) >= 2**53:
        raise ValueError(f"scores of components up to {high / 256:g} in {size} dimensions can't be held exactly")
    size, kind = size or 1, "<i2" if high < 2**15 else "<i4"
    keyed = kept.mapInArrow(_keyed(size, int(high)), "id long, label long, q binary, key binary")
    store = _Store(keyed, size, kind)
    asking = keyed.filter(F.col("id") % every == 0).distinct().repartitionByRange(tasks_for(spark, 0), "key", "id").sortWithinPartitions("key", "id")
    chunks = cut(asking.mapInArrow(_packed(size, kind, CHUNK), _BLOCKS).mapInArrow(_asked, _CHUNK))
    found = store.search(chunks, positives, True).mapInArrow(_windowed(size, kind, positives, least, most), _CHUNK)
    return store.search(cut(found), negatives, False).mapInArrow(_listed(size, kind, negatives), schema)
