"""Count-min sketches of 64-bit hashes, made by partitions and merged by cell range.

A task counts the cells of its own hashes and sends them sorted, gap-coded and compressed, in ranges of ``RANGE_CELLS``
cells; a reducer merges one range at a time. What comes back is, for every cell, whether it reached each of the given
levels: ``depth * width`` bits for each level, whose size has the bound ``MAX_WIDTH`` and may therefore be broadcast.
A hash is estimated to occur at least ``level`` times if all its cells reached the level, so estimates are never too low.
Beyond the bound cells fill up, estimates grow and more is left to the exact pass; nothing is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

DEPTH = 2
#: Most cells in a row of the sketch; two rows of bits are then 128 MB for each level.
MAX_WIDTH = 1 << 29
RANGE_CELLS = 1 << 22
#: Hashes that a task counts at a time.
BLOCK = 1 << 21
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def width_for(n: float) -> int:
    """Four cells for each of n expected hashes, within the bound."""
    return int(min(MAX_WIDTH, max(1 << 16, 4 * n)))


def cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    # the high half of a product instead of a division: uniform over the width
    return ((mix(hashes * _ODD[row]) >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)


def _encode(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted cells as gaps, byte plane by byte plane, then counts up to 65535 in the same way."""
    gaps = np.diff(values, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    planes = np.minimum(counts, 65535).astype("<u2").view(np.uint8).reshape(-1, 2).T
    return zstandard.ZstdCompressor(level=1).compress(gaps.tobytes() + planes.tobytes())


def _decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(6, -1)
    return np.ascontiguousarray(raw[:4].T).view("<u4")[:, 0].cumsum(dtype=np.int64), np.ascontiguousarray(raw[4:].T).view("<u2")[:, 0]


def merged_sketch(df: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], width: int, levels: tuple[int, ...]) -> list[np.ndarray]:
    """Per level, the packed bits of the merged sketch of everything that ``hashes`` yields in the tasks of ``df``."""
    total = DEPTH * width

    def partial(batches):
        held: list[np.ndarray] = []

        def flush():
            h = np.concatenate(held)
            for row in range(DEPTH):
                at = np.sort(cells(h, row, width) + np.uint64(row * width))
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                counts, at = np.diff(first, append=len(at)), at[first]
                ranges = (at // np.uint64(RANGE_CELLS)).astype(np.int64)
                cut = np.flatnonzero(np.diff(ranges)) + 1
                for a, b in zip([0, *cut], [*cut, len(at)], strict=True):
                    yield int(ranges[a]), _encode(at[a:b] - np.uint64(ranges[a] * RANGE_CELLS), counts[a:b])

        def records():
            size = 0
            for h in hashes(batches):
                held.append(h)
                size += len(h)
                if size >= BLOCK:
                    yield from flush()
                    held.clear()
                    size = 0
            if size:
                yield from flush()

        for which, data in records():
            yield pa.RecordBatch.from_pydict({"part": pa.array([which], pa.int32()), "data": pa.array([data], pa.binary())})

    def merge(batches):
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        for part, group in groupby(rows, key=lambda r: r[0]):
            counts = np.zeros(min(RANGE_CELLS, total - part * RANGE_CELLS), np.uint32)
            for _, data in group:
                at, n = _decode(data.as_py())
                counts[at] += n
            bits = [zstandard.ZstdCompressor(level=1).compress(np.packbits(counts >= level, bitorder="little").tobytes()) for level in levels]
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bits": pa.array([bits], pa.list_(pa.binary()))})

    n = max(1, min(-(-total // RANGE_CELLS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = df.mapInArrow(partial, "part int, data binary").repartition(n, "part").sortWithinPartitions("part").mapInArrow(merge, "part int, bits array<binary>")
    out = [np.zeros(total // 8 + 1, np.uint8) for _ in levels]
    for row in merged.toLocalIterator():  # all of it together is as large as the bound says
        for whole, data in zip(out, row.bits, strict=True):
            some = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8)
            whole[row.part * (RANGE_CELLS // 8) : row.part * (RANGE_CELLS // 8) + len(some)] = some
    spark = df.sparkSession
    del merged
    release(spark)
    return out


def sparse(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed bits that are nearly all zero as (places of bytes, bytes)."""
    places = np.flatnonzero(bits)
    return places, bits[places]


def reached(bits, hashes: np.ndarray, width: int) -> np.ndarray:
    """Whether each hash is estimated to reach the level of ``bits``, packed or sparse."""
    yes = np.ones(len(hashes), bool)
    for row in range(DEPTH):
        at = cells(hashes, row, width) + np.uint64(row * width)
        place, bit = (at >> np.uint64(3)).astype(np.int64), (at & np.uint64(7)).astype(np.uint8)
        if isinstance(bits, tuple):
            near = np.searchsorted(bits[0], place)
            near[near == len(bits[0])] = 0
            byte = np.where(bits[0][near] == place, bits[1][near], 0).astype(np.uint8) if len(bits[0]) else np.zeros(len(place), np.uint8)
        else:
            byte = bits[place]
        yes &= (byte >> bit) & 1 > 0
    return yes


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts, to size a sketch by."""
    return docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
