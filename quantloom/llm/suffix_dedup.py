"""Exact byte-substring dedup by merging shard Burrows-Wheeler transforms.

Routing: every window of ``length`` bytes has an anchor, the smallest hash among the k-mers sampled inside it, and equal
windows have equal anchors; consecutive windows of one anchor (a "piece") are dealt out by it, so equal windows meet in
one task. A count-min sketch of sampled k-mers leaves out windows with one that occurs once. Nothing is decided by this.

Decision: the pieces of a task are its string collection. Equal strings are stored once with their occurrences, as rows of
a BWT with a multiplicity. The collection is cut into shards, each shard's BWT is built by itself, and the BWTs are merged
by iterative interleave refinement (Holt and McMillan, 2014): each round stably re-orders the interleave by the next
characters in front and marks where rows part, which gives the common prefixes. Runs of rows with a common prefix of
``length`` are the repeated intervals; the earliest occurrence of each stays and all others are removed. No round compares
or sorts whole suffixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import LAST_ID, stored, tasks_for
from .substring_dedup import blocks, keyed, window_hashes

LENGTH = 100
KMER = 32
#: A sampled k-mer is the smallest among so many.
SAMPLE = 35
#: Texts that are hashed together, in bytes, some 60 times as much memory; a longer text is cut into parts. Places take 24 bits.
CHUNK_BYTES = 1 << 20
PART_BYTES = 4 << 20
PLACE = np.uint64(0xFFFFFF)
#: Windows of one piece at most.
PIECE_WINDOWS = 1024
SHARD_BYTES = 1 << 16
#: Piece bytes that one merge holds, unless a single anchor has more; and later occurrences, some 30 bytes each.
MERGE_BYTES = 1 << 19
MERGE_OCCURRENCES = 1 << 20
#: A k-mer estimated to occur so often is an anchor only of windows that have no other, so that anchors have bounded groups.
HOT_ANCHOR = 4_096
TOP = np.uint64(1 << 63)


# ---- pieces

class Pieces:
    """Anchors and pieces of texts that lie one after the other in ``data``.

    ``sampled``: places of the k-mers that are smallest among ``SAMPLE`` in a row, at ``rows``. What is sampled by a row
    inside a window is sampled wherever the window occurs, so a window can only repeat if all of these k-mers do, and the
    smallest of them is an anchor that depends on the window alone.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, length: int, kmer: int = KMER):
        if len(data) > int(PLACE) + 1:
            raise ValueError(f"{len(data)} bytes in one part; places take 24 bits")
        self.length, self.span, self.sizes, self.data = length, length - kmer + 1, sizes, data
        if len(data) < length:
            self.hashes, self.sampled, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        self.hashes = window_hashes(data.astype(np.uint64) + np.uint64(1), kmer, 0x9FB21C651E98DF25)
        placed = (self.hashes & ~PLACE) | np.arange(len(self.hashes), dtype=np.uint64)
        self.sample = min(SAMPLE, self.span)
        at = (_least(placed, self.sample) & PLACE).astype(np.int64)
        self.rows = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))  # the first row of each; the last is before the next's
        self.sampled = at[self.rows]

    def sampled_hashes(self) -> np.ndarray:
        return self.hashes[self.sampled]

    def cut(self, repeated: np.ndarray | None = None, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, first window, number of windows) of all pieces; given which sampled k-mers repeat, of the windows that can.

        ``hot``: which sampled k-mers are anchors only where a window has no other.
        """
        none = np.zeros(0, np.int64)
        if not len(self.hashes):
            return none.astype(np.uint64), none, none
        value = self.sampled_hashes() >> np.uint64(1)
        if hot is not None:
            value = np.where(hot, value | TOP, value)
        stop = np.append(self.rows[1:], len(self.hashes) - self.sample + 1)  # rows that sample each k-mer end here
        anchor = _least(np.repeat(value, stop - self.rows), self.span - self.sample + 1)
        ends = self.sizes.cumsum()
        long = self.sizes >= self.length
        starts = (ends - self.sizes)[long]
        inside = np.zeros(len(self.data) + 1, np.int8)  # +1 where a text's windows begin, -1 behind its last
        np.add.at(inside, starts, 1)
        np.add.at(inside, (ends - self.length + 1)[long], -1)
        inside = inside.cumsum(dtype=np.int8)[: len(anchor)] > 0
        if repeated is not None:
            near = np.zeros(len(anchor) + 1, np.int32)  # how many k-mers that occur once are sampled inside a window
            np.add.at(near, np.maximum(self.rows[~repeated] - (self.span - self.sample), 0), 1)
            np.add.at(near, np.minimum(stop[~repeated], len(anchor)), -1)
            inside &= near.cumsum(dtype=np.int32)[:-1] == 0
        # a piece begins where the anchor or the text changes, or behind a window that can't repeat
        begin = inside.copy()
        begin[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        begin[starts] = inside[starts]
        upto = np.cumsum(inside)
        first = np.flatnonzero(begin)
        count = np.diff(upto[first] - 1, append=upto[-1])
        cuts = -(-count // PIECE_WINDOWS)
        which = np.repeat(np.arange(len(first)), cuts)
        nth = np.arange(len(which)) - np.repeat(cuts.cumsum() - cuts, cuts)
        first, count = first[which] + nth * PIECE_WINDOWS, np.minimum(count[which] - nth * PIECE_WINDOWS, PIECE_WINDOWS)
        return anchor[first], first, count


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every n consecutive values."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (n - size)], values[n - size :]) if n > size else values


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some CHUNK_BYTES; a longer text is a range of its own, also behind empty ones."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _parts(texts: list[bytes], length: int) -> Iterator[tuple[int, int, Pieces]]:
    """(index of the first text, offset in it, Pieces) part by part. A long text is cut with an overlap that repeats no window."""
    most = PART_BYTES - length
    for a, b in _chunks(texts):
        some = texts[a:b]
        if len(some) == 1 and len(some[0]) > most:
            for at in range(0, len(some[0]) - length + 1, most - length + 1):
                data = np.frombuffer(some[0], np.uint8)[at : at + most]
                yield a, at, Pieces(data, np.array([len(data)]), length)
        else:
            yield a, 0, Pieces(np.frombuffer(b"".join(some), np.uint8), np.array([len(t) for t in some], np.int64), length)


def sampled_anchors(texts: list[bytes], length: int) -> Iterator[np.ndarray]:
    for _, _, p in _parts(texts, length):
        yield p.sampled_hashes()


def text_pieces(texts: list[bytes], length: int, repeats=None, hot=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, text index, start, number of windows) of the texts' pieces; ``repeats`` and ``hot`` say of hashes whether they may repeat and are hot."""
    for a, offset, p in _parts(texts, length):
        hashes = p.sampled_hashes()
        anchors, first, count = p.cut(*(None if ask is None else ask(hashes) for ask in (repeats, hot)))
        ends = p.sizes.cumsum()
        text = np.searchsorted(ends, first, side="right")
        yield anchors, text + a, first - (ends - p.sizes)[text] + offset, count


# ---- shard BWTs and their merge

def _stable(ranks: np.ndarray, kinds: int) -> np.ndarray:
    """Stable order of ranks below ``kinds``, 16 bits at a time."""
    order = np.argsort(ranks.astype(np.uint16), kind="stable")
    if kinds > 1 << 16:
        high = (ranks >> 16).astype(np.uint8 if kinds <= 1 << 24 else np.uint16)
        order = order[np.argsort(high[order], kind="stable")]
    return order


def _pairs(first: np.ndarray, second: np.ndarray, kinds: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """(order, rank, kinds) of pairs of ranks."""
    order = _stable(second, kinds[1])
    order = order[_stable(first[order], kinds[0])]
    a, b = first[order], second[order]
    step = ((a[1:] != a[:-1]) | (b[1:] != b[:-1])).cumsum(dtype=np.int32)
    rank = np.empty(len(order), np.int32)
    rank[order[:1]] = 0
    rank[order[1:]] = step
    return order, rank, int(step[-1]) + 1 if len(step) else 1


def shard_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of one shard in order of their first ``depth`` bytes at least (prefix doubling)."""
    one = data.astype(np.int32)
    rank, kinds = _ranks(one << 8 | np.roll(one, -1), 1 << 16)
    known, order = 2, None
    while known < depth and kinds < len(data) or order is None:
        order, rank, kinds = _pairs(rank, np.roll(rank, -known), (kinds, kinds))
        known *= 2
    return order


def _grams(data: np.ndarray, back: np.ndarray, depth: int) -> tuple[np.ndarray, int, np.ndarray, int]:
    """(rank of the bytes before each place, its kinds, the place as many bytes before, how many bytes).

    ``back``: the place before each place, around its shard. As many bytes as divide ``depth``, 32 at most.
    """
    rank, kinds = _ranks(data.astype(np.int32)[back], 256)
    far, size, best = back, 1, None
    while True:
        if depth % size == 0:
            best = rank, kinds, far, size
        if size >= 16 or 2 * size > depth:
            break
        if size == 4 and depth % 5 == 0:  # 5, 10, 20 rather than 8, 16
            one, n = _ranks(data.astype(np.int32)[back], 256)
            _, rank, kinds = _pairs(rank[back], one, (kinds, n))
            far, size = far[back], 5
            continue
        _, rank, kinds = _pairs(rank[far], rank, (kinds, kinds))
        far, size = far[far], 2 * size
    return best


def _ranks(values: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    """Order-preserving ranks of values below ``most``, and how many there are."""
    seen = np.zeros(most, bool)
    seen[values] = True
    return (seen.cumsum(dtype=np.int32) - 1)[values], int(seen.sum())


def merge_shards(shards: list[np.ndarray], depth: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(places, lcp) of all rotations of the shards in their merged order.

    ``places`` index the shards' bytes laid one after the other, ``lcp`` has the length of the common prefix with the
    rotation before: ``depth`` where it is that or more, and below it rounded down to whole rounds unless ``exact``.
    """
    base = np.cumsum([0] + [len(s) for s in shards])
    data = np.concatenate(shards)
    sa = np.concatenate([shard_order(s, depth) + b for s, b in zip(shards, base, strict=False)]).astype(np.int32)
    isa = np.empty(len(sa), np.int32)
    isa[sa] = np.arange(len(sa), dtype=np.int32)
    back = np.arange(-1, len(data) - 1, dtype=np.int32)
    back[base[:-1]] = base[1:] - 1
    grams, kinds, far, step = _grams(data, back, depth)
    symbol, lf = grams[sa], isa[far[sa]]  # the BWT over grams, and where a rotation goes when its gram is put in front
    interleave = np.arange(len(sa), dtype=np.int32)
    lcp = np.full(len(sa), -1, np.int32)
    part = np.zeros(len(sa), bool)
    for known in range(0, depth, step):
        front = symbol[interleave]
        order = _stable(front, kinds)
        block = part.cumsum(dtype=np.int32)[order]
        front, interleave = front[order], lf[interleave][order]
        part = np.empty(len(sa), bool)
        part[0] = True
        np.not_equal(front[1:], front[:-1], out=part[1:])
        part[1:] |= block[1:] != block[:-1]
        lcp[part & (lcp < 0)] = known
    lcp[lcp < 0] = depth
    places = sa[interleave]
    if exact:
        _extend(lcp, places, data, base, step, depth)
    return places, lcp


def _extend(lcp: np.ndarray, places: np.ndarray, data: np.ndarray, base: np.ndarray, step: int, depth: int) -> None:
    """Makes common prefixes that are known to a whole round exact, byte by byte."""
    open_ = np.flatnonzero(lcp < depth)
    open_ = open_[open_ > 0]
    shard = np.searchsorted(base, places, side="right") - 1
    begin, size = base[shard], np.diff(base)[shard]
    for _ in range(step - 1):
        ahead = [data[begin[i] + (places[i] - begin[i] + lcp[open_]) % size[i]] for i in (open_ - 1, open_)]
        open_ = open_[ahead[0] == ahead[1]]
        if not len(open_):
            break
        lcp[open_] += 1
    lcp[0] = 0


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, n) of the runs of true values."""
    edge = np.flatnonzero(np.diff(marked.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2] - edge[::2]


def repeated_runs(texts: list[bytes], counts: np.ndarray, length: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs (text, start, n) of windows of different texts that lie in the order of their first occurrence; ``counts``: how often each occurs.

    First the runs whose windows start earlier in the list, which go wherever the text occurs; then the runs whose windows
    occur at least twice, which go from every later occurrence of the text. Texts must have fewer than 65536 bytes.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = sizes.cumsum()
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    cuts = [0]
    while cuts[-1] < len(data):
        cuts.append(int(ends[np.searchsorted(ends, cuts[-1] + SHARD_BYTES, side="right") - 1]))
    places, lcp = merge_shards([data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], length)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    whole = np.arange(len(data)) + length < ends[owner]  # a window lies before its text's end
    interval = (lcp < length).cumsum(dtype=np.int32)  # rows with a common prefix of the whole length
    some = whole[places]
    places, interval = places[some], interval[some]
    begin = np.flatnonzero(np.diff(interval, prepend=-1))
    widths = np.diff(begin, append=len(places))
    again, often = np.zeros(len(data), bool), np.zeros(len(data), bool)
    if len(places):
        again[places] = places > np.repeat(np.minimum.reduceat(places, begin), widths)
        often[places] = np.repeat(np.add.reduceat(counts[owner[places]], begin) > 1, widths)
    out = []
    for marked in (again, often):
        start, n = _runs(marked)  # a text's last place is no window, so no run goes over its end
        out.append((owner[start], start - (ends - sizes)[owner[start]], n))
    return out[0], out[1]


# ---- the jobs

_PIECE = [("key", pa.int64()), ("did", pa.int64()), ("k", pa.int32()), ("start", pa.int32()), ("piece", pa.binary()), ("others", pa.binary())]
_RUN = [("did", pa.int64()), ("k", pa.int32()), ("start", pa.int32()), ("n", pa.int32())]
#: One occurrence of a piece besides the first.
_PLACE = np.dtype([("did", "<i8"), ("k", "<i4"), ("start", "<i4")])


def block_pieces(did: np.ndarray, k: np.ndarray, texts: list[bytes], length: int, repeats=None, hot=None) -> pa.RecordBatch:
    """One row for each different piece of a block: its first occurrence in the block and all others."""
    found = list(text_pieces(texts, length, repeats, hot))
    anchor, text, start, n = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
    by = np.lexsort((start, k[text], did[text]))  # the earliest first
    anchor, text, start, n = anchor[by], text[by], start[by], n[by]
    place: dict[bytes, int] = {}
    same = np.fromiter(
        (place.setdefault(texts[t][s : s + m + length - 1], len(place)) for t, s, m in zip(text.tolist(), start.tolist(), n.tolist(), strict=True)), np.int64, len(text)
    )
    first = np.unique(same, return_index=True)[1]
    spot = np.zeros(len(text), _PLACE)
    spot["did"], spot["k"], spot["start"] = did[text], k[text], start
    other = np.flatnonzero(spot != spot[first][same] if len(spot) else np.zeros(0, bool))  # a repeated row is the same occurrence
    other = other[np.argsort(same[other], kind="stable")]
    data, sizes = spot[other].tobytes(), np.bincount(same[other], minlength=len(place)) * _PLACE.itemsize
    offsets = pa.py_buffer(np.concatenate([[0], sizes.cumsum()]).astype(np.int32).tobytes())
    others = pa.Array.from_buffers(pa.binary(), len(place), [None, offsets, pa.py_buffer(data)])
    head = spot[first]
    columns = [anchor[first].astype(np.uint64).view(np.int64), *(np.ascontiguousarray(head[c]) for c in ("did", "k", "start"))]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(list(place), pa.binary()), others], names=[c for c, _ in _PIECE])


def removed_windows(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_ANCHOR) -> DataFrame:
    """(did, k, runs): of every document the runs (start, n) of windows that also start earlier."""
    rows = keyed(docs, id_col, text_col)
    size = sketch.text_bytes(docs, text_col)
    width = sketch.width_for(size / 16)  # one k-mer of some 18 is sampled

    def anchors(batches):
        for _, _, texts in blocks(batches):
            yield from sampled_anchors([(t or "").encode() for t in texts], length)

    twice, often = sketch.merged_sketch(rows, anchors, width, (2, hot))
    often = sketch.sparse(often)
    sent = docs.sparkSession.sparkContext.broadcast((twice, often))  # bounded by the sketch's MAX_WIDTH

    def candidates(batches):
        repeats, is_hot = (lambda hashes, i=i: sketch.reached(sent.value[i], hashes, width) for i in (0, 1))
        for did, k, texts in blocks(batches, 2):
            yield block_pieces(did, k, [(t or "").encode() for t in texts], length, repeats, is_hot)

    found = rows.mapInArrow(candidates, "key long, did long, k int, start int, piece binary, others binary")
    dealt = found.repartition(tasks_for(docs.sparkSession, 2 * size), "key").sortWithinPartitions("key", "did", "k", "start")
    runs = dealt.mapInArrow(lambda batches: merged_runs(batches, length), "did long, k int, start int, n int")
    return runs.groupBy("did", "k").agg(F.collect_list(F.struct("start", "n")).alias("runs"))


class _Collection:
    """The different pieces of one anchor in the order of their first occurrence, and their later occurrences."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.first: list[tuple[int, int, int]] = []
        self.counts: list[int] = []
        self.bytes = self.held = 0
        self.later: list[tuple[int, np.ndarray]] = []

    def add(self, spot: tuple[int, int, int], piece: bytes, others: bytes) -> None:
        at = self.place.setdefault(piece, len(self.place))
        more = np.frombuffer(others, _PLACE)
        if at == len(self.first):
            self.first.append(spot)
            self.counts.append(1)
            self.bytes += len(piece)
        elif spot != self.first[at]:
            more = np.concatenate([np.array([spot], _PLACE), more])
        if len(more):
            self.counts[at] += len(more)
            self.held += len(more)
            self.later.append((at, more))


def _merge(collections: list[_Collection], length: int, firsts: bool = True) -> pa.RecordBatch:
    """What goes by the merged BWTs of the collections' pieces. Later occurrences are given once; first ones only if asked for."""
    texts = [p for c in collections for p in c.place]
    counts = np.array([n for c in collections for n in c.counts], np.int64)
    first = np.array([s for c in collections for s in c.first], _PLACE)
    (own, start, n), (text, at, size) = repeated_runs(texts, counts, length)
    parts = [(first[own], start, n)] if firsts else []
    base = 0
    spots, which = [], []
    for c in collections:
        for i, more in c.later:
            spots.append(more)
            which.append(np.full(len(more), base + i))
        c.later, c.held = [], 0
        base += len(c.first)
    if spots:
        spot, which = np.concatenate(spots), np.concatenate(which)
        begin, end = np.searchsorted(text, which), np.searchsorted(text, which, side="right")  # the runs of each one's piece
        many = end - begin
        row = np.repeat(np.arange(len(which)), many)
        run = np.arange(len(row)) - np.repeat(many.cumsum() - many, many) + begin[row]
        parts.append((spot[row], at[run], size[run]))
    spot, start, n = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (first[:0], np.zeros(0, np.int64), np.zeros(0, np.int64))
    columns = [spot["did"], spot["k"], spot["start"] + start, n]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), t) for c, (_, t) in zip(columns, ((x, y) for x, y in _RUN), strict=True)], names=[c for c, _ in _RUN])


def merged_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows of pieces in order of key and first occurrence: the runs of windows that start earlier, all from merged BWTs."""
    held: list[_Collection] = []
    now, key, size, later = _Collection(), None, 0, 0

    for batch in batches:
        for this, did, k, start, piece, others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if this != key:
                if size >= MERGE_BYTES or later >= MERGE_OCCURRENCES:
                    yield _merge(held, length)
                    held, size, later = [], 0, 0
                now, key = _Collection(), this
                held.append(now)
            size, later = size - now.bytes, later - now.held
            now.add((did, k, start), piece, others)
            if now.held >= MERGE_OCCURRENCES:  # one very frequent piece: its later occurrences don't wait
                yield _merge([now], length, firsts=False)
            size, later = size + now.bytes, later + now.held
    if held:
        yield _merge(held, length)


def dedup_bytes(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, hot: int = HOT_ANCHOR) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` and, if asked for, ``kept``: the bytes left.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id, or in
    the same one before. Strings are judged on the input and never cross documents. A null, empty or short text keeps all.
    A null id is larger than every other; rows with one id and different texts are ordered by a hash of their texts, and
    repeated rows count once and each get the same result. An empty table gives no rows. Other columns aren't read.
    """
    if length <= KMER:
        raise ValueError(f"the length must be over {KMER}")
    found = stored(removed_windows(docs, length, id_col, text_col, hot), "runs")
    joined = keyed(docs, id_col, text_col).join(found, ["did", "k"], "left").select("did", "text", "runs")
    names = ["did", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def cut(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode()
                spans: list[list[int]] = []
                for a, b in sorted((r["start"], r["start"] + r["n"] - 1 + length) for r in runs or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(out, (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays[: len(names) - 1]], names=names)

    done = joined.mapInArrow(cut, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
    return done.select(F.when(F.col("did") != LAST_ID, F.col("did")).alias(id_col), *names[1:])
