"""Substring dedup of word windows with a count-min prefilter.

First pass: every task sketches the hashes of its windows, the sketches are merged, and the merged one overestimates how
often each window occurs. Second pass: only windows estimated to occur twice or more are grouped exactly, by a 128-bit
digest of their words; the sketch loses none. Before the shuffle every block of a task settles what it can by itself: of
equal windows in one block only those of the smallest document go on, all in one row, so a window that fills a third of all
rows sends a row per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sketch
from .common import LAST_ID, stored

WINDOW = 13
#: Bytes of text that a block of the second pass holds, and windows whose digests are made at a time.
BLOCK_BYTES = 8 << 20
DIGESTS = 1 << 17


def split_words(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts one after the other, and each text's number of words."""
    parts = [(text or "").encode().split() for text in texts]  # bytes: only the six ASCII blanks split
    return [w for part in parts for w in part], np.fromiter(map(len, parts), np.int64, len(parts))


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, n: int, factor: int) -> np.ndarray:
    """A polynomial hash of every n consecutive values, by doubling: position i holds that of words[i : i + n]."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out, length = None, 0
    power, size, multiplier = words, 1, np.uint64(factor)
    with np.errstate(over="ignore"):
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                if out is None:
                    out, length = power, size
                else:
                    m = len(words) - length - size + 1
                    out = out[:m] * multiplier + power[length : length + m]
                    length += size
            if n >> bit + 1:
                m = len(words) - 2 * size + 1
                power = power[:m] * multiplier + power[size : size + m]
                size, multiplier = 2 * size, multiplier * multiplier
    return sketch.mix(out)


def windows(words: list[bytes], sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, place of the first word) of all windows that lie in one text; equal windows have equal hashes."""
    if len(words) < n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    h = window_hashes(hash_words(words), n, 0x9FB21C651E98DF25)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(h)]
    inside = np.arange(len(h)) + n <= sizes.cumsum()[text]
    return h[inside], text[inside], np.flatnonzero(inside)


def digests(joined: bytes, ends: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """128-bit digests of the windows at ``places``, as two columns; ``ends``: where each word of ``joined`` ends."""
    begins, stops = np.concatenate([[0], ends[:-1] + 1])[places], ends[places + n - 1]
    digest, out = xxhash.xxh3_128_digest, np.empty((len(places), 2), np.int64)
    for at in range(0, len(places), DIGESTS):
        some = zip(begins[at : at + DIGESTS].tolist(), stops[at : at + DIGESTS].tolist(), strict=True)
        out[at : at + DIGESTS] = np.frombuffer(b"".join([digest(joined[a:b]) for a, b in some]), "<i8").reshape(-1, 2)
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(did, k, text): the id by which documents are ordered (null last) and 31 bits of the text's hash, to tell rows with one id apart."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("did"),
        F.xxhash64(text_col).bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int").alias("k"),
        F.col(text_col).alias("text"),
    )


def blocks(batches: Iterator[pa.RecordBatch], times: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, list[str | None]]]:
    """(did, k, texts) of some ``times`` BLOCK_BYTES of text each."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            held.append(some)
            size += some.nbytes
            if size >= times * BLOCK_BYTES:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(held: list[pa.RecordBatch]):
    table = pa.Table.from_batches(held)
    return table.column("did").to_numpy(), table.column("k").to_numpy(), table.column("text").to_pylist()


def candidate_rows(did: np.ndarray, k: np.ndarray, texts: list[str | None], n: int, reached) -> Iterator[pa.RecordBatch]:
    """Rows (h1, h2, did, place, more) of one block; a place is the row's k and a start, ``more`` those besides the first.

    One row for each window that ``reached(hashes)`` lets through, with its places in the smallest document of the block.
    Places in other documents are settled here: a row without a digest for each of those documents.
    """
    words, sizes = split_words(texts)
    h, text, at = windows(words, sizes, n)
    some = reached(h)
    text, at = text[some], at[some]
    if not len(at):
        return
    joined, ends = b" ".join(words), (np.fromiter(map(len, words), np.int64, len(words)) + 1).cumsum() - 1
    del words, h
    h1, h2 = digests(joined, ends, at, n).T
    del joined, ends
    order = did[text]
    place = (k[text].astype(np.int64) << 32) | (at - (sizes.cumsum() - sizes)[text])
    by = np.lexsort((place, order, h2, h1))
    h1, h2, text, place, order = h1[by], h2[by], text[by], place[by], order[by]
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    settled = order > order[np.flatnonzero(new)[new.cumsum() - 1]]  # a smaller document in this very block

    def rows(chosen, head, with_digest):
        begin = np.flatnonzero(head)
        many = np.diff(begin, append=len(chosen))
        more, sizes = np.delete(chosen, begin), many - 1
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32)), pa.array(place[more]), mask=pa.array(sizes == 0))
        # in order of documents: then all but the digest compresses well in the shuffle
        by = np.lexsort((place[chosen[begin]], order[chosen[begin]]))
        first, lists = chosen[begin][by], lists.take(pa.array(by))
        hashes = [pa.array(x[first]) if with_digest else pa.nulls(len(first), pa.int64()) for x in (h1, h2)]
        return pa.RecordBatch.from_arrays([*hashes, pa.array(order[first]), pa.array(place[first]), lists], names=["h1", "h2", "did", "place", "more"])

    left = np.flatnonzero(~settled)
    yield rows(left, new[left], True)  # the first of equal windows is never settled
    gone = np.flatnonzero(settled)
    if len(gone):
        gone = gone[np.argsort(text[gone], kind="stable")]
        yield rows(gone, np.diff(text[gone], prepend=-1) != 0, False)


def repeated_windows(docs: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, k, starts): of every document, the starts of windows that also start in a document with a smaller id."""
    rows = keyed(docs, id_col, text_col)
    width = sketch.width_for(sketch.text_bytes(docs, text_col) / 8)

    def hashes(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield windows(*split_words(batch.slice(at, 256).column(0).to_pylist()), n)[0]

    (twice,) = sketch.merged_sketch(rows.select("text"), hashes, width, (2,))
    sent = docs.sparkSession.sparkContext.broadcast(twice)  # bounded by the sketch's MAX_WIDTH

    def candidates(batches):
        for did, k, texts in blocks(batches):
            yield from candidate_rows(did, k, texts, n, lambda h: sketch.reached(sent.value, h, width))

    found = rows.mapInArrow(candidates, "h1 long, h2 long, did long, place long, more array<long>")
    # one pass over the candidates, a row of each window for each block at most; what is settled is spread by its place
    spread = F.when(F.col("h1").isNull(), F.xxhash64("did", "place"))
    same = Window.partitionBy("h1", "h2", spread)
    later = found.withColumn("least", F.min("did").over(same)).filter(F.col("h1").isNull() | (F.col("did") > F.col("least")))
    places = later.select("did", F.explode(F.concat(F.array("place"), F.coalesce("more", F.array().cast("array<long>")))).alias("place"))
    return (
        places.select("did", F.shiftright("place", 32).cast("int").alias("k"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int").alias("start"))
        .groupBy("did", "k")
        .agg(F.collect_list("start").alias("starts"))
    )


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a window of ``length`` from one of ``starts``."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + length, size), -1)
    return delta.cumsum()[:size] > 0


def dedup_windows(docs: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row of ``docs`` and, if asked for, ``kept``: the words left, joined by one space.

    A null, empty or short text has no window and keeps all its words. Windows are judged on the input. Rows that share an
    id don't remove each other's windows; repeated rows each get the same result. A null id is larger than every other.
    An empty table gives no rows. Other columns aren't read.
    """
    found = stored(repeated_windows(docs, n, id_col, text_col), "windows")
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(found, ["did", "k"], "left").select("did", "text", "starts")
    names = ["did", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text

    def cut(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (text or "").encode().split()
                removed = 0
                if starts.is_valid:
                    gone = covered(np.asarray(starts.values), n, len(words))
                    removed = int(gone.sum())
                    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                else:
                    kept = b" ".join(words)
                for column, value in zip(out, (len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode()), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays[: len(names) - 1]], names=names)

    done = joined.mapInArrow(cut, "did long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
    return done.select(F.when(F.col("did") != LAST_ID, F.col("did")).alias(id_col), *names[1:])
