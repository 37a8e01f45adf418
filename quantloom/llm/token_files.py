"""Token-id files: canonical length-limited Huffman code over global counts.

Texts are tokenised in ascending document order, ids are counted globally (at most one count for each id of the
vocabulary), and one canonical code with lengths of at most ``MAX_BITS`` is built from the counts. Ids are written in
blocks that each decode on their own; a block has a bit offset for every ``CHECKPOINT`` tokens, from which decoding
starts in parallel lanes through a table of ``2**MAX_BITS`` entries.

Files: a folder with two Parquet tables. ``code``: (id, length) of the canonical code. ``blocks``: (part, block, start,
doc_ids, n_tokens, payload, checkpoints); start counts the ids of all documents before the block, the arrays are
little-endian (int64, int64, uint64), the payload is a bit string, first bit highest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import remove, tasks_for, work_path
from .sketch import text_bytes
from .text_batches import slices

MAX_BITS = 20
CHECKPOINT = 256
BLOCK_TOKENS = 1 << 20


# ---- the code

def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits (package-merge); 0 for a count of 0. One symbol alone gets 1 bit."""
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(symbols) <= 1:
        lengths[symbols] = 1
        return lengths
    if len(symbols) > 1 << most:
        raise ValueError(f"{len(symbols)} symbols can't have codes of {most} bits")
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    leaves = counts[order].astype(np.float64)
    packages, levels = np.zeros(0), []
    for _ in range(most):
        # merged list of this level: leaves and packages by weight; remember which entries are leaves
        weights = np.concatenate([leaves, packages])
        by = np.argsort(weights, kind="stable")
        levels.append(by < len(leaves))
        merged = weights[by]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        bits[:n] += 1
        take = 2 * (take - n)
    lengths[order] = bits
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the canonical code, and the symbols in code order."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = (1 << (MAX_BITS - lengths[order].astype(np.int64))).cumsum()
    first = np.concatenate([[0], span[:-1]]) if len(span) else span
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = first >> (MAX_BITS - lengths[order].astype(np.int64))
    return codes, order


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Payload and checkpoints of one block."""
    n = lengths[ids].astype(np.int64)
    ends = n.cumsum()
    starts = ends - n
    total = int(ends[-1]) if len(ends) else 0
    value = codes[ids] << (64 - (starts & 31) - n).astype(np.uint64)
    word, size = starts >> 5, total // 32 + 2
    # codes don't overlap: their sum is their union, and below 2**32 exact in float64
    high = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=size)
    low = np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size)
    words = (high[:size] + low[:size]).astype(">u4")
    return words.tobytes()[: (total + 7) // 8], starts[::CHECKPOINT].astype("<u8").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next ``MAX_BITS`` bits: the id and its code's length."""
    _, order = canonical(lengths)
    span = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    symbol = np.zeros(1 << MAX_BITS, np.uint32)
    filled = np.repeat(order.astype(np.uint32), span)
    symbol[: len(filled)] = filled
    return symbol, lengths[symbol]


def unpack(payload: bytes, checkpoints: bytes, n: int, table) -> np.ndarray:
    """The ids of one block; every checkpoint starts a lane of its own."""
    symbol, length = table
    raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    lanes = np.zeros((CHECKPOINT, len(at)), np.uint32)
    last = len(ahead) - 1
    for k in range(CHECKPOINT if len(at) > 1 else n):
        peek = (ahead[np.minimum(at >> 3, last)] >> (32 - MAX_BITS - (at & 7)).astype(np.uint32)) & np.uint32((1 << MAX_BITS) - 1)
        lanes[k] = symbol[peek]
        at += length[peek]
    return lanes.T.reshape(-1)[:n]


# ---- the jobs

@lru_cache(maxsize=2)  # a Python worker keeps it from task to task
def load_tokenizer(path: str, end_id: int):
    """The tokenizers library's tokenizer, and the type that holds its ids."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, np.dtype("<u2") if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.dtype("<u4")


def encode(tokenizer, texts: list[str], dtype: np.dtype) -> list[np.ndarray]:
    """Ids of whole texts, by the library and its threads."""
    return [np.array(e.ids, dtype) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, block, start, doc_ids, n_tokens, ids): blocks of whole documents by ascending id, nulls last, rows of one id by a hash of their texts; start within the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, dtype = load_tokenizer(tokenizer_path, end_id)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held, sizes, names, valid, total = [], [], [], [], 0
        end = np.array([end_id], dtype)

        def flush():
            return pa.RecordBatch.from_pydict(
                {
                    "part": [part], "block": [block], "start": [start], "total": [total],
                    "doc_ids": [np.array(names, "<i8").tobytes()], "has_id": [bytes(valid)], "n_tokens": [np.array(sizes, "<i8").tobytes()],
                    "ids": [b"".join(held)], "wide": [dtype.itemsize == 4],
                },
                schema=blocks_schema,
            )

        for batch in batches:
            for some in slices(batch, 1):
                texts = [t or "" for t in some.column(1).to_pylist()]
                for name, ids in zip(some.column(0).to_pylist(), encode(tokenizer, texts, dtype), strict=True):
                    held += [ids.tobytes(), end.tobytes()]
                    sizes.append(len(ids) + 1)
                    names.append(name or 0)
                    valid.append(name is not None)
                    total += len(ids) + 1
                    if total >= BLOCK_TOKENS:
                        yield flush()
                        block, start = block + 1, start + total
                        held, sizes, names, valid, total = [], [], [], [], 0
        if sizes:
            yield flush()

    blocks_schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("total", pa.int64()), ("doc_ids", pa.binary()), ("has_id", pa.binary()), ("n_tokens", pa.binary()), ("ids", pa.binary()), ("wide", pa.bool_())]
    )
    ordered = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).withColumn("__hash", F.xxhash64("__text"))
    by = [F.col("__id").asc_nulls_last(), F.col("__hash"), F.col("__text")]
    # ranges by id and hash, so that rows of one id, or without any, don't all fall into one
    ordered = ordered.repartitionByRange(tasks_for(docs.sparkSession, text_bytes(docs, text_col)), *by[:2]).sortWithinPartitions(*by).drop("__hash")
    return ordered.mapInArrow(run, "part int, block int, start long, total long, doc_ids binary, has_id binary, n_tokens binary, ids binary, wide boolean")


def _ids(row_ids: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(row_ids, "<u4" if wide else "<u2")


def count_ids(blocks: DataFrame) -> DataFrame:
    """(id, n) over all blocks; every task counts first, so a row per id and task is shuffled at most."""

    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids, wide in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.bincount(_ids(ids, wide), minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())})

    return blocks.select("ids", "wide").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every row of ``docs``, each followed by ``end_id``, to ``path``.

    Whole texts are encoded by the tokenizers library. A null or empty text has the end id alone. A null document id comes
    last, equal ids in order of a hash of their texts, and repeated rows one after the other. An empty table makes empty files. Other columns aren't read.
    """
    spark = docs.sparkSession
    plain = work_path(spark, "ids")
    tokenise(docs, tokenizer_path, end_id, id_col, text_col).write.parquet(plain)
    blocks = spark.read.parquet(plain)
    counted = count_ids(blocks).collect()  # at most one row for each id of the vocabulary
    counts = np.zeros(max((r.id for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int").coalesce(1).write.parquet(f"{path}/code")
    book = spark.sparkContext.broadcast(lengths)  # one byte for each id of the vocabulary

    def run(batches):
        codes, _ = canonical(book.value)
        for batch in batches:
            for r in batch.to_pylist():
                payload, checkpoints = pack(_ids(r.pop("ids"), r.pop("wide")), codes, book.value)
                yield pa.RecordBatch.from_pylist([r | {"payload": payload, "checkpoints": checkpoints}], schema=out)

    out = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.binary()), ("has_id", pa.binary()), ("n_tokens", pa.binary()), ("payload", pa.binary()), ("checkpoints", pa.binary())])
    # one row for each part: as many as there are shuffle partitions
    before = blocks.groupBy("part").agg(F.sum("total").alias("n"))
    before = before.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = blocks.join(F.broadcast(before), "part").select("part", "block", (F.col("start") + F.col("before")).alias("start"), "doc_ids", "has_id", "n_tokens", "ids", "wide")
    placed.mapInArrow(run, "part int, block int, start long, doc_ids binary, has_id binary, n_tokens binary, payload binary, checkpoints binary").write.parquet(f"{path}/blocks")
    remove(spark, plain)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) and, if asked for, ids of every document in the files.

    A row for each row that was written: null ids stay null, null and empty texts have the end id, repeated rows and ids
    come as often as they were written. Files of an empty table give no rows.
    """
    rows = spark.read.parquet(f"{path}/code").collect()  # at most one row for each id of the vocabulary
    lengths = np.zeros(max((r.id for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r.id] = r.length
    book = spark.sparkContext.broadcast(lengths)
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids

    def run(batches):
        table = decode_table(book.value)
        for batch in batches:
            for r in batch.to_pylist():
                n = np.frombuffer(r["n_tokens"], "<i8")
                ids = unpack(r["payload"], r["checkpoints"], int(n.sum()), table).astype("<u4")
                ends = n.cumsum()
                cuts = list(zip((ends - n).tolist(), ends.tolist(), strict=True))
                columns = [
                    pa.array(np.frombuffer(r["doc_ids"], "<i8"), pa.int64(), mask=~np.frombuffer(r["has_id"], bool)),
                    pa.array(r["start"] + ends - n, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in cuts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32(), safe=False)))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(kinds))

    blocks = spark.read.parquet(f"{path}/blocks").select("start", "doc_ids", "has_id", "n_tokens", "payload", "checkpoints")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
