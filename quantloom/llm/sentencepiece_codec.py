"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed as protobuf wire format; its normaliser, space marker, scores (unigram) or merge order (BPE) and
byte fallback are rebuilt for the tokenizers library, which encodes batches of whole texts with its own threads. Parity is
verified as the work goes on: every text is also encoded by the sentencepiece library, and marked if the ids differ.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_batches import slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values: piece types
UNIGRAM, BPE = 1, 2  # fixed values: model types


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    def ids_of(self, kind: int) -> list[int]:
        return [i for i, p in enumerate(self.pieces) if p[2] == kind]


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of one protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        else:
            size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
            yield number, data[at : at + size]
            at += size


def parse_model(data: bytes) -> Model:
    """The parts of a sentencepiece model file that encoding and decoding need."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:  # pieces
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:  # trainer
            spec = dict(_fields(value))
            model.model_type, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
        elif number == 3:  # normaliser
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.add_dummy_prefix, model.remove_extra_whitespaces, model.escape_whitespaces = (bool(spec.get(k, 1)) for k in (3, 4, 5))
    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """All pairs that make a piece, best piece first; the pairs of one piece in order of their own scores."""
    score = {p: s for p, s, kind in model.pieces if kind in (NORMAL, UNUSED)}
    place = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    ranked = []
    for piece, s in score.items():
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if left in score and right in score:
                ranked.append((-s, place[piece], place[left], place[right], left, right))
    return [(left, right) for *_, left, right in sorted(ranked)]


def unmerged(model: Model, piece: str) -> list[str]:
    """What an unused piece of a BPE model falls back to: the parts that its own last merge joined, these taken apart in turn if unused."""
    kinds = {p: (s, kind) for p, s, kind in model.pieces if kind in (NORMAL, UNUSED)}
    parts = list(piece)
    while len(parts) > 2:
        best = max(range(len(parts) - 1), key=lambda i: (kinds.get(parts[i] + parts[i + 1], (-np.inf,))[0], -i))
        if parts[best] + parts[best + 1] not in kinds:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    if len(parts) == 1:
        return parts
    return [x for p in parts for x in (unmerged(model, p) if kinds.get(p, (0, NORMAL))[1] == UNUSED else [p])]


class Codec:
    """One model, rebuilt on the tokenizers library. ``verify``: compare every text with the sentencepiece library.

    User-defined pieces are cut out of the text before the model runs. Unused pieces never come out: a unigram model
    doesn't see them, and in a BPE model they only carry merges and are taken apart again. Where no piece goes on behind
    a space marker that follows another character, texts are split before runs of the marker, so that the library can keep
    its cache of words.
    """

    def __init__(self, data: bytes, verify: bool = True):
        from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers, pre_tokenizers

        self.model = model = parse_model(data)
        if not model.escape_whitespaces:
            raise ValueError("models without the space marker are not supported")
        unknown = model.ids_of(UNKNOWN)[0]
        # texts hold no space once it is marked, so a piece written with one is never found
        hidden = {UNKNOWN, CONTROL} | ({UNUSED} if model.model_type == UNIGRAM else set())
        names = [f" {i}" if kind in hidden else p for i, (p, _, kind) in enumerate(model.pieces)]
        if model.model_type == UNIGRAM:
            worst = min((s for _, s, kind in model.pieces if kind == NORMAL), default=0.0) - 1_000
            backend = models.Unigram([(n, worst if kind == BYTE else s) for n, (_, s, kind) in zip(names, model.pieces, strict=True)], unk_id=unknown, byte_fallback=model.byte_fallback)
        else:
            vocab = {n: i for i, n in enumerate(names)}
            backend = models.BPE(vocab=vocab, merges=merges(model), unk_token=names[unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
        self.tokenizer = Tokenizer(backend)
        self.tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER])
        if not any(kind in (NORMAL, UNUSED) and re.search(rf"[^{MARK}]{MARK}", p) for p, _, kind in model.pieces):
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
        self.charsmap = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        place = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        self.instead: dict[int, list[int]] = {}
        if model.model_type == BPE:
            self.instead = {i: [place.get(x, unknown) for x in unmerged(model, model.pieces[i][0])] for i in model.ids_of(UNUSED)}
        self.peer = None
        if verify:
            import sentencepiece

            self.peer = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.parts = [self._bytes(p, kind) for p, _, kind in model.pieces]

    @staticmethod
    def _bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        return {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}.get(kind, piece.replace(MARK, " ").encode())

    def normalise(self, text: str) -> str:
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.model.remove_extra_whitespaces:
            text = re.sub(" +", " ", text.lstrip(" ").rstrip(f" {MARK}"))  # at the end the marker counts as a space
        return " " + text if text and self.model.add_dummy_prefix else text

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[bool | None]]:
        """Ids of each text, and whether the sentencepiece library gives the same (null where it wasn't asked)."""
        return self._encode(texts, [self.normalise(t) for t in texts])

    def _encode(self, texts: list[str], normal: list[str]) -> tuple[list[list[int]], list[bool | None]]:
        ready = [t.replace(" ", MARK) for t in normal]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(ready, add_special_tokens=False)]
        if self.instead:
            ids = [[y for x in some for y in self.instead.get(x, (x,))] for some in ids]
        same: list[bool | None] = [None] * len(texts)
        if self.peer is not None:
            same = [a == b for a, b in zip(ids, self.peer.encode(texts, num_threads=1), strict=True)]
        return ids, same

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.parts.__getitem__, ids))
        if self.model.add_dummy_prefix and text[:1] == b" ":
            text = text[1:]
        return text.decode("utf-8", "replace")


@lru_cache(maxsize=2)  # a Python worker keeps it from task to task
def load_codec(data: bytes) -> Codec:
    return Codec(data)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_crc32, decoded_sha256, round_trip, parity) and, if asked for, ids of each row of ``docs``.

    ``decoded_sha256`` is that of the text decoded from the ids, ``round_trip`` whether it is the text as the model
    normalises it, ``parity`` whether the sentencepiece library gives the same ids for the whole text. A null text counts as empty and has no ids.
    Repeated rows each get a row; an empty table gives none. Other columns aren't read. The model file (some 0.5 MB) is
    read by the driver and sent along.
    """
    from pathlib import Path

    sent = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # as large as the model file

    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids

    def run(batches):
        codec = load_codec(sent.value)
        for batch in batches:
            for some in slices(batch, 1):
                texts = [t or "" for t in some.column(1).to_pylist()]
                normal = [codec.normalise(t) for t in texts]
                ids, same = codec._encode(texts, normal)
                back = [codec.decode(x) for x in ids]
                skip = codec.model.add_dummy_prefix
                columns = [
                    some.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(array("I", x)) for x in ids], pa.int64()),  # 32-bit, in the machine's (little-endian) order
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                    pa.array([b == t.replace(MARK, " ")[skip and t != "" :] for b, t in zip(back, normal, strict=True)], pa.bool_()),
                    pa.array(same, pa.bool_()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))
        pa.default_memory_pool().release_unused()

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean, parity boolean" + ", ids array<int>" * with_ids
    return read.mapInArrow(run, schema).withColumnRenamed("id", id_col)
