"""Token files and the SentencePiece codec against the libraries, and the pipeline against brute force."""

import hashlib
import heapq
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quantloom.llm import sentencepiece_codec, text_batches, token_files
from quantloom.llm.common import work_path
from quantloom.llm.queries import tokenizer_path

ALPHABET = st.sampled_from(["a", "The", " ", " ", "  ", ".", ",", "\n", "\n\n", "'s", "7", "é", "_", "中", "½", "\t", "\x1c", "\x85", "▁", "<|endoftext|>", "🎉", "</s>"])
TEXTS = st.lists(ALPHABET, max_size=30).map("".join)


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


# ---- the code

def huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=300), st.integers(9, 20))
def test_code_lengths_are_limited_valid_and_best(counts, most):
    counts = np.array(counts)
    lengths = token_files.code_lengths(counts, most).astype(int)
    used = int((counts > 0).sum())
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max(initial=0) <= most
    assert sum(2.0 ** -lengths[lengths > 0]) <= 1
    if used > 1 and most == 20:
        assert int((lengths * counts).sum()) == huffman_cost(counts)


def test_steep_counts_reach_the_limit():
    counts = np.array([1 << k for k in range(40)])
    lengths = token_files.code_lengths(counts)
    assert lengths.max() == token_files.MAX_BITS and sum(2.0 ** -lengths.astype(float)) == 1


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 1500), st.integers(1, 400), st.integers(0, 5))
def test_blocks_decode_on_their_own(n, kinds, seed):
    ids = np.minimum(np.random.default_rng(seed).zipf(1.4, n), kinds).astype(np.uint32)
    lengths = token_files.code_lengths(np.bincount(ids))
    payload, checkpoints = token_files.pack(ids, token_files.canonical(lengths)[0], lengths)
    assert token_files.unpack(payload, checkpoints, n, token_files.decode_table(lengths)).tolist() == ids.tolist()
    assert len(payload) == -(-int(lengths[ids].sum()) // 8) and len(checkpoints) == 8 * -(-n // token_files.CHECKPOINT)


# ---- files

def test_files_hold_every_id_in_order(spark, docs, rows, bpe, monkeypatch):
    path = work_path(spark, "test")
    token_files.write_token_files(docs, path, tokenizer_path("byte_bpe_50k.json"), 2)
    got = token_files.read_token_files(spark, path).collect()
    assert spark.read.parquet(f"{path}/blocks").columns == ["part", "block", "start", "doc_ids", "has_id", "n_tokens", "payload", "checkpoints"]
    want, start = [], 0
    hashed = dict(docs.select("text", F.xxhash64("text")).distinct().collect())
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, hashed[x[1]], x[1] is not None, (x[1] or "").encode())):
        ids = [*bpe.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), tuple(ids)))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, tuple(r["ids"])) for r in sorted(got, key=lambda r: r.start)] == want


def test_texts_of_megabytes_and_one_id_for_all(spark, bpe):
    texts = ["word " * 400_000, "", None, "é" * 100_000, "two"]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(3, t) for t in texts], "doc_id long, text string").repartition(3)
    path = work_path(spark, "test")
    token_files.write_token_files(docs, path, tokenizer_path("byte_bpe_50k.json"), 2)
    got = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, path, with_ids=False).collect())
    ids = [[*bpe.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert got == Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i in (None, 3) for x in ids)


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(text_batches, "BATCH_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4, 5], "text": ["12345", None, "1234567890123", "", "12"]})
    assert [s.column(0).to_pylist() for s in text_batches.slices(batch, 1)] == [[1, 2], [3], [4, 5]]


def test_files_of_no_documents(spark, no_docs):
    path = work_path(spark, "test")
    token_files.write_token_files(no_docs, path, tokenizer_path("byte_bpe_50k.json"), 2)
    assert token_files.read_token_files(spark, path).count() == 0


# ---- SentencePiece

@pytest.fixture(scope="module")
def model():
    data = open(tokenizer_path("piece_bpe_32k.model"), "rb").read()
    return sentencepiece_codec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)


def test_model_file_is_parsed(model):
    codec, peer = model
    assert [p[0] for p in codec.model.pieces] == [peer.id_to_piece(i) for i in range(peer.get_piece_size())]
    assert codec.model.model_type == sentencepiece_codec.BPE and codec.model.byte_fallback and not codec.model.remove_extra_whitespaces


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_ids_and_texts_equal_the_library(texts):
    if not hasattr(test_ids_and_texts_equal_the_library, "m"):
        data = open(tokenizer_path("piece_bpe_32k.model"), "rb").read()
        test_ids_and_texts_equal_the_library.m = sentencepiece_codec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    codec, peer = test_ids_and_texts_equal_the_library.m
    ids, same = codec.encode(texts)
    assert ids == peer.encode(texts)
    assert [codec.decode(x) for x in ids] == [peer.decode(x) for x in ids] and all(same)


def test_texts_that_differ_are_marked():
    codec = sentencepiece_codec.Codec(open(tokenizer_path("piece_bpe_32k.model"), "rb").read())
    codec.peer = type("Peer", (), {"encode": staticmethod(lambda texts, num_threads: [[1] for _ in texts])})
    assert codec.encode(["an odd one", ""])[1] == [False, False]
    codec.peer = None
    assert codec.encode(["not asked"])[1] == [None]


def tag(number, wire):
    return bytes([number << 3 | wire]) if number < 16 else bytes([(number << 3 | wire) & 127 | 128, number >> 4])


def model_file(pieces, byte_fallback, kind=1, dummy_prefix=True, one_space=False):
    out = b""
    for text, score, sort in pieces:
        raw = text.encode()
        body = tag(1, 2) + bytes([len(raw)]) + raw + tag(2, 5) + struct.pack("<f", score) + tag(3, 0) + bytes([sort])
        out += tag(1, 2) + bytes([len(body)]) + body
    trainer = tag(3, 0) + bytes([kind]) + tag(35, 0) + bytes([byte_fallback])
    normal = tag(1, 2) + b"\x08identity" + tag(3, 0) + bytes([dummy_prefix]) + tag(4, 0) + bytes([one_space]) + tag(5, 0) + b"\x01"
    return out + tag(2, 2) + bytes([len(trainer)]) + trainer + tag(3, 2) + bytes([len(normal)]) + normal


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_unigram_models_equal_the_library(byte_fallback):
    k = sentencepiece_codec
    pieces = [("<unk>", 0.0, k.UNKNOWN), ("<s>", 0.0, k.CONTROL), ("</s>", 0.0, k.CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, k.BYTE) for b in range(256)] * byte_fallback
    pieces += [(p, s, k.NORMAL) for p, s in [("▁", -3.0), ("▁a", -2.0), ("a", -4.0), ("b", -4.1), ("ab", -3.5), ("▁ab", -2.5), ("ba", -3.2), ("bab", -5.0), ("c", -6.0)]]
    data = model_file(pieces, byte_fallback)
    codec, peer = k.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["", "a", "abab ab", "ab  ba", "cab aba bab", "babab a c", " a ", "abcabc ba"] + ["xé a"] * byte_fallback
    ids, same = codec.encode(texts)
    assert ids == peer.encode(texts) and all(same)
    assert [codec.decode(x) for x in ids] == [peer.decode(x) for x in ids]


@pytest.mark.parametrize("dummy_prefix", [True, False])
@pytest.mark.parametrize("one_space", [True, False])
@pytest.mark.parametrize("kind", [sentencepiece_codec.UNIGRAM, sentencepiece_codec.BPE])
def test_unused_and_user_pieces(kind, dummy_prefix, one_space):
    """Unused pieces never come out and user pieces are never joined; where the library still differs, parity says so."""
    k = sentencepiece_codec
    pieces = [("<unk>", 0.0, k.UNKNOWN), ("<s>", 0.0, k.CONTROL), ("[u]", 0.0, k.USER), ("aab", -0.5, k.UNUSED), ("aa", -1.0, k.UNUSED)]
    pieces += [(p, -float(i + 2), k.NORMAL) for i, p in enumerate(["ab", "▁a", "▁", "bb", "a", "b", "[", "u", "]", "▁▁", "c"])]
    codec = k.Codec(model_file(pieces, False, kind, dummy_prefix, one_space))
    peer = sentencepiece.SentencePieceProcessor(model_proto=model_file(pieces, False, kind, dummy_prefix, one_space))
    texts = ["aa", "aab", "a aab aa", "[u]a", "a[u]b", "b [u]", "[u][u] ab", "aabb baab", "<s>a", "a  b", " aa ", "", "▁a ▁", "caac"]
    ids, same = codec.encode(texts)
    want = peer.encode(texts)
    assert same == [a == b for a, b in zip(ids, want)]
    assert not {3, 4} & {x for a in ids for x in a} and all(same), [(t, a, b) for t, a, b in zip(texts, ids, want) if a != b]


def test_documents_are_encoded(spark, docs, rows, model):
    _, peer = model
    got = Counter((r.doc_id, r.n_tokens, r.ids_crc32, r.decoded_sha256, r.round_trip, r.parity) for r in sentencepiece_codec.encode_documents(docs, tokenizer_path("piece_bpe_32k.model")).collect())
    want = Counter()
    for i, t in rows:
        ids = peer.encode(t or "")
        back = peer.decode(ids)
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == (t or ""), True] += 1
    assert got == want


def test_no_documents(no_docs):
    assert sentencepiece_codec.encode_documents(no_docs, tokenizer_path("piece_bpe_32k.model"), with_ids=True).count() == 0


# ---- the pipeline

def test_pipeline_matches_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_near_copies import brute_groups
    from tests.llm.test_text import NORMAL, WORD, brute_keeps, lower

    source = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{source}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()]
    # 1: quality rules
    docs = {i: t for i, t in docs.items() if brute_keeps(t)}
    # 2: later three-line windows
    first, texts = set(), {}
    for i in sorted(docs):
        x, gone = docs[i].split("\n"), set()
        for a in range(len(x) - 2):
            s = tuple(x[a : a + 3])
            if WORD.search("\n".join(s)):
                if s in first:
                    gone |= {a, a + 1, a + 2}
                first.add(s)
        texts[i] = "\n".join(y for j, y in enumerate(x) if j not in gone)
    docs = {i: t for i, t in texts.items() if WORD.search(t)}
    # 3: one of each group
    ids = sorted(docs)
    comp = brute_groups([docs[i] for i in ids])
    docs = {i: docs[i] for k, i in enumerate(ids) if comp[k] == k}
    # 4: benchmark windows
    windows = set()
    for t in items:
        w = NORMAL.findall(lower(t))
        windows |= {tuple(w[a : a + min(10, len(w))]) for a in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    def leaks(t):
        w = NORMAL.findall(lower(t))
        return any(tuple(w[a : a + n]) in windows for n in sizes for a in range(len(w) - n + 1))

    docs = {i: t for i, t in docs.items() if not leaks(t)}
    # 5: ids
    peer = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = {i: (len(x := peer.encode(t)), zlib.crc32(np.array(x, "<u4").tobytes()), hashlib.sha256(t.encode()).hexdigest(), True, True) for i, t in docs.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_crc32, r.decoded_sha256, r.round_trip, r.parity) for r in corpus_pipeline.run(spark, source).collect()}
    assert got == want and 0 < len(got)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece"]
