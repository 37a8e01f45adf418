"""Deduplication operators against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import example, given, settings
from hypothesis import strategies as st

from quantloom.llm import components, line_dedup, simhash_dedup, sketch, substring_dedup, suffix_dedup

LAST = 2**63 - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def order(i):
    return LAST if i is None else i


# ---- substring dedup

def brute_windows(rows, n):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for a in range(len(w) - n + 1):
            key = tuple(w[a : a + n])
            first[key] = min(first.get(key, LAST), order(i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for a in range(len(w) - n + 1):
            if first[tuple(w[a : a + n])] < order(i):
                gone[a : a + n] = [True] * n
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return Counter(out)


@pytest.mark.parametrize("n", [13, 1, 4])
def test_windows_match_brute_force(docs, rows, n):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_windows(docs, n).collect())
    assert got == brute_windows(rows, n)


def test_windows_with_a_full_sketch_lose_nothing(docs, rows, monkeypatch):
    monkeypatch.setattr(sketch, "width_for", lambda n: 64)  # every cell is taken: everything goes to the exact pass
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_windows(docs).collect())
    assert got == brute_windows(rows, 13)


def test_windows_with_small_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 1)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_windows(docs).collect())
    assert got == brute_windows(rows, 13)


def test_windows_whose_hashes_all_collide_are_still_told_apart(docs, rows, monkeypatch):
    """Grouping is by a digest of the words, whatever the hashes of the sketch are."""
    real = substring_dedup.windows
    def collide(words, sizes, n):
        h, text, at = real(words, sizes, n)
        return np.zeros_like(h), text, at

    did, texts = np.array([order(i) for i, _ in rows]), [t for _, t in rows]
    batches = []
    monkeypatch.setattr(substring_dedup, "windows", collide)
    for batch in substring_dedup.candidate_rows(did, np.arange(len(texts), dtype=np.int32), texts, 4, lambda h: np.ones(len(h), bool)):
        batches += batch.to_pylist()
    gone = {(p >> 32, p & 0xFFFFFFFF) for b in batches if b["h1"] is None for p in [b["place"], *(b["more"] or [])]}
    first, want = {}, set()
    for i, t in rows:
        w = WORD.findall(t or "")
        for a in range(len(w) - 3):
            first[tuple(w[a : a + 4])] = min(first.get(tuple(w[a : a + 4]), LAST), order(i))
    for x, (i, t) in enumerate(rows):
        w = WORD.findall(t or "")
        want |= {(x, a) for a in range(len(w) - 3) if first[tuple(w[a : a + 4])] < order(i)}
    assert gone == want and want


def test_a_million_equal_words_are_one_row(spark):
    text = "la " * 1_000_000
    (batch,) = substring_dedup.candidate_rows(np.array([4]), np.array([1], np.int32), [text], 13, lambda h: np.ones(len(h), bool))
    assert batch.num_rows == 1 and len(batch.column("more")[0]) == 999_987
    docs = spark.createDataFrame([(1, "la " * 20), (2, text), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.dedup_windows(docs, with_text=False).collect()}
    assert got == {1: (20, 0), 2: (1_000_000, 1_000_000), 3: (0, 0), 4: (0, 0)}


def test_windows_of_no_documents(no_docs):
    assert substring_dedup.dedup_windows(no_docs).count() == 0


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(1, 17))
@example([0] * 5, 7)
@example([1] * 9, 11)
@example([], 1)
@example([3] * 16, 17)
def test_window_hash_depends_on_the_window_only(values, n):
    words = np.array(values, np.uint64)
    got = substring_dedup.window_hashes(words, n, 0x9FB21C651E98DF25)
    assert len(got) == max(0, len(values) - n + 1)
    for i in range(len(got)):
        assert got[i] == substring_dedup.window_hashes(words[i : i + n], n, 0x9FB21C651E98DF25)[0]


# ---- sketch

@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=200))
def test_cells_are_coded_reversibly(values):
    at, counts = np.unique(np.array(values, np.uint64), return_counts=True)
    back, n = sketch._decode(sketch._encode(at, counts))
    assert back.tolist() == at.tolist() and n.tolist() == counts.tolist()


def test_sketch_never_underestimates(spark):
    r = random.Random(1)
    values = [r.randrange(300) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
    mixed = lambda v: sketch.mix(np.asarray(v).astype(np.uint64))
    bits = sketch.merged_sketch(df, lambda batches: (mixed(b.column(0).to_numpy()) for b in batches), 5000, (2, 8))
    for level, packed in zip((2, 8), bits):
        counts = Counter(values)
        known = sorted(counts)
        reached = sketch.reached(packed, mixed(known), 5000)
        assert all(yes for v, yes in zip(known, reached) if counts[v] >= level)
        assert sum(bool(yes) for v, yes in zip(known, reached) if counts[v] < level) <= 0.1 * len(known) + 3


# ---- byte substrings

def brute_bytes(rows, n):
    def rank(row):  # rows with one id in the order of a hash of their texts, as documented
        return order(row[0]), row[2]

    seen, result = {}, {}
    distinct = sorted({(i, t, k) for i, t, k in rows}, key=lambda x: rank((x[0], x[1], x[2])))
    for i, t, k in distinct:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for a in range(len(data) - n + 1):
            s = data[a : a + n]
            if s in seen:
                gone[a] += 1
                gone[a + n] -= 1
            seen.setdefault(s, (i, a))
        mask = gone.cumsum()[: len(data)] > 0
        kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        result[i, t] = (i, len(data), int(mask.sum()), spans, sha(kept))
    return Counter(result[i, t] for i, t, _ in rows)


@pytest.mark.parametrize(("n", "hot"), [(100, 4096), (100, 2), (40, 4096)])
def test_bytes_match_brute_force(spark, docs, n, hot):
    keyed = {(None if r.did == LAST else r.did, r.text): r.k for r in substring_dedup.keyed(docs, "doc_id", "text").collect()}
    rows = [(r.doc_id, r.text, keyed[r.doc_id, r.text]) for r in docs.collect()]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup_bytes(docs, n, hot=hot).collect())
    assert got == brute_bytes(rows, n)


def test_bytes_of_no_documents(no_docs):
    assert suffix_dedup.dedup_bytes(no_docs).count() == 0


def rotations(shard, depth):
    data = bytes(shard)
    return [(data * (depth // len(data) + 2))[i : i + depth] for i in range(len(data))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=5), st.sampled_from([7, 8, 20, 40]))
def test_merged_shards_are_in_order_with_true_prefixes(texts, depth):
    shards = [np.frombuffer(t, np.uint8) for t in texts]
    places, lcp = suffix_dedup.merge_shards(shards, depth, exact=True)
    all_rotations = [x for s in shards for x in rotations(s, depth)]
    got = [all_rotations[p] for p in places]
    assert sorted(places.tolist()) == list(range(len(all_rotations)))
    assert got == sorted(all_rotations)
    rough = suffix_dedup.merge_shards(shards, depth)[1]
    for i in range(1, len(got)):
        common = next((k for k, (a, b) in enumerate(zip(got[i - 1], got[i])) if a != b), depth)
        assert lcp[i] == common and rough[i] <= common and (rough[i] == depth) == (common == depth)


def test_merged_shards_of_many_grams():
    r = np.random.default_rng(3)
    shards = [r.integers(0, 256, 60_000).astype(np.uint8) for _ in range(3)]
    shards[2][:500] = shards[0][100:600]
    places, lcp = suffix_dedup.merge_shards(shards, 100)
    interval = np.empty(len(places), int)
    interval[places] = (lcp < 100).cumsum()
    assert (interval[120_000:120_401] == interval[100:501]).all()
    assert interval[120_401] != interval[501]


def test_every_removed_window_comes_from_an_interval(spark, docs, monkeypatch):
    """With the merged transforms' intervals gone, nothing else removes a window."""
    rows = substring_dedup.keyed(docs, "doc_id", "text").collect()
    seen, calls = [], []
    real = suffix_dedup.repeated_runs

    def watched(texts, counts, length):
        calls.append(sum(map(len, texts)))
        found = real(texts, counts, length)
        seen.append(found)
        return found

    def runs():
        batch = suffix_dedup.block_pieces(np.array([r.did for r in rows]), np.array([r.k for r in rows], np.int32), [(r.text or "").encode() for r in rows], 100)
        ordered = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in ("key", "did", "k", "start")])
        return sum(sum(b.column("n").to_pylist()) for b in suffix_dedup.merged_runs(iter(ordered.to_batches(max_chunksize=50)), 100))

    monkeypatch.setattr(suffix_dedup, "repeated_runs", watched)
    assert runs() > 0 and calls
    none = np.zeros(0, np.int64)
    monkeypatch.setattr(suffix_dedup, "repeated_runs", lambda *_: ((none, none, none), (none, none, none)))
    assert runs() == 0


def test_frequent_pieces_are_merged_in_parts(spark, monkeypatch):
    text = "a passage of more than one hundred bytes that stands in very many documents, word for word, with nothing around it at all"
    data = [(i, text + (" and a tail" if i % 50 == 7 else "")) for i in range(400)] + [(0, text), (5, text), (400, "z" * 4000), (401, "z" * 150 + text)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "MERGE_OCCURRENCES", 40)
    monkeypatch.setattr(suffix_dedup, "MERGE_BYTES", 300)
    keyed = {(r.did, r.text): r.k for r in substring_dedup.keyed(docs, "doc_id", "text").collect()}
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup_bytes(docs).collect())
    assert got == brute_bytes([(i, t, keyed[i, t]) for i, t in data], 100)


def test_a_text_of_megabytes(spark):
    r = random.Random(9)
    body = "".join(r.choice("abcdefgh \n") for _ in range(3_000_000))
    docs = spark.createDataFrame([(1, body), (2, "x" * 2_000_000), (3, body[1_000_000:1_000_500] + "tail"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.dedup_bytes(docs, with_text=False).collect()}
    assert got == {1: (3_000_000, 0), 2: (2_000_000, 1_999_999), 3: (504, 500), 4: (0, 0)}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab c", min_size=0, max_size=90), max_size=6), st.integers(36, 60).map(lambda n: n // 4 * 4))
def test_pieces_cover_every_window_once(texts, n):
    data = [t.encode() for t in texts]
    seen = Counter()
    for anchors, text, start, count in suffix_dedup.text_pieces(data, n):
        for t, s, m in zip(text.tolist(), start.tolist(), count.tolist()):
            seen.update((t, s + j) for j in range(m))
    assert seen == Counter((i, s) for i, t in enumerate(data) for s in range(len(t) - n + 1))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=150), max_size=5), st.integers(36, 80))
def test_only_windows_that_occur_once_are_left_out(texts, n):
    data = [t.encode() for t in texts]
    sampled = Counter(h for part in suffix_dedup.sampled_anchors(data, n) for h in part.tolist())
    repeats = lambda hashes: np.array([sampled[h] > 1 for h in hashes.tolist()], bool)
    kept = {(i, s + j) for _, text, start, count in suffix_dedup.text_pieces(data, n, repeats) for i, s, m in zip(text.tolist(), start.tolist(), count.tolist()) for j in range(m)}
    windows = Counter(t[s : s + n] for t in data for s in range(len(t) - n + 1))
    assert {(i, s) for i, t in enumerate(data) for s in range(len(t) - n + 1) if windows[t[s : s + n]] > 1} <= kept


def test_long_texts_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 900)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 500)
    r = random.Random(4)
    data = [bytes(r.randrange(97, 100) for _ in range(m)) for m in (50, 3000, 200, 901, 800, 100)]
    seen = Counter((i, s + j) for _, text, start, count in suffix_dedup.text_pieces(data, 100) for i, s, m in zip(text.tolist(), start.tolist(), count.tolist()) for j in range(m))
    assert seen == Counter((i, s) for i, t in enumerate(data) for s in range(len(t) - 99))


# ---- near copies

def brute_fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize(("shard_nodes", "tree_nodes", "sent"), [(1 << 15, 1 << 12, 1 << 26), (2, 1 << 12, 0), (2, 4, 1 << 26), (1 << 15, 2, 0)])
def test_simhash_components_match_brute_force(docs, rows, shard_nodes, tree_nodes, sent, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "BROADCAST_BYTES", sent)
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps, 2)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, LAST), i)
    want = Counter((i, f, least.get(c)) for (i, _), f, c in zip(rows, fps, comp))
    got = simhash_dedup.simhash_components(docs, shard_nodes=shard_nodes, tree_nodes=tree_nodes).collect()
    assert Counter((r.doc_id, r.fp & (2**64 - 1), r.component) for r in got) == want


def test_simhash_keeps_one_document_of_a_group(docs, rows, no_docs):
    kept = simhash_dedup.dedup_simhash(docs)
    assert kept.columns == docs.columns
    comp = {r.doc_id: r.component for r in simhash_dedup.simhash_components(docs).collect() if r.doc_id is not None}
    assert {r.doc_id for r in kept.collect()} == {c for c in comp.values()}
    assert simhash_dedup.simhash_components(no_docs).count() == 0 and simhash_dedup.dedup_simhash(no_docs).count() == 0


@pytest.mark.parametrize(("radius", "shard_nodes", "tree_nodes"), [(2, 1 << 15, 1 << 12), (2, 25, 1 << 12), (3, 1 << 15, 50), (2, 10, 20), (0, 1 << 15, 64)])
def test_links_of_dense_fingerprints(spark, radius, shard_nodes, tree_nodes):
    r = random.Random(5)
    centers = [r.getrandbits(64) for _ in range(12)]
    values = set()
    while len(values) < 700:
        x = r.choice(centers)
        for _ in range(r.randint(0, 6)):
            x ^= 1 << r.randrange(64)
        values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, shard_nodes, tree_nodes)
    root = {r.node: r.root for r in components.connected_components(edges).collect()}
    groups = {}
    for v, c in zip(signed, brute_components(values, radius)):
        groups.setdefault(c, []).append(v)
    for members in groups.values():
        assert {root.get(v, v) for v in members} == {min(members)}


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.integers(0, 5))
def test_tree_finds_all_within_the_radius(values, radius):
    values = np.array(sorted(values), np.uint64)
    near = values ^ np.uint64(5)
    asked, nodes = simhash_dedup.BKTree(values).search(near, radius)
    want = {(i, j) for i, a in enumerate(near.tolist()) for j, b in enumerate(values.tolist()) if (a ^ b).bit_count() <= radius}
    assert set(zip(asked.tolist(), nodes.tolist())) == want


def test_trees_are_large_and_only_near_edges_are_followed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    distinct = simhash_dedup.fingerprints(docs).select("fp").distinct().cache()
    trees = [r.tree for r in simhash_dedup.plant_trees(distinct, 2).collect()]
    sizes = [len(t) // 13 for t in trees]
    assert sum(sizes) == (3 if len(sizes) > 1 else 1) * distinct.count() and max(sizes) > 1000 and sorted(sizes)[len(sizes) // 2] > 1000
    tree = simhash_dedup.BKTree.from_bytes(max(trees, key=len))
    queries, visited = tree.values[:200], []
    asked, nodes = tree.search(queries, 2, visited)
    assert set(zip(asked.tolist(), nodes.tolist())) == {(i, j) for i, q in enumerate(queries.tolist()) for j, v in enumerate(tree.values.tolist()) if (q ^ v).bit_count() <= 2}
    steps = 0
    for at, looked in visited[1:]:
        parents = tree.parent[looked]
        apart = np.abs(np.bitwise_count(queries[at] ^ tree.values[parents]).astype(int) - tree.distance[looked].astype(int))
        assert apart.max(initial=0) <= 2
        steps += len(at)
    assert steps < 0.25 * len(queries) * len(tree.values)
    distinct.unpersist()


def test_components_of_chains_loops_and_nothing(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (7, 6), (201, 200), (200, 202)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {200: 200, 201: 200, 202: 200}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- lines

def test_lines_match_brute_force(docs, rows):
    def key(i, t):
        return order(i), line_key(i, t)

    def line_key(i, t):
        return f"{'null' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}"

    first = {}
    for i, t in rows:
        x = (t or "").split("\n")
        for a in range(len(x) - 2):
            s = "\n".join(x[a : a + 3])
            if WORD.search(s):
                first[s] = min(first.get(s, ((LAST + 1, ""), 0)), (key(i, t), a))
    want = Counter()
    for i, t in rows:
        x = (t or "").split("\n")
        gone = set()
        for a in range(len(x) - 2):
            s = "\n".join(x[a : a + 3])
            if WORD.search(s) and first[s] != (key(i, t), a):
                gone |= {a, a + 1, a + 2}
        want[i, t, len(x), tuple(sorted(gone)), "\n".join(y for j, y in enumerate(x) if j not in gone) if gone else t] += 1
    got = Counter((r.doc_id, r.text, r["__n_lines"], tuple(r["__removed"]), r["__kept"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == want


def test_replaced_texts_keep_columns(docs, no_docs):
    assert line_dedup.replace_texts(docs).columns == docs.columns
    assert line_dedup.replace_texts(no_docs).count() == 0


def test_columns_named_like_the_results_do_no_harm(spark):
    text = "one\ntwo\nthree\nfour"
    data = [(1, text, "k", 5, "r", 3, "g"), (2, text + "\nfive", "k", 6, "r", 3, "g"), (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, __kept string, __n_lines long, __removed string, n_chars long, doc string")
    kept = line_dedup.replace_texts(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter([data[0], (2, "five", "k", 6, "r", 4, "g"), data[2]])
    assert {r.doc_id: list(r["__removed"]) for r in line_dedup.dedup_lines(docs).collect()} == {1: [], 2: [0, 1, 2, 3], None: []}


def test_a_long_text_that_loses_most_of_its_lines(spark):
    docs = spark.createDataFrame([(1, "\n".join(f"line {i % 40_000}" for i in range(200_000)))], "doc_id long, text string")
    row = line_dedup.dedup_lines(docs).first()
    # a window over the seam of two rounds is new once, later ones cover all of the rest
    assert row["__n_lines"] == 200_000
    assert list(row["__removed"]) == list(range(40_000, 200_000))
    assert row["__kept"] == "\n".join(f"line {i}" for i in range(40_000))
