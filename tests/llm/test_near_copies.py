"""The pipeline's near-dedup against brute force over all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from quantloom.llm import components, jaccard_join, near_copies
from quantloom.llm.simhash_dedup import majority
from tests.llm.test_dedup import LAST, WORD


def brute_sets(texts):
    out = []
    for t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_groups(texts):
    sets = brute_sets(texts)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 10 * len(a & b) >= 8 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def edited(r, base, n):
    words = list(base)
    for k in r.sample(range(len(words) // 10), n):
        words[10 * k + 5] = f"new{r.random()}"
    return " ".join(words)


def near_rows():
    """Chains of copies around the limit, and texts that share half."""
    r = random.Random(3)
    rows = []
    for _ in range(12):
        base = [f"w{r.randrange(400)}" for _ in range(300)]
        for n in (0, 2, 4, 6, 7, 9, 20):
            rows.append((len(rows), edited(r, base, n)))
    return rows


def test_components_match_brute_force(docs, rows, no_docs):
    group = brute_groups([t for _, t in rows])
    least = {}
    for (i, _), c in zip(rows, group, strict=True):
        if i is not None:
            least[c] = min(least.get(c, LAST), i)
    want = Counter((i, least.get(c)) for (i, _), c in zip(rows, group, strict=True))
    assert Counter(map(tuple, near_copies.near_components(docs).collect())) == want
    assert near_copies.dedup_near_copies(docs).columns == docs.columns and near_copies.dedup_near_copies(no_docs).count() == 0


@pytest.mark.parametrize(("nodes", "asking"), [(1 << 12, 1 << 14), (3, 1 << 14), (2, 2)])
def test_the_stage_finds_pairs_of_similarity_08(spark, monkeypatch, nodes, asking):
    """Also where a shard has several trees, and those that ask are dealt over tasks."""
    monkeypatch.setattr(near_copies, "TREE_NODES", nodes)
    monkeypatch.setattr(near_copies, "ASKING", asking)
    rows = near_rows()
    group = brute_groups([t for _, t in rows])
    kept = corpus_pipeline.one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == {i for i, c in enumerate(group) if i == c}
    assert len(rows) > len(set(group)) > 12  # some are linked, not all


def test_trees_give_every_pair_that_is_apart_once(spark, monkeypatch):
    """Members of one shard in several components, against all pairs; nodes and askers in several cells."""
    monkeypatch.setattr(near_copies, "TREE_NODES", 7)
    monkeypatch.setattr(near_copies, "ASKING", 5)
    r = random.Random(11)
    bases = [r.getrandbits(64) for _ in range(3)]
    rows = []
    for cls in range(60):
        fp = bases[cls % 3]
        for bit in r.sample(range(64), r.randrange(14)):
            fp ^= 1 << bit
        rows.append((5, cls, fp - (1 << 64) if fp >> 63 else fp, r.choice((80, 100, 110)), cls // 7, 2))
    got = near_copies._dealt(spark.createDataFrame(rows, "key long, cls long, fp long, n long, comp long, main long")).collect()
    want = {
        (x[1], y[1]) for x in rows for y in rows
        if x[1] < y[1] and x[4] != y[4] and ((x[2] ^ y[2]) & (2**64 - 1)).bit_count() <= near_copies.RADIUS and 10 * min(x[3], y[3]) >= 8 * max(x[3], y[3])
    }
    assert want and Counter(map(tuple, got)) == Counter(want)


def test_a_large_group_of_copies_takes_pairs_in_proportion_to_its_size(spark, monkeypatch):
    """2,000 edits of one text: one component, and no more pairs are compared than a few for each text."""
    r = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, edited(r, base, i % 3)) for i in range(2000)]
    compared = []
    links = jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda pairs, sets: (compared.append(pairs.count()), links(pairs, sets))[1])
    kept = near_copies.dedup_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert [r.doc_id for r in kept.collect()] == [0]
    assert sum(compared) <= 3 * len(rows)


def test_links_hold_where_blocks_deal_the_texts_and_just_outside_a_group_no_sets_are_compared(spark, monkeypatch):
    """600 edits of one text, a third of them too far from it to link, under blocks of 6 bits: components are those of all pairs."""
    monkeypatch.setattr(near_copies, "SHARD", 10)
    monkeypatch.setattr(near_copies, "FIRST_NODES", 50)
    r = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    rows = [(i, edited(r, base, (1, 2, 7)[i % 3])) for i in range(600)]
    compared = []
    links = jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda pairs, sets: (compared.append(pairs.count()), links(pairs, sets))[1])
    found = near_copies.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.component for r in found} == dict(enumerate(brute_groups([t for _, t in rows])))
    assert sum(compared) <= 4 * len(rows)


def test_shards_are_dealt_by_blocks_of_the_fingerprints():
    """Of pairs at the limit of similarity all but a few share a block, and the first fingerprint is that of the SimHash operator."""
    r = np.random.default_rng(4)
    bits, blocks = near_copies.blocks_for(1 << 18)
    assert near_copies.blocks_for(near_copies.SHARD) == (0, 1) and bits == 10 and blocks >= 32
    apart = 0
    for _ in range(300):
        common, a, b = (near_copies.mixed(r.integers(0, 1 << 62, n, np.uint64)) for n in (240, 30, 30))
        words = np.stack([near_copies.fingerprints(np.concatenate([common, own])) for own in (a, b)])
        assert words[0, 0] == majority(np.concatenate([common, a]))
        x, y = near_copies.block_keys(words, bits, blocks)
        apart += not (x == y).any()
    assert apart <= 3


def test_small_tables_are_in_few_tasks_however_many_partitions_a_shuffle_has(spark, monkeypatch):
    """Every task writes files for each shuffle: with hundreds of partitions for some rows these took the disk."""
    tasks = []
    cut = components.cut
    monkeypatch.setattr(components, "cut", lambda df: (done := cut(df), tasks.append(done.rdd.getNumPartitions()))[0])
    asked = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in asked}
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 10 != 9], "u long, v long")
        found = components.connected_components(edges).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.root for r in found} == {i: i // 10 * 10 for i in range(300)}
    assert len(tasks) > 2 and max(tasks[1:]) <= 12
