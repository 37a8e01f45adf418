"""Hard negatives against brute force over all rows."""

import itertools
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quantloom.llm import hard_negatives as mining
from quantloom.llm import oracles, queries

SF = "/root/testdata/sf0.001"
LAST = mining.LAST_ID
SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, block string, key string, chunk string"


def brute(rows, every=50, positives=5, negatives=3):
    good = [(LAST if i is None else i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, y in {(i, tuple(v), y) for i, v, y in good if i != LAST and i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z == y) for j, w, z in good if j != i)
        for ps, p, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(i, None if p == LAST else p, r + 1, None if n == LAST else n, -ps, -ns) for r, (ns, n, _) in enumerate(fits[:negatives])]
    return sorted(out, key=str)


def vectors(n, centres, seed=1):
    """Clusters of vectors of six dimensions, with every awkward case."""
    r = random.Random(seed)
    middle = [[r.gauss(0, 1) for _ in range(6)] for _ in range(centres)]
    rows = [(i, [x + r.gauss(0, 0.1) for x in middle[r.randrange(centres)]], r.randrange(4)) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [0.5] * 6, None), (n + 2, [0.5, None, 0.1, 0.1, 0.1, 0.1], 1), (n + 3, [0.5, float("nan"), 0.1, 0.1, 0.1, 0.1], 1), (n + 4, [float("inf")] * 6, 2)]
    rows += [(None, [0.4] * 6, 1), (None, [0.4] * 6, 2), (n + 5, [], 1), (n + 6, [1.0], 2), (-50, [0.3] * 6, 1), (7, [0.3] * 6, 9), rows[3], rows[3], rows[0], rows[50], (50, [0.9] * 6, 2)]
    rows += [(10_000 + i, [0.25] * 6, i % 3) for i in range(60)]  # one vector many times
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "q", "b", "k", "c") for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize(("block", "chunk", "group", "per_task", "centres", "size"), [(512, 1024, 2048, 64, 9, 64 << 20), (7, 3, 5, 4, 9, 64 << 20), (4, 2, 3, 2, 60, 0), (1, 1, 1, 1, 5, 0)])
def test_negatives_match_brute_force(spark, monkeypatch, block, chunk, group, per_task, centres, size):
    """Also with blocks, chunks and groups of a few rows, and with zone maps that go by the shuffle."""
    for name, value in (("BLOCK", block), ("CHUNK", chunk), ("GROUP", group), ("BLOCKS_PER_TASK", per_task), ("BROADCAST_BYTES", size)):
        monkeypatch.setattr(mining, name, value)
    rows = vectors(80 if block == 1 else 420, centres)
    got = mining.hard_negatives(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_clustered_vectors_leave_blocks_out():
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (20, 16))
    q = np.floor(256 * np.concatenate([c + r.normal(0, 0.05, (100, 16)) for c in centres])).astype(np.int64)
    most = int(np.abs(q).max())
    keys = mining.hilbert_keys(((q + most) << mining.CURVE_BITS) // (2 * most + 1), mining.CURVE_BITS)
    q = q[np.lexsort(keys.T[::-1])]
    blocks = q.reshape(-1, 20, 16)
    least, upper = mining.block_bounds(q.astype(float), blocks.min(axis=1).astype(float), blocks.max(axis=1).astype(float))
    scores = q @ q.T
    by_block = scores.reshape(len(q), -1, 20)
    assert (least <= by_block.min(axis=2)).all() and (by_block.max(axis=2) <= upper).all()
    tenth = np.sort(scores, axis=1)[:, -10]
    assert (upper >= tenth[:, None]).mean() < 0.35


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 3), (3, 2), (5, 1), (2, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    """The keys number all cells, and each step changes one coordinate by one."""
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [int.from_bytes(k.tobytes()) >> (-dims * bits % 8) for k in mining.hilbert_keys(points, bits)]
    assert sorted(keys) == list(range(1 << bits * dims))
    ordered = points[np.argsort(keys)]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=30)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=12), st.lists(st.integers(-300, 300), min_size=3, max_size=3))
def test_bounds_hold(rows, anchor):
    q, a = np.array(rows, float), np.array([anchor], float)
    least, most = mining.block_bounds(a, q.min(axis=0)[None], q.max(axis=0)[None])
    assert least[0, 0] <= (q @ a[0]).min() and (q @ a[0]).max() <= most[0, 0]


def test_empty_tables_and_tables_without_anchors(spark):
    assert mining.hard_negatives(frame(spark, [])).count() == 0
    assert mining.hard_negatives(frame(spark, [(3, [1.0], 1), (4, [1.0], 2)])).count() == 0
    assert mining.hard_negatives(frame(spark, [(50, [], 1), (4, [], 1), (3, [], 2)])).collect() == [(50, 4, 1, 3, 0, 0)]
    with pytest.raises(ValueError, match="exactly"):
        mining.hard_negatives(frame(spark, [(50, [3e38], 1)]))


def test_the_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(oracles.OP12).fetchall()
    assert sorted(map(tuple, queries.op12_hard_negatives(spark, SF).collect())) == sorted(want) and want
