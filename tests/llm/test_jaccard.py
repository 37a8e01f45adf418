"""The similarity join against all pairs."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from quantloom.llm import jaccard_join, oracles, queries
from tests.llm.test_near_copies import brute_groups, brute_sets, edited

SF = "/root/testdata/sf0.001"


def near_rows():
    """Groups of edited copies around the limit, chains of them, texts with one common passage, short texts."""
    r = random.Random(11)
    texts = []
    passage = [f"p{k}" for k in range(60)]
    for g in range(14):
        base = [f"w{r.randrange(300)}" for _ in range(r.choice([40, 150, 400]))]
        if g % 3 == 0:
            base += passage
        for n in range(r.choice([4, 9])):
            texts.append(edited(r, base, min(len(base) // 12, n)))
            chain = texts[-1].split()
            for step in range(3):
                chain = edited(r, chain, 1).split()
                texts.append(" ".join(chain[step:]))
    texts += [" ".join(passage)] * 3 + ["a", "A", "a b", "b a", "a b c d", "A b\tc d", "a b c d e", "x " * 40, "x " * 400, "", " ", None]
    return list(enumerate(texts))


def want(rows):
    sets = brute_sets([t for _, t in rows])
    group = brute_groups([t for _, t in rows])
    least = {}
    for (i, _), c in zip(rows, group, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return Counter((i, len(s), least.get(c) if s else i) for (i, _), s, c in zip(rows, sets, group, strict=True))


@pytest.mark.parametrize("width", [None, 64])
def test_components_match_brute_force(docs, rows, monkeypatch, width):
    """Also with a full sketch, so that the order is by hash alone."""
    if width:
        monkeypatch.setattr(jaccard_join, "MAX_WIDTH", width)
    assert Counter(map(tuple, jaccard_join.jaccard_components(docs).collect())) == want(rows)


def test_links_and_components_around_the_limit(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = want(rows)
    assert Counter(map(tuple, jaccard_join.jaccard_components(docs).collect())) == expected
    assert 14 < len({c for _, n, c in expected if n}) < len(rows) / 2
    members, links = jaccard_join.jaccard_links(docs)
    cls = {r.doc_id: r.cls for r in members.collect()}
    sets = {cls[i]: s for (i, _), s in zip(rows, brute_sets([t for _, t in rows]), strict=True) if s}
    all_pairs = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == all_pairs


def test_a_large_group_of_near_copies_takes_few_pairs(spark, monkeypatch):
    """1,500 edits of one text: one pair each, not a million."""
    r = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, edited(r, base, i % 2)) for i in range(1500)] + [(1500, " ".join(base)), (1501, "other words that link with nothing here")]
    counted = []
    real = jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda pairs, sets: (counted.append(pairs.count()), real(pairs, sets))[1])
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.component for r in found if r.doc_id < 1501} == {0} and sum(counted) < 3 * len(rows)


def test_no_documents(no_docs):
    assert jaccard_join.jaccard_components(no_docs).count() == 0


@given(st.sets(st.integers(0, 40)), st.sets(st.integers(0, 40)))
def test_filters_lose_nothing(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert jaccard_join.suffix_bound(x, y) >= len(a & b)
    assert jaccard_join.linked(x, y) == (bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b))
    if jaccard_join.linked(x, y):
        small, large = sorted((x, y), key=len)
        index = len(small) - -(-len(small) * 160 // 180) + 1
        probe = len(large) - jaccard_join._share(len(large), 80) + 1
        assert set(small[:index].tolist()) & set(large[:probe].tolist())


def test_the_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert Counter(map(tuple, queries.op13_jaccard_join(spark, SF).collect())) == Counter(con.execute(oracles.OP13).fetchall())
