"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from quantloom.llm import conversation_repair as repair
from quantloom.llm import queries

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
PUT = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def cheapest(rows):
    """(cost, audit, lines) by taking up prefixes in order of (cost, audit); rows of (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        new = PUT[state]
        if not audit.endswith("III"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, new[0], (*lines, f"{new}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, new[0], (*lines, f"{new}:{text}")))
                if (state, role[:1]) in STEP:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else x
        k = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def brute(rows):
    def digest(r):
        return hashlib.md5(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()

    rows = [(c, t, *(" " if x is None else x for x in rest)) for c, t, *rest in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.strip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)])
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


def hard_rows():
    """Every kind of fault, null values in every column, repeated rows, ties, unknown roles, a null conversation and a long one."""
    r = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(r.randrange(7)):
            text = r.choice(["Yes.", "No!", "Well", "", " \t", "Yes.", "So?  \n", None, "é…", f"No. {turn}."])
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, None, 0]), r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "ace", "User"]), text))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (900, 0, "user", "x" * 300_000 + "."), (901, 5, "user", "a."), (901, 5, "user", "a."), (901, 5, "user", "a.")]
    r.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, conv string, kind string, n string, digest string, last string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", "n", "d", "l") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("segment", [1 << 12, 3, 1])
def test_repairs_match_brute_force(spark, monkeypatch, segment):
    """Also where conversations are cut into short segments."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = hard_rows()
    want = brute(rows)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_digests(frame(spark, rows)).collect()}
    assert got == {c: w[:8] for c, w in want.items()}
    if segment != 3:
        return
    lines = {}
    for r in sorted(repair.repair_conversations(frame(spark, rows)).collect(), key=lambda r: r.place):
        assert r.place == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.edit in "KRI"
    assert {c: tuple(x) for c, x in lines.items()} == {c: w[8] for c, w in want.items() if w[8]}


def test_damage_is_that_of_the_definition(spark):
    rows = hard_rows()
    got = Counter(map(tuple, repair.damage(frame(spark, rows)).collect()))
    assert got == Counter(brute_damage(rows))


def test_the_query_on_a_whole_table(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: nothing for c, *_ in given} | {c: w[:8] for c, w in brute(brute_damage(given)).items()}
    rows = queries.op11_conversation_repair(spark, SF).collect()
    assert len(rows) == len(want) and {r.conv_id: tuple(r)[1:] for r in rows} == want


def test_no_conversations(spark):
    assert repair.repair_digests(frame(spark, [])).count() == 0 and repair.repair_conversations(frame(spark, [])).count() == 0


def test_a_conversation_of_many_rows_and_copies(spark):
    """Linear in its rows, over several segments; 20,000 copies of one row are repeated rows."""
    rows = [(1, t, "user" if t % 3 else "assistant", f"Turn {t}.") for t in range(12_000)] + [(1, 12_000, "user", "Again.")] * 20_000
    (got,) = repair.structure_reports(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)).collect()
    assert (got.duplicate, got.gaps, got.audit.count("D")) == (19_999, 0, got.audit.count("D")) and got.audit.count("D") >= 19_999
    plain = [(repair.ROLES[r[2][0]], repair.FINE) for r in rows[:12_001]] + [(repair.U, repair.REPEATED)] * 19_999
    assert (got.cost, got.audit) == repair.best_edits(plain, repair.START, {repair.START, repair.A})


@given(st.lists(st.tuples(st.sampled_from([-1, repair.S, repair.U, repair.A]), st.sampled_from([0, 1, 2, 3])), max_size=9))
def test_best_edits_match_brute_force(rows):
    names = {-1: "x", repair.S: "s", repair.U: "u", repair.A: "a"}
    faults = ["", "blank", "duplicate", "truncated"]
    want = cheapest([(names[role], "", faults[f]) for role, f in rows])[:2]
    assert repair.best_edits(rows, repair.START, {repair.START, repair.A}) == want
