"""Conversation structure repair: what is wrong with each conversation, and the cheapest edits that mend it.

The roles of a conversation should read ``(s?(ua)+)?`` by their initials. Keeping a row costs 0, giving it the role of user
or assistant 3, deleting it 4, putting in an empty row of user or assistant 3; blank and repeated rows must go, and a
truncated row that stays adds 3. Edits are found by depth-first branch and bound with an explicit stack. A node is (row,
role before it). The suffix bound of a node is the cheapest completion from there when audits are left aside; a table of
dominance keeps, for each node, the cheapest prefix that reached it, and of equal ones the first, which has the least audit,
since children are tried by (cost and bound, letter). The incumbent is a pair of cost and audit; a prefix whose cost and
bound do not beat it is cut, so the search ends with the proof that it is best.

Rows are dealt by ranges of (conversation, turn, role, digest), so a conversation of any length lies in several tasks. It is
cut into segments of ``SEGMENT`` rows; each is solved for every role it may begin and end with, and the segments of a
conversation are put together in order. Texts take no part in this, only 128-bit digests of role and text.

Order of rows: by turn, null first; rows of one turn by role, then by that digest. Repeated rows are rows. A null
conversation id is a conversation of its own; null roles and texts are taken as one space. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, tasks_for

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of a segment.
SEGMENT = 1 << 12
#: What stands before the next row: nothing, or a row with one of the roles.
START, S, U, A = range(4)
ROLES = {"s": S, "u": U, "a": A}
LEGAL = {(START, S): S, (START, U): U, (S, U): U, (U, A): A, (A, U): U}
#: The one role that may be put behind another: user, but assistant behind user.
NEXT = (U, U, A, U)
NAMES = {U: "user", A: "assistant"}
FINE, BLANK, REPEATED, CUT = range(4)
NEVER = 1 << 60


def best_edits(rows: list[tuple[int, int]], begin: int, ends: set[int]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of ``rows`` (role, fault) that lead from ``begin`` to one of ``ends``; of equal costs the ASCII-least audit."""
    n = len(rows)
    bounds = suffix_bounds(rows, ends)
    if bounds[0][begin] >= NEVER:
        return None
    reached = [[NEVER] * 4 for _ in range(n + 1)]  # of each node: cost of the prefix that dominates the others
    incumbent, found = NEVER, ""
    path: list[str] = []
    stack = [(0, begin, 0, 0, "")]
    while stack:
        i, state, cost, depth, letter = stack.pop()
        bound = bounds[i]
        if cost + bound[state] >= incumbent or cost >= reached[i][state]:
            continue
        reached[i][state] = cost
        del path[max(0, depth - 1) :]
        if letter:
            path.append(letter)
        if i == n and state in ends:
            incumbent, found = cost, "".join(path)
            continue  # whatever is put behind it costs more
        after = NEXT[state]
        children = [(cost + INSERT + bound[after], "I", i, after, cost + INSERT)]
        if i < n:
            role, fault = rows[i]
            bound = bounds[i + 1]
            children.append((cost + DELETE + bound[state], "D", i + 1, state, cost + DELETE))
            if fault in (FINE, CUT):
                paid = cost + (TRUNCATED if fault == CUT else 0)
                to = LEGAL.get((state, role))
                if to is not None:
                    children.append((paid + KEEP + bound[to], "K", i + 1, to, paid + KEEP))
                children.append((paid + REROLE + bound[after], "R", i + 1, after, paid + REROLE))
        children.sort(reverse=True)
        for total, letter, j, to, paid in children:
            if total < incumbent and paid < reached[j][to]:
                stack.append((j, to, paid, depth + 1, letter))
    return incumbent, found


def suffix_bounds(rows: list[tuple[int, int]], ends: set[int]) -> list[list[int]]:
    """For each place and role before it: no edits from there to one of ``ends`` cost less."""

    def with_inserts(least):
        u, a = min(least[U], INSERT + least[A]), min(least[A], INSERT + least[U])
        return [min(least[START], INSERT + u), min(least[S], INSERT + u), u, a]

    now = with_inserts([0 if state in ends else NEVER for state in range(4)])
    out = [now]
    for role, fault in reversed(rows):
        least = []
        for state in range(4):
            cost = DELETE + now[state]
            if fault in (FINE, CUT):
                to = LEGAL.get((state, role))
                stays = min(REROLE + now[NEXT[state]], NEVER if to is None else KEEP + now[to])
                cost = min(cost, stays + (TRUNCATED if fault == CUT else 0))
            least.append(cost)
        now = with_inserts(least)
        out.append(now)
    return out[::-1]


def damage(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Conversations with faults put in, by crc32 of ``id:turn`` (null: one space): some rows dropped, emptied, without stops, repeated or of another role."""
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    which = F.crc32(F.concat(one_space(id_col), F.lit(":"), one_space("turn"))) % 20
    text = F.when(F.col("__which") == 1, "").when(F.col("__which") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    marked = rows.select(F.col(id_col).alias("conv_id"), "turn", one_space("role").alias("role"), one_space("text").alias("text"), which.alias("__which"))
    copies = F.when(F.col("__which") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.filter("__which <> 0").select("conv_id", "turn", F.when(F.col("__which") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("__k")).drop("__k")


def _rows(rows: DataFrame, id_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select(F.col(id_col).cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    digest: Column = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    return plain.withColumn("digest", digest)


def _order(*first: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (*first, "turn", "role", "digest")]


def _ordered_keys(rows: DataFrame) -> DataFrame:
    """One row for each different row of a conversation, in order over the tasks, with ``n`` copies; ``again``: role and text were there at an earlier turn."""
    spark = rows.sparkSession
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    marked = rows.select("conv", "turn", "role", "digest", last.alias("last"))
    kind = F.when(F.col("last") == "", BLANK).when(F.col("last").isin(".", "!", "?"), FINE).otherwise(CUT).alias("kind")
    keys = cut(marked.groupBy("conv", "turn", "role", "digest").agg(F.first("last").alias("last"), F.count("*").alias("n")).select("conv", "turn", "role", "digest", kind, "n"))
    # the first of several turns, null before all others; with a partial sum for each task, and a join that can be split
    firsts = keys.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.count("*").alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("least"))
    firsts = firsts.filter("turns > 1").select("c", "d", F.col("least.turn").alias("first"), F.lit(True).alias("more"))
    known = keys.join(firsts, keys["conv"].eqNullSafe(firsts["c"]) & (keys["digest"] == firsts["d"]), "left")
    again = F.coalesce(F.col("more"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    known = known.select("conv", "turn", "role", "digest", "kind", "n", again.alias("again"))
    return known.repartitionByRange(tasks_for(spark, 0), *_order("conv")).sortWithinPartitions(*_order("conv"))


_SEGMENT = "conv long, seg long, blank long, duplicate long, truncated long, illegal long, first string, last string, least long, most long, turns long, turn0 long, turn1 long, solved array<struct<begin: int, end: int, cost: long, audit: string>>"
_REPORT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


class _Segment:
    """Consecutive rows of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.illegal, self.first, self.last = conv, [], 0, None, None
        self.turns, self.least, self.most, self.turn0, self.turn1 = 0, None, None, None, None

    def add(self, turn, initial, fault):
        if self.rows:
            self.illegal += not _legal(self.last, initial)
        else:
            self.first = initial
        self.last = initial
        if turn is not None and turn != self.turn1:  # in order, so equal turns are neighbours
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.turn0 = self.least
            self.most = self.turn1 = turn
        self.rows.append((ROLES.get(initial, -1), fault))

    def row(self, seg, whole):
        """``whole``: the conversation has no other segment, so only one problem needs an answer."""
        count = lambda fault: sum(f == fault for _, f in self.rows)
        asked = [(START, {START, A}, -1)] if whole else [(b, {e}, e) for b in range(4) for e in range(4)]
        solved = [{"begin": b, "end": e, "cost": best[0], "audit": best[1]} for b, ends, e in asked if (best := best_edits(self.rows, b, ends))]
        return (self.conv, seg, count(BLANK), count(REPEATED), count(CUT), self.illegal, self.first, self.last, self.least, self.most, self.turns, self.turn0, self.turn1, solved)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered keys to solved segments. A conversation that both begins and ends inside the task and isn't cut is whole."""
    names = "conv seg blank duplicate truncated illegal first last least most turns turn0 turn1 solved".split()
    types = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()] * 5 + [pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))]
    place = TaskContext.get().partitionId() << 32
    now, clean, out = None, False, []  # clean: the conversation has begun inside this task and not been cut

    def pack():
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        out.clear()
        return batch

    for batch in batches:
        for conv, turn, role, kind, n, again in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "kind", "n", "again")), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.row(place, clean))
                    place += 1
                clean, now = now is not None, _Segment(conv)
            for k in range(n):
                if len(now.rows) >= SEGMENT:
                    out.append(now.row(place, False))
                    place += 1
                    clean, now = False, _Segment(conv)
                now.add(turn, role[:1], BLANK if kind == BLANK else REPEATED if again or k else kind)
                if len(out) >= 256:
                    yield pack()
    if now is not None:
        out.append(now.row(place, False))
    if out:
        yield pack()


class _Joined:
    """Segments of one conversation put together; of the audits that are still open the common beginning is kept once."""

    def __init__(self, conv):
        self.conv, self.counts, self.illegal, self.last, self.least, self.most, self.turns, self.turn1 = conv, [0, 0, 0], 0, None, None, None, 0, None
        self.settled: list[str] = []
        self.open: dict[int, tuple[int, str]] = {START: (0, "")}
        self.whole = None

    def add(self, blank, duplicate, truncated, illegal, first, last, least, most, turns, turn0, turn1, solved):
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated), strict=True)]
        self.illegal += illegal + (self.last is not None and not _legal(self.last, first))
        self.last = last
        if turns:
            self.turns += turns - (turn0 == self.turn1)
            self.least = least if self.least is None else self.least
            self.most, self.turn1 = most, turn1
        if len(solved) == 1 and solved[0]["end"] == -1:
            self.whole = (solved[0]["cost"], solved[0]["audit"])
            return
        ahead: dict[int, tuple[int, str]] = {}
        for s in solved:
            if s["begin"] in self.open:
                cost, audit = self.open[s["begin"]]
                new = (cost + s["cost"], audit + s["audit"])
                if s["end"] not in ahead or new < ahead[s["end"]]:
                    ahead[s["end"]] = new
        low, high = min(a for _, a in ahead.values()), max(a for _, a in ahead.values())
        same = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
        self.settled.append(low[:same])
        self.open = {end: (cost, audit[same:]) for end, (cost, audit) in ahead.items()}

    def row(self):
        cost, audit = self.whole or min(self.open[e] for e in (START, A) if e in self.open)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, *self.counts, self.illegal, cost, "".join(self.settled) + audit)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = "conv gaps blank duplicate truncated illegal cost audit".split()
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 7 else pa.string()) for k, c in enumerate(zip(*rows, strict=True))], names=names)
    now = None
    for batch in batches:
        out = []
        for conv, _, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.row())
                now = _Joined(conv)
            now.add(*rest)
        if out:
            yield pack(out)
    if now is not None:
        yield pack([now.row()])


def _reports(rows: DataFrame) -> DataFrame:
    parts = cut(_ordered_keys(rows).mapInArrow(_segments, _SEGMENT))
    return cut(parts.repartition(tasks_for(rows.sparkSession, 0), "conv").sortWithinPartitions("conv", "seg").mapInArrow(_join, _REPORT))


def structure_reports(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``rows`` (turn, role, text).

    gaps: turns missing between the least and the greatest; each row counts for its first fault of blank, duplicate (role
    and text were there before) and truncated (no stop at the end); illegal: neighbours whose initials are not su, ua or au.
    """
    return _reports(_rows(rows, id_col)).withColumnRenamed("conv", id_col)


def _edited(batches: Iterator[pa.RecordBatch]):
    """Rows (conv, kind, turn, role, digest, text, audit) sorted, each conversation's audit first: (conv, None) at its beginning and end, else (conv, (edit, role, text))."""
    opened, conv, audit, at, state = False, None, "", 0, START

    def put_in():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, NEXT[state]
            yield conv, ("I", NAMES[state], "")

    for batch in batches:
        for this, kind, role, text, edits in zip(*(batch.column(c).to_pylist() for c in ("conv", "kind", "role", "text", "audit")), strict=True):
            if not kind:
                if opened:
                    yield from put_in()
                    yield conv, None
                opened, conv, audit, at, state = True, this, edits, 0, START
                continue
            yield from put_in()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = ROLES[role[:1]]
                yield conv, ("K", role, text)
            elif edit == "R":
                state = NEXT[state]
                yield conv, ("R", NAMES[state], text)
    if opened:
        yield from put_in()
        yield conv, None


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size, place = [], 0, 0
    pack = lambda: pa.RecordBatch.from_pylist(out, schema=pa.schema([("conv", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))
    for conv, row in _edited(batches):
        if row is None:
            place = 0
            continue
        out.append({"conv": conv, "place": place, "role": row[1], "text": row[2], "edit": row[0]})
        place, size = place + 1, size + len(row[2])
        if size > 1 << 22 or len(out) >= 4096:
            yield pack()
            out, size = [], 0
    if out:
        yield pack()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest over a stream of rows: no conversation is held."""
    out, digest, more = [], hashlib.sha256(), False
    pack = lambda: pa.RecordBatch.from_pylist(out, schema=pa.schema([("conv", pa.int64()), ("sha", pa.string())]))
    for conv, row in _edited(batches):
        if row is None:
            out.append({"conv": conv, "sha": digest.hexdigest()})
            digest, more = hashlib.sha256(), False
            if len(out) >= 4096:
                yield pack()
                out = []
        else:
            digest.update(f"{'\n' * more}{row[1]}:{row[2]}".encode())
            more = True
    if out:
        yield pack()


def _with_audits(rows: DataFrame, reports: DataFrame, run, schema: str) -> DataFrame:
    texts = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", F.lit(None).cast("string").alias("audit"))
    audits = reports.select("conv", F.lit(0), F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("binary"), F.lit(None).cast("string"), "audit")
    dealt = texts.union(audits).repartition(tasks_for(rows.sparkSession, 0), "conv")
    return dealt.sortWithinPartitions(*_order("conv", "kind")).mapInArrow(run, schema)


def repair_conversations(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, place, role, text, edit) of the repaired conversations: edit is K(ept), R(eroled) or I(nserted); place counts from 0."""
    plain = _rows(rows, id_col)
    return _with_audits(plain, _reports(plain), _mended, "conv long, place long, role string, text string, edit string").withColumnRenamed("conv", id_col)


def repair_digests(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """structure_reports with repaired_sha256, the digest of the lines ``role:text`` of the repaired conversation."""
    plain = _rows(rows, id_col)
    reports = _reports(plain)
    shas = _with_audits(plain, reports, _digests, "conv long, sha string").withColumnRenamed("conv", "c")
    joined = reports.join(shas, reports["conv"].eqNullSafe(shas["c"]))
    return joined.select(F.col("conv").alias(id_col), *[c for c in reports.columns if c != "conv"], F.col("sha").alias("repaired_sha256"))
