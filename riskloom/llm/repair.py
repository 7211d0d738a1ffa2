"""Conversation structure repair by generalised LR parsing (operator 13).

The role grammar (`GRAMMAR`: an optional system turn, then pairs of user and
assistant turns) gives an LR automaton.  A conversation's rows are parsed with
a graph-structured stack whose edges are the edits: keep, rerole, delete and
insert.  Equal stack tops merge by the least (cost, audit); stacks share their
tails, and audits share their beginnings.

Rows are dealt by range of (conversation, turn), so that a conversation of any
length is spread over tasks.  A task parses the rows of a conversation that it
holds (a segment): from the empty stack if it holds all of them, else from
every stack.  Segments of one conversation are then joined by adding costs and
audits over equal stacks, which gives the parse of the whole, as equal costs of
the same rows never have audits of which one begins the other.  The digest of
such a conversation is streamed in a last pass over its rows.

Copies of a row are counted before anything is dealt, and the first row of a
text is found by aggregation, so that equal rows don't meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import written

from .common import record

#: Nonterminal -> right sides; small letters are initials of roles.
GRAMMAR = {"Talk": ((), ("Closed",)), "Closed": (("Open", "a"),), "Open": (("u",), ("Head", "u"), ("Closed", "u")), "Head": (("s",),)}
START = "Talk"
#: Edits: the audit's letter, the role it sets and its cost.
KEEP, DELETE, AS_USER, AS_ASSISTANT, NEW_USER, NEW_ASSISTANT = "K", "D", "1", "2", "3", "4"
LETTERS = str.maketrans({AS_USER: "R", AS_ASSISTANT: "R", NEW_USER: "I", NEW_ASSISTANT: "I"})
ROLES = {AS_USER: "user", AS_ASSISTANT: "assistant", NEW_USER: "user", NEW_ASSISTANT: "assistant"}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
ENDINGS = (b".", b"!", b"?")
TEXT_ROOM = 16 << 20  # bytes of texts that a segment holds for its digest; a longer one is streamed later

COUNTS = ("blank", "duplicate", "truncated", "illegal")
SEGMENTS = ("conv_id long, part int, edge boolean, first string, last string, min_turn long, max_turn long, turns long, "
            "blank long, duplicate long, truncated long, illegal long, "
            "moves array<struct<start:int,stop:int,cost:long,ops:string>>, sha string")
SOLVED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, ops string, sha string")


# --- the automaton --------------------------------------------------------------------------


@cache
def closure(kernel: frozenset) -> frozenset:
    """LR(0) items (left side, right side, dot) of a state."""
    items, todo = set(kernel), list(kernel)
    while todo:
        _, right, dot = todo.pop()
        for more in GRAMMAR.get(right[dot], ()) if dot < len(right) else ():
            item = (right[dot], more, 0)
            if item not in items:
                items.add(item)
                todo.append(item)
    return frozenset(items)


@cache
def goto(state: frozenset, symbol: str) -> frozenset | None:
    kernel = frozenset((left, right, dot + 1) for left, right, dot in state if dot < len(right) and right[dot] == symbol)
    return closure(kernel) if kernel else None


BOTTOM = (closure(frozenset((START, right, 0) for right in GRAMMAR[START])), None)


def reduced(stack: tuple) -> list[tuple]:
    """A stack and what its reductions make of it (a stack is its top state and the stack below)."""
    out, todo = [], [stack]
    while todo:
        stack = todo.pop()
        out.append(stack)
        for left, right, dot in sorted(stack[0]):
            if dot == len(right) and left != START:
                below = stack
                for _ in right:
                    below = below[1]
                state = goto(below[0], left)
                if state is not None:
                    todo.append((state, below))
    return out


class Stacks:
    """Numbers stacks and keeps their moves; number 0 is the empty one."""

    def __init__(self) -> None:
        self.of, self.stacks, self.moves = {BOTTOM: 0}, [BOTTOM], [{}]

    def advance(self, number: int, terminal: str) -> list[int]:
        """The stacks after shifting ``terminal``: those that can shift again or end."""
        known = self.moves[number].get(terminal)
        if known is None:
            state = goto(self.stacks[number][0], terminal)
            after = reduced((state, self.stacks[number])) if state is not None else []
            known = self.moves[number][terminal] = [
                self.number(s) for s in after if self.accepts(s) or any(d < len(r) and r[d].islower() for _, r, d in s[0])]
        return known

    def number(self, stack: tuple) -> int:
        if stack not in self.of:
            self.of[stack] = len(self.stacks)
            self.stacks.append(stack)
            self.moves.append({})
        return self.of[stack]

    def accepts(self, stack: tuple) -> bool:
        return any(left == START and dot == len(right) and _below(stack, dot) == BOTTOM for left, right, dot in stack[0])

    def all(self) -> list[int]:
        """All stacks that the grammar reaches (left recursion keeps them few), numbered in one order everywhere."""
        at = 0
        while at < len(self.stacks):
            for terminal in "sua":
                self.advance(at, terminal)
            at += 1
        return list(range(len(self.stacks)))


def _below(stack: tuple, n: int) -> tuple:
    for _ in range(n):
        stack = stack[1]
    return stack


@cache
def stacks() -> Stacks:
    out = Stacks()
    out.all()
    return out


# --- the parse ------------------------------------------------------------------------------


def audit(ops: str) -> str:
    return ops.translate(LETTERS)


def _since(a: tuple | None, b: tuple | None) -> tuple[str, str]:
    """The edits of two paths (before, edit, length) after the last one that they share."""
    left, right = [], []
    while a is not b:
        if b is None or (a is not None and a[2] >= b[2]):
            left.append(a[1])
            a = a[0]
        else:
            right.append(b[1])
            b = b[0]
    return audit("".join(reversed(left))), audit("".join(reversed(right)))


def path(cell: tuple | None) -> str:
    out = []
    while cell is not None:
        out.append(cell[1])
        cell = cell[0]
    return "".join(reversed(out))


Tops = dict[int, tuple[int, tuple | None]]  # stack -> (cost, last edit); an edit is (edits before, edit, number)


def offer(tops: Tops, to: int, cost: int, before: tuple | None, edit: str) -> bool:
    """Merges a path into the stack top ``to``: the least (cost, audit) stays."""
    cell = (before, edit, before[2] + 1 if before else 1)
    old = tops.get(to)
    if old is not None:
        if cost > old[0]:
            return False
        if cost == old[0]:
            new_edits, old_edits = _since(cell, old[1])
            if new_edits >= old_edits:
                return False
    tops[to] = (cost, cell)
    return True


class Parse:
    """Stack tops of a segment and the cheapest edits that lead to them, from stack ``start``."""

    def __init__(self, start: int) -> None:
        self.table = stacks()
        self.tops: Tops = {start: (0, None)}
        self.insert()

    def insert(self) -> None:
        """New rows may stand anywhere."""
        tops, todo = self.tops, list(self.tops)
        while todo:
            number = todo.pop()
            cost, cell = tops[number]
            for terminal, edit in (("u", NEW_USER), ("a", NEW_ASSISTANT)):
                for to in self.table.advance(number, terminal):
                    if offer(tops, to, cost + INSERT_COST, cell, edit):
                        todo.append(to)

    def row(self, initial: str, truncated: bool, must_go: bool) -> None:
        tops: Tops = {}
        for number, (cost, cell) in self.tops.items():
            offer(tops, number, cost + DELETE_COST, cell, DELETE)
            if must_go:
                continue
            cost += TRUNCATED_COST if truncated else 0
            if initial in ("s", "u", "a"):
                for to in self.table.advance(number, initial):
                    offer(tops, to, cost, cell, KEEP)
            for terminal, edit in (("u", AS_USER), ("a", AS_ASSISTANT)):
                for to in self.table.advance(number, terminal):
                    offer(tops, to, cost + REROLE_COST, cell, edit)
        self.tops = tops
        self.insert()


def best_end(tops: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The least (cost, audit) of the stacks that may end a conversation, with its edits."""
    table = stacks()
    ends = [(cost, audit(ops), ops) for number, (cost, ops) in tops.items() if table.accepts(table.stacks[number])]
    cost, _, ops = min(ends)
    return cost, ops


class Digest:
    """The digest of the repaired rows, joined by line feeds."""

    def __init__(self) -> None:
        self.sha, self.empty = hashlib.sha256(), True

    def add(self, role: str, text: bytes) -> None:
        self.sha.update(b"" if self.empty else b"\n")
        self.sha.update(role.encode() + b":")
        self.sha.update(text)
        self.empty = False

    def edits(self, ops: Iterator[str], role: str, text: bytes) -> None:
        """All inserted rows before a row, and what becomes of the row."""
        for op in ops:
            if op in (NEW_USER, NEW_ASSISTANT):
                self.add(ROLES[op], b"")
                continue
            if op != DELETE:
                self.add(ROLES.get(op, role), text)
            return

    def rest(self, ops: Iterator[str]) -> None:
        for op in ops:
            self.add(ROLES[op], b"")


# --- tasks ----------------------------------------------------------------------------------


class Segment:
    """The rows of one conversation in one task."""

    def __init__(self, conv_id: int | None, part: int, edge: bool) -> None:
        self.conv_id, self.part, self.edge = conv_id, part, edge
        self.parses = [Parse(n) for n in (range(len(stacks().stacks)) if edge else (0,))]
        self.first: str | None = None
        self.last: str | None = None
        self.turns: list[int | None] = [None, None]
        self.n = dict.fromkeys(("turns", *COUNTS), 0)
        self.rows: list[tuple[str, bytes, int]] | None = []
        self.room = TEXT_ROOM

    def add(self, turn: int | None, role: str, text: bytes, copies: int, later: bool) -> None:
        self.keep_text(role, text, copies)
        self.see_turn(turn)
        initial, words = role[:1], text.rstrip()
        blank = not words
        truncated = not blank and not later and words[-1:] not in ENDINGS
        self.n["blank"] += copies if blank else 0
        self.n["duplicate"] += 0 if blank else copies - (not later)
        self.n["truncated"] += truncated
        for k in range(copies):
            if self.last is None:
                self.first = initial
            elif self.last + initial not in ("su", "ua", "au"):
                self.n["illegal"] += 1
            self.last = initial
            must_go = blank or later or k > 0
            for parse in self.parses:
                parse.row(initial, truncated, must_go)

    def see_turn(self, turn: int | None) -> None:
        if turn is not None:
            self.n["turns"] += turn != self.turns[1]
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn]

    def keep_text(self, role: str, text: bytes, copies: int) -> None:
        if self.rows is not None:
            self.rows.append((role, text, copies))
            self.room -= len(text) + 100
            if self.room < 0:
                self.rows = None

    def result(self) -> dict:
        moves = [{"start": k, "stop": to, "cost": cost, "ops": path(cell)}
                 for k, parse in enumerate(self.parses) for to, (cost, cell) in parse.tops.items()]
        sha = None
        if self.rows is not None:
            ops, digest = iter(best_end({m["stop"]: (m["cost"], m["ops"]) for m in moves if m["start"] == 0})[1]), Digest()
            for role, text, copies in self.rows:
                for _ in range(copies):
                    digest.edits(ops, role, text)
            digest.rest(ops)
            sha = digest.sha.hexdigest()
        return {"conv_id": self.conv_id, "part": self.part, "edge": self.edge, "first": self.first, "last": self.last,
                "min_turn": self.turns[0], "max_turn": self.turns[1], **self.n, "moves": moves, "sha": sha}


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(c).cast(pa.binary()).to_pylist() if c == "text" else batch.column(c).to_pylist() for c in names]
        yield from zip(*columns, strict=True)


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[bool, bool, Iterator[tuple]]]:
    """(first of the task, rows) of runs of one conversation, one after the other."""
    held = next(rows, None)
    first = True

    def run() -> Iterator[tuple]:
        nonlocal held
        name = held[0]
        while held is not None and held[0] == name:
            row, held = held, next(rows, None)
            yield row

    while held is not None:
        yield first, run()
        first = False


def _parse(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last conversation of a task may go on elsewhere, so they are parsed from every stack.

        Whether a conversation is the last one shows only after its rows; until
        then they wait, if they are few.  A long one counts as an edge at once.
        """
        out: list[dict] = []
        held: list[tuple] = []

        def segment(rows, edge: bool) -> dict:
            s = None
            for conv, turn, role, text, copies, later, part in rows:
                s = s or Segment(conv, part, edge)
                s.add(turn, role, text or b"", copies, later)
            return s.result()

        for first, rows in _grouped(_rows(batches, ["conv_id", "turn", "role", "text", "copies", "later", "part"])):
            if held:
                out.append(segment(held, False))
                held = []
            if first:
                out.append(segment(rows, True))
                continue
            room = TEXT_ROOM
            for row in rows:
                held.append(row)
                room -= len(row[3] or b"") + 100
                if room < 0:
                    break
            if room < 0:
                out.append(segment(_chain(held, rows), True))
                held = []
            if len(out) >= 500:
                yield _record(schema, out)
                out = []
        if held:
            out.append(segment(held, True))
        yield _record(schema, out)

    return run


def _chain(held: list[tuple], rows: Iterator[tuple]) -> Iterator[tuple]:
    yield from held
    yield from rows


def _record(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return record(schema, **{f.name: [r[f.name] for r in rows] for f in schema})


def _join(schema: pa.Schema):
    """Segments of a conversation, in order, to its whole parse."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_pylist():
                    yield r["conv_id"], r

        for _, rows in _grouped(segments()):
            yield _record(schema, [joined([r for _, r in rows])])

    return run


def joined(parts: list[dict]) -> dict:
    """One conversation from its segments (a task's worth of rows each)."""
    tops: Tops = {0: (0, None)}
    for p in parts:
        new: Tops = {}
        for m in p["moves"]:
            if m["start"] in tops:
                cost, before = tops[m["start"]]
                offer(new, m["stop"], cost + m["cost"], before, m["ops"])
        tops = new
    cost, ops = best_end({to: (cost, path(cell)) for to, (cost, cell) in tops.items()})
    n = {c: sum(p[c] for p in parts) for c in ("turns", *COUNTS)}
    known = [p for p in parts if p["min_turn"] is not None]
    for a, b in zip(known, known[1:], strict=False):
        n["turns"] -= a["max_turn"] == b["min_turn"]
    n["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:], strict=False))
    gaps = known[-1]["max_turn"] - known[0]["min_turn"] + 1 - n["turns"] if known else 0
    return {"conv_id": parts[0]["conv_id"], "gaps": gaps, **{c: n[c] for c in COUNTS}, "cost": cost, "ops": ops,
            "sha": parts[0]["sha"] if len(parts) == 1 else None}


def _stream(schema: pa.Schema):
    """Digests of conversations: a row with the edits (``copies`` 0), then the rows, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(_rows(batches, ["conv_id", "role", "text", "copies"])):
            ops, digest = iter(""), Digest()
            for name, role, text, copies in rows:
                if not copies:
                    ops = iter(text.decode())
                for _ in range(copies):
                    digest.edits(ops, role, text or b"")
            digest.rest(ops)
            yield record(schema, conv_id=[name], streamed=[digest.sha.hexdigest()])

    return run


# --- the operator ---------------------------------------------------------------------------


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Test damage by crc32 of ``conv:turn`` modulo 20 (nulls are one blank there, as in role and text): 0 drops a
    row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    text = F.when(lot == 1, F.lit("")).when(lot == 2, F.regexp_replace(blank(text_col), "[.!?]", "")).otherwise(blank(text_col))
    changed = {role_col: F.when(lot == 4, F.lit("user")).otherwise(blank(role_col)), text_col: text}
    row = F.struct(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in rows.columns))
    return rows.where(lot != 0).select(F.explode(F.array_repeat(row, F.when(lot == 3, 2).otherwise(1))).alias("row")).select("row.*")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, digest, copies, later), ``later`` if a row of an earlier turn has the
    same role and text."""
    digest = F.md5("text")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (rows.groupBy("conv_id", "role", digest.alias("digest")).agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
              .where("first < last").drop("last"))
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("digest", digest)
    a, b = distinct.alias("a"), firsts.alias("b")
    match = same(F.col("a.conv_id"), F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    later = F.coalesce(F.col("b.first") < F.struct(F.col("a.turn").isNotNull().alias("known"), F.col("a.turn").alias("turn")), F.lit(False))
    return a.join(b, match, "left").select("a.*", later.alias("later"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    Rows are taken by turn, nulls first, then by role and the text's digest.
    A row's first fault counts: ``blank`` (nothing but ASCII blanks),
    ``duplicate`` (role and text seen earlier), ``truncated`` (does not end in
    ``.!?``).  ``illegal`` counts neighbours other than system-user,
    user-assistant and assistant-user; ``gaps`` the turns missing between the
    first and the last.  ``audit`` has the initials of the cheapest edits:
    Keep 0, Rerole 1, Delete 2 (a must for blank rows and duplicates), Insert
    5; a truncated row that stays costs 5.  Ties go to the least audit.
    ``repaired_sha256`` is of the repaired ``role:text`` rows joined by line
    feeds.

    A null conversation id is one conversation; null roles and texts are one
    blank; rows repeated exactly are duplicates; an empty table gives no rows;
    other columns are neither read nor returned.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = rows.sparkSession
    schema = lambda ddl: to_arrow_schema(spark.createDataFrame([], ddl).schema)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    clean = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        blank(role_col).alias("role"), blank(text_col).alias("text"))
    place = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest")]
    parsed = (ordered(clean).repartitionByRange(*place).sortWithinPartitions(*place)
              .withColumn("part", F.spark_partition_id())
              .select("conv_id", "turn", "role", "text", "copies", "later", "part").mapInArrow(_parse(schema(SEGMENTS)), SEGMENTS))
    segments = written(parsed)

    # whole conversations are done; those at the edges of tasks are joined (at most two per task, and very long ones)
    whole = segments.where("not edge").select(
        "conv_id", (F.coalesce(F.col("max_turn") - F.col("min_turn") + 1, F.lit(0)) - F.col("turns")).alias("gaps"), *COUNTS,
        _ending(F.col("moves")).alias("end"), "sha").select("conv_id", "gaps", *COUNTS, "end.cost", "end.ops", "sha")
    edges = (segments.where("edge").repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part")
             .mapInArrow(_join(schema(SOLVED)), SOLVED))
    solved = written(edges)
    open_ones = solved.where("sha is null").select("conv_id", "ops")
    c, o = clean.alias("c"), open_ones.alias("o")
    texts = c.join(o, same(F.col("c.conv_id"), F.col("o.conv_id")), "left_semi")
    header = open_ones.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                              F.col("ops").alias("text"), F.lit(0).cast("long").alias("copies"), F.lit("").alias("digest"))
    distinct = texts.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("digest", F.md5("text"))
    lines = header.unionByName(distinct).withColumn("row", F.col("copies") > 0)
    streamed = (lines.repartition("conv_id")
                .sortWithinPartitions(F.asc_nulls_first("conv_id"), "row", *place[1:])
                .select("conv_id", "role", "text", "copies").mapInArrow(_stream(schema("conv_id long, streamed string")),
                                                                         "conv_id long, streamed string"))
    s, t = solved.alias("s"), streamed.alias("t")
    rest = s.join(t, same(F.col("s.conv_id"), F.col("t.conv_id")), "left").select(
        "s.conv_id", "gaps", *COUNTS, "cost", "ops", F.coalesce("sha", "streamed").alias("sha"))
    done = whole.unionByName(rest)
    letters = F.translate("ops", AS_USER + AS_ASSISTANT + NEW_USER + NEW_ASSISTANT, "RRII")
    return done.select("conv_id", "gaps", *COUNTS, "cost", letters.alias("audit"), F.col("sha").alias("repaired_sha256"))


def _ending(moves: Column) -> Column:
    """The least (cost, audit) among the stacks that may end, of a conversation parsed from the empty stack."""
    table = stacks()
    ends = [n for n, s in enumerate(table.stacks) if table.accepts(s)]
    able = F.filter(moves, lambda m: (m["start"] == 0) & m["stop"].isin(ends))
    return F.array_min(F.transform(able, lambda m: F.struct(
        m["cost"].alias("cost"), F.translate(m["ops"], AS_USER + AS_ASSISTANT + NEW_USER + NEW_ASSISTANT, "RRII").alias("audit"),
        m["ops"].alias("ops"))))
