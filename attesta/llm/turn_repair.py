"""Repair of conversations: the cheapest edits that give roles ``(s?(ua)+)?``, by depth-first branch and bound.

A row may be kept (0), given the role user or assistant (3) or deleted (4); an empty turn may be inserted anywhere (3).
Blank and duplicate rows must go, and a truncated row that stays costs 3 more.  The audit is the initials of the edits in
order (D, I, K, R); of equally cheap repairs the one with the ASCII-least audit is taken.

``search`` keeps its own stack and goes depth first into the child with the least bound.  A node is (rows read, state of the
role pattern); its bound is the cost so far plus a suffix bound, the least that the rows to come must cost from that state
when audits are left out of account.  The best complete (cost, audit) found so far is the incumbent, and each node remembers
the least (cost, audit) that reached it.  What cannot beat the incumbent, or comes to a node no better than before, is cut;
the search ends when the stack is empty, which proves the incumbent.  Cutting at a node is safe: two prefixes of equal cost
have read the same rows, so neither audit is the beginning of the other and their order is settled.

Spark sorts all rows by (conversation, turn) into ranges, so a conversation of any size is spread over as many tasks as it
needs.  Rows are searched in pieces of at most ``PIECE`` rows.  A conversation that lies inside one range as one piece is
finished there.  A piece of any other is searched from each state to each state, and a second stage reads the pieces of a
conversation in order, adds up the least (cost, audit) per state, and carries one running checksum per state, so it holds one
piece at a time.  Rows that agree in all columns travel as one row and a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import BLANKS, arrow_schema, batch, own, rows_of

# fixed values: prices of the edits, and the marks that end a sentence
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ENDS = ".!?"
NAMES = {"u": "user", "a": "assistant"}

PIECE = 256
#: states of the role pattern: nothing yet, after a system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
DONE = (START, ASSISTANT)
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_FAR = 1 << 60


class Item(NamedTuple):
    """A row that may stay (``forced`` 0), or a run of ``forced`` rows that must go."""

    forced: int
    initial: str = ""
    late: bool = False
    role: str = ""
    text: str = ""


class Best(NamedTuple):
    cost: int
    audit: str


def edits(item: Item, state: int) -> list[tuple[str, int, int]]:
    """(initials, cost, next state) of the edits that read the item."""
    if item.forced:
        return [("D" * item.forced, DELETE * item.forced, state)]
    out, late, (wanted, after) = [("D", DELETE, state)], TRUNCATED * item.late, _NEXT[state]
    if item.initial == wanted:
        out.append(("K", late, after))
    elif item.initial == "s" and state == START:
        out.append(("K", late, SYSTEM))
    out.append(("R", REROLE + late, after))
    return out


def suffix_bounds(items: Sequence[Item], ends: Sequence[int]) -> list[list[int]]:
    """For each number of rows read and each state, what the rest costs at least; out of reach is ``_FAR``."""
    bounds = [[_FAR] * 4 for _ in range(len(items) + 1)]
    for at in range(len(items), -1, -1):
        row = bounds[at]
        if at == len(items):
            for s in ends:
                row[s] = 0
        else:
            for s in range(4):
                row[s] = min(cost + bounds[at + 1][t] for _, cost, t in edits(items[at], s))
        for _ in range(2):  # a third insertion in a row comes back to the state after the first
            for s in range(4):
                row[s] = min(row[s], INSERT + row[_NEXT[s][1]])
    return bounds


def search(items: Sequence[Item], start: int = START, ends: Sequence[int] = DONE, bounds: list[list[int]] | None = None) -> Best | None:
    """The least (cost, audit) from ``start`` to one of ``ends``; None if there is none.  Any valid ``bounds`` will do."""
    bounds = suffix_bounds(items, ends) if bounds is None else bounds
    if bounds[0][start] >= _FAR:
        return None
    incumbent: Best | None = None
    reached: dict[tuple[int, int], Best] = {}
    stack = [(0, start, Best(0, ""))]
    while stack:
        at, state, sofar = stack.pop()
        least = sofar.cost + bounds[at][state]
        if least >= _FAR or (incumbent and (least, sofar.audit) > (incumbent.cost, incumbent.audit[: len(sofar.audit)])):
            continue
        seen = reached.get((at, state))
        if seen is not None and seen <= sofar:
            continue
        reached[at, state] = sofar
        if at == len(items) and state in ends and (incumbent is None or sofar < incumbent):
            incumbent = sofar
        children = [(at, _NEXT[state][1], Best(sofar.cost + INSERT, sofar.audit + "I"))]
        if at < len(items):
            children += [(at + 1, t, Best(sofar.cost + cost, sofar.audit + name)) for name, cost, t in edits(items[at], state)]
        children.sort(key=lambda c: (c[2].cost + bounds[c[0]][c[1]], c[2].audit), reverse=True)
        stack.extend(children)
    return incumbent


def repaired(items: Sequence[Item], audit: str, state: int = START) -> Iterator[str]:
    """The turns that an audit leaves, as ``role:text``."""
    rows = iter(item for one in items for item in (one,) * max(1, one.forced))
    for edit in audit:
        wanted, after = _NEXT[state]
        if edit == "I":
            yield f"{NAMES[wanted]}:"
            state = after
            continue
        item = next(rows)
        if edit == "K":
            yield f"{item.role}:{item.text}"
            state = SYSTEM if state == START and item.initial == "s" else after
        elif edit == "R":
            yield f"{NAMES[wanted]}:{item.text}"
            state = after


@dataclass
class Piece:
    """Some consecutive rows of a conversation and what is counted in them."""

    items: list[Item] = field(default_factory=list)
    low: int | None = None
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def add(self, turn: int | None, role: str, text: str, copies: int, is_first: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial, body = role[:1], text.strip(BLANKS)
        self.illegal += (self.last is not None and _illegal(self.last, initial)) + (copies - 1) * _illegal(initial, initial)
        self.first = initial if self.first is None else self.first
        self.last = initial
        if not body:
            self.blank += copies
            self.items.append(Item(copies))
            return
        self.duplicate += copies - is_first
        if is_first:
            late = body[-1] not in ENDS
            self.truncated += late
            self.items.append(Item(0, initial, late, role, text))
        if copies > is_first:
            self.items.append(Item(copies - is_first))

    def follow(self, other: Piece) -> None:
        """Adds the counts of the next piece; the items are not kept."""
        if other.low is not None:
            self.turns += other.turns - (other.low == self.high)
            self.low = other.low if self.low is None else self.low
            self.high = other.high
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal + (self.last is not None and other.first is not None and _illegal(self.last, other.first))
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _illegal(one: str, two: str) -> bool:
    return one + two not in ("su", "ua", "au")


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNTS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last")
_PIECES = (
    "conv_id long, part int, piece long, done boolean, low long, high long, turns long, blank long, duplicate long, truncated long, "
    "illegal long, first string, last string, cost long, audit string, sha string, "
    "items array<struct<forced: long, initial: string, late: boolean, role: string, text: string>>, "
    "ways array<struct<start: int, end: int, cost: long, audit: string>>"
)


def _ways(items: Sequence[Item]) -> list[tuple[int, int, int, str]]:
    out = []
    for end in range(4):
        bounds = suffix_bounds(items, (end,))
        for start in range(4):
            best = search(items, start, (end,), bounds)
            if best:
                out.append((start, end, *best))
    return out


def _pieces(batches: Iterable[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Cuts the sorted rows of a range into pieces and searches them."""
    part = TaskContext.get().partitionId()

    def row(conv, number: int, piece: Piece, whole: bool) -> tuple:
        counts = [getattr(piece, c) for c in _COUNTS]
        if not whole:
            return (conv, part, number, False, *counts, None, None, None, [tuple(i) for i in piece.items], _ways(piece.items))
        best = search(piece.items)
        sha = hashlib.sha256("\n".join(repaired(piece.items, best.audit)).encode("utf-8", "replace")).hexdigest()
        return (conv, part, number, True, *counts, best.cost, best.audit, sha, [], [])

    def cut() -> Iterator[tuple]:
        """(conversation, number, piece, may more of the conversation lie elsewhere)"""
        conv, piece, number, first = None, None, 0, True
        for key, turn, role, text, copies, present, is_first in rows_of(batches):
            if piece is None:
                conv, piece = key, Piece()
            elif key != conv:
                yield conv, number, piece, first or number > 0
                conv, piece, number, first = key, Piece(), 0, False
            elif len(piece.items) >= size:
                yield conv, number, piece, True
                piece, number = Piece(), number + 1
            if present:
                piece.add(turn, role, text, copies, is_first)
        if piece is not None:
            yield conv, number, piece, True  # the next range may go on with it

    out, weight = [], 0
    for conv, number, piece, more in cut():
        out.append(row(conv, number, piece, not more))
        weight += 1 + (sum(len(i.text) for i in piece.items) // 100 if more else 0)
        if weight > 20_000:
            yield batch(schema, list(zip(*out)))
            out, weight = [], 0
    if out:
        yield batch(schema, list(zip(*out)))


class _Label:
    """The least (cost, audit) that ends in a state, and the checksum of the turns it leaves."""

    def __init__(self, best: Best, sha, any_turn: bool):
        self.best, self.sha, self.any = best, sha, any_turn

    def after(self, start: int, cost: int, audit: str, items: Sequence[Item]) -> _Label:
        label = _Label(Best(self.best.cost + cost, self.best.audit + audit), self.sha.copy(), self.any)
        for turn in repaired(items, audit, start):
            label.sha.update((("\n" if label.any else "") + turn).encode("utf-8", "replace"))
            label.any = True
        return label


def _step(labels: dict[int, _Label], ways: Iterable[tuple[int, int, int, str]], items: Sequence[Item]) -> dict[int, _Label]:
    chosen: dict[int, tuple[Best, int, int, str]] = {}
    for start, end, cost, audit in ways:
        if start in labels:
            before = labels[start].best
            best = Best(before.cost + cost, before.audit + audit)
            if end not in chosen or best < chosen[end][0]:
                chosen[end] = (best, start, cost, audit)
    return {end: labels[start].after(start, cost, audit, items) for end, (_, start, cost, audit) in chosen.items()}


def _join(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Puts the pieces of each conversation together; they come in order."""

    def finish(conv, total: Piece, labels: dict[int, _Label]) -> tuple:
        last = _step(labels, _ways([]), [])
        best = min((last[s] for s in DONE if s in last), key=lambda x: x.best)
        return (conv, total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, *best.best, best.sha.hexdigest())

    conv, total, labels, out = None, None, {}, []
    for key, _, _, done, *rest in rows_of(batches):
        counts, (cost, audit, sha, items, ways) = Piece([], *rest[: len(_COUNTS)]), rest[len(_COUNTS) :]
        if total is not None and (done or key != conv):
            out.append(finish(conv, total, labels))
            total = None
        if done:
            out.append((key, counts.gaps, counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost, audit, sha))
        else:
            if total is None:
                conv, total, labels = key, Piece(), {START: _Label(Best(0, ""), hashlib.sha256(), False)}
            total.follow(counts)
            items = [Item(**i) for i in items]
            labels = _step(labels, [(w["start"], w["end"], w["cost"], w["audit"]) for w in ways], items)
        if len(out) >= 2_000:
            yield batch(schema, list(zip(*out)))
            out = []
    if total is not None:
        out.append(finish(conv, total, labels))
    if out:
        yield batch(schema, list(zip(*out)))


def damage(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies, present: faults sown by crc32(conv_id:turn) % 20; nulls are one space.

    0 drops a row (present is false), 1 empties its text, 2 takes out its ``.!?``, 3 doubles it, 4 makes it the user's.
    """
    rows = own(df, conv_id=F.col(f"`{key}`").cast("long"), turn=F.col(f"`{turn}`").cast("long"),
               role=F.coalesce(F.col(f"`{role}`"), F.lit(" ")), text=F.coalesce(F.col(f"`{text}`"), F.lit(" ")))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("lot", F.crc32(name.cast("binary")) % 20)
    return rows.select(
        "conv_id", "turn", F.when(F.col("lot") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("lot") == 1, F.lit("")).when(F.col("lot") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("lot") == 3, 2).otherwise(1).alias("copies"), (F.col("lot") != 0).alias("present"),
    )


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conv_id: counts of faults, and cost, audit and checksum of the cheapest repair.

    ``rows`` has conv_id, turn, role and text and may have ``copies`` (how often the row stands there) and ``present`` (false:
    the row only names its conversation).  Rows are read by turn, nulls first; rows of one turn by role, then text.  A null role
    or text counts as one space (a blank text; a role without a place in the pattern).  A null conv_id is a conversation like
    any other.  Repeated rows are duplicates from the second on.  A conversation without rows has zeros, an empty audit and the
    checksum of nothing; an empty table gives no rows.  Further columns are ignored.
    """
    has = set(rows.columns)
    rows = own(
        rows, conv_id=F.col("conv_id").cast("long"), turn=F.col("turn").cast("long"),
        role=F.coalesce(F.col("role"), F.lit(" ")), text=F.coalesce(F.col("text"), F.lit(" ")),
        copies=F.col("copies").cast("long") if "copies" in has else F.lit(1).cast("long"), present=F.col("present") if "present" in has else F.lit(True),
    )
    rows = rows.withColumns({
        "text": F.when(F.col("present"), F.col("text")).otherwise(F.lit("")), "h": F.when(F.col("present"), F.sha2("text", 256)).otherwise(F.lit("")),
        "c": F.struct("conv_id"), "t": F.struct("turn"),  # boxed, so that nulls are equal and least
    })
    rows = rows.groupBy("c", "t", "role", "h").agg(F.any_value("text").alias("text"), F.sum("copies").alias("copies"))
    # the turn is part of the key, so each row of one side meets at most one of the other, however often a text stands there;
    # both sides lie by that key already, the texts are not dealt out again
    firsts = rows.filter("h <> ''").groupBy("c", "role", "h").agg(F.min("t").alias("t")).groupBy("c", "t", "role", "h").agg(F.lit(True).alias("first"))
    marked = rows.join(firsts, ["c", "t", "role", "h"], "left").select(
        "c.conv_id", "t.turn", "role", "text", "copies", "h", (F.col("h") != "").alias("present"),
        F.coalesce("first", F.lit(False)).alias("first"), F.substring("text", 1, 100).alias("head"))
    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("h")]
    ranges = marked.repartitionByRange(*by).sortWithinPartitions(*by)
    pieces, result = arrow_schema(_PIECES), arrow_schema(RESULT)
    cut = ranges.select("conv_id", "turn", "role", "text", "copies", "present", "first").mapInArrow(lambda b: _pieces(b, piece, pieces), _PIECES)
    whole = cut.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "piece")
    return whole.mapInArrow(lambda b: _join(b, result), RESULT)
