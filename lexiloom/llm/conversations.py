"""Cheapest repair of conversations whose turns are blank, repeated, cut off or out of order, by survivor-coalescence Viterbi.

A repaired conversation has role initials ``(s?(ua)+)?``. Four states say what the kept turns so far end in: nothing, a system
turn, a user turn, an assistant turn. Each state keeps its cheapest edits as the leaf of a tree of back pointers. A leaf that
no later turn continues is cut off, and its ancestors with it as their counts of references fall to zero; once all survivors
share an ancestor, the edits up to it are settled and given out. Turns of one conversation stream through in order, and
nothing but the unsettled edits (one character each) and one hash per survivor is held, however long the conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.llm.common import small_batches, tidy

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5  # more for a truncated turn that stays
BLANK = "\\x20\\x09-\\x0D"
ROLES = {"u": "user", "a": "assistant"}

START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The one role that a changed or inserted turn can have after each state.
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
FINAL = (START, ASSISTANT)
#: MATCH[y][x]: whatever follows state x can follow state y for at most so much more. From the start all that follows an
#: assistant turn is allowed as it is; from an assistant turn a system turn would have to go (2); after a user turn an
#: assistant turn is inserted first (5); after a system turn a pair may be needed (10).
MATCH = {
    START: {SYSTEM: 0, USER: 5, ASSISTANT: 0}, SYSTEM: {START: 10, USER: 5, ASSISTANT: 10},
    USER: {START: 7, SYSTEM: 5, ASSISTANT: 5}, ASSISTANT: {START: 2, SYSTEM: 0, USER: 5},
}


class Turn(NamedTuple):
    initial: str  # of its role, may be empty
    must_go: bool  # blank or duplicate
    truncated: bool
    line: str  # what a kept turn adds to the repaired text
    text: str


class Node:
    """Edits that lead from ``parent`` to here: one turn's edit with the insertions before it."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent: Node | None, edits: str):
        self.parent, self.edits, self.children = parent, edits, []
        if parent is not None:
            parent.children.append(self)


class Survivor(NamedTuple):
    cost: int
    node: Node
    payload: object  # hash of the repaired text so far


class Digest:
    """SHA-256 of joined lines, grown line by line; copies are cheap."""

    __slots__ = ("hash", "empty")

    def __init__(self, hash_=None, empty: bool = True):
        self.hash, self.empty = hash_ or hashlib.sha256(), empty

    def plus(self, lines: Iterable[str]) -> Digest:
        more, empty = self.hash.copy(), self.empty
        for line in lines:
            more.update(("" if empty else "\n").encode() + line.encode("utf-8", "surrogatepass"))
            empty = False
        return Digest(more, empty)

    def hex(self) -> str:
        return self.hash.hexdigest()


class Repair:
    """Viterbi over the turns of one conversation. ``step`` takes a turn, ``finish`` ends; both give the edits settled by then.

    Survivors are held in the order of their whole edit strings. Each has taken every turn so far and ends in a turn's own
    edit, so none is a prefix of another, and that order with the edits added since decides any tie as the whole strings do.
    """

    def __init__(self):
        self.root = Node(None, "")
        self.alive: dict[int, Survivor] = {START: Survivor(0, self.root, Digest())}  # in the order of their edits
        self.open = 0  # edits in the tree that are not settled

    def inserted(self, state: int) -> Iterator[tuple[int, str, list[str]]]:
        """The states that insertions reach from ``state``, none to two of them: (state, edits, lines)."""
        edits, lines = "", []
        yield state, edits, lines
        for _ in range(2):
            role = NEXT[state]
            state, edits, lines = AFTER[role], edits + INSERT, [*lines, f"{ROLES[role]}:"]
            yield state, edits, lines

    def choices(self, state: int, turn: Turn) -> Iterator[tuple[int, str, int, str | None]]:
        """What may happen to ``turn`` after ``state``: (state, edit, cost, line)."""
        yield state, DELETE, COSTS[DELETE], None
        if turn.must_go:
            return
        more = TRUNCATED if turn.truncated else 0
        role = NEXT[state]
        if turn.initial == role or (turn.initial == "s" and state == START):
            yield AFTER[turn.initial], KEEP, COSTS[KEEP] + more, turn.line
        if turn.initial != role:
            yield AFTER[role], REROLE, COSTS[REROLE] + more, f"{ROLES[role]}:{turn.text}"

    def step(self, turn: Turn) -> str:
        best: dict[int, tuple] = {}
        for rank, (state, old) in enumerate(self.alive.items()):
            for middle, before, lines in self.inserted(state):
                for target, edit, cost, line in self.choices(middle, turn):
                    key = (old.cost + COSTS[INSERT] * len(before) + cost, rank, before + edit)
                    if target not in best or key < best[target][0]:
                        best[target] = (key, old, lines if line is None else [*lines, line])
        kept = {s: b for s, b in best.items() if not self.hopeless(s, b[0], best)}
        earlier = [old.node for old in self.alive.values()]
        self.alive = {}
        for state, (key, old, lines) in sorted(kept.items(), key=lambda item: item[1][0][1:]):
            self.alive[state] = Survivor(key[0], Node(old.node, key[2]), old.payload.plus(lines) if lines else old.payload)
            self.open += len(key[2])
        for node in earlier:
            self.drop(node)
        return self.settled()

    @staticmethod
    def hopeless(state: int, key: tuple, best: dict[int, tuple]) -> bool:
        """Whether another state's edits are better than these whatever follows."""
        for other, (rival, *_) in best.items():
            if other != state:
                more = MATCH[other][state]
                if rival[0] + more < key[0] or (more == 0 and rival < key):
                    return True
        return False

    def drop(self, node: Node) -> None:
        """Cut off ``node`` if nothing continues it, then its ancestors likewise."""
        while not node.children and node.parent is not None and node is not self.root:
            parent, node.parent = node.parent, None
            parent.children.remove(node)
            self.open -= len(node.edits)
            node = parent

    def settled(self) -> str:
        """Move the root down to the last ancestor that all survivors share; the edits on the way."""
        out = []
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            out.append(self.root.edits)
        done = "".join(out)
        self.open -= len(done)
        return done

    def finish(self) -> tuple[str, int, object]:
        """The edits still open, the cost of all, and the payload."""
        best = None
        for rank, (state, old) in enumerate(self.alive.items()):
            for end, edits, lines in self.inserted(state):
                if end in FINAL:
                    key = (old.cost + COSTS[INSERT] * len(edits), rank, edits)
                    if best is None or key < best[0]:
                        best = (key, old, lines)
        (cost, _, edits), old, lines = best
        path, node = [edits], old.node
        while node is not self.root and node is not None:
            path.append(node.edits)
            node = node.parent
        return "".join(reversed(path)), cost, old.payload.plus(lines)


SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, peak_open long"
)
LEGAL = {"su", "ua", "au"}


class Conversation:
    """Running figures of one conversation and its repair."""

    def __init__(self, conv_id):
        self.conv_id, self.repair, self.audit = conv_id, Repair(), []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = self.peak = 0
        self.first = self.last = self.role = None

    def add(self, turn, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if self.role is not None and self.role[:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.role = role
        if fault:
            self.faults[fault] += 1
        must_go = fault in ("blank", "duplicate")
        self.audit.append(self.repair.step(Turn(role[:1], must_go, fault == "truncated", f"{role}:{text}", text)))
        self.peak = max(self.peak, self.repair.open)

    def row(self) -> tuple:
        rest, cost, digest = self.repair.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit) + rest, digest.hex(), self.peak)


def faults(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; further columns are ignored) dealt by conversation and sorted, each with its first
    fault: blank, duplicate, truncated, or nothing. Nulls in role and text count as one blank.

    Rows where ``present`` is false only stand for their conversation. Turns come in order, null ones first, then by role and
    text; a duplicate has the role and text of an earlier row. One shuffle by conversation serves the search for duplicates,
    which sorts and needs no memory for a whole conversation, and the repair.
    """
    table = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(present if present is not None else F.lit(True), F.lit(True)).alias("present"),
    )
    dealt = table.repartition("conv_id")
    alike = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(~F.col("text").rlike(f"[^{BLANK}]"), "blank").when(F.col("nth") > 1, "duplicate")
        .when(~F.col("text").rlike(f"[.!?][{BLANK}]*\\z"), "truncated").otherwise("")
    )
    return (
        dealt.withColumn("nth", F.row_number().over(alike)).withColumn("fault", fault).drop("nth")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    )


def repair(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (see ``faults``): its faults and the cheapest edits that repair it.

    Keep costs 0, Rerole 1, Delete 2 (required for blank and duplicate turns), Insert of an empty turn 5, and a truncated turn
    that stays 5 more; equal costs take the edits that are least in ASCII. ``audit`` holds the edits' initials in order,
    ``repaired_sha256`` is of the repaired turns as ``role:text``, joined by line feeds, ``peak_open`` the most edits that
    were unsettled at once. ``gaps`` counts missing turn numbers. A null conv_id is a conversation of its own; rows that agree
    in everything are all there but the first, which makes the others duplicates. An empty table gives no rows.

    A hash of a whole text is sequential, so a conversation passes through one task, as a sorted stream that Spark spills.
    """
    small_batches()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done = None, []
        for batch in tidy(batches):
            columns = (batch[c].tolist() for c in ("conv_id", "turn", "role", "text", "present", "fault"))
            turns = ((None if c is None or c != c else int(c), t, *rest) for c, t, *rest in zip(*columns))
            for conv_id, group in groupby(turns, key=lambda r: r[0]):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Conversation(conv_id)
                for _, turn, role, text, present, fault in group:
                    if present:
                        now.add(None if turn is None or turn != turn else int(turn), role, text, fault)
            if done:
                yield _frame(done)
                done = []
        if now is not None:
            yield _frame([*done, now.row()])

    # ids travel as text: a column of longs with nulls would reach Python as floats
    sent = faults(rows, present).select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "present", "fault")
    return sent.mapInPandas(run, SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.strip().split()[0] for c in SCHEMA.split(",")])
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


def repaired(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations of ``rows`` themselves: conv_id, place (from 0), edit, role, text, one row per edit but Delete.

    The edits of ``repair`` are dealt back to the numbered turns by a join on conversation and number of the turn, so no
    conversation is collected; an inserted turn has an empty text.
    """
    edits = repair(rows, present).select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit")).where("edit <> ''")
    order = Window.partitionBy("conv_id").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    stays = (F.col("edit") != DELETE).cast("long")
    edits = edits.withColumn("nth", F.sum((F.col("edit") != INSERT).cast("long")).over(upto)).withColumn("place", F.sum(stays).over(upto) - 1)
    turns = faults(rows, present).where("present").withColumn(
        "nth", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    ).select(F.col("conv_id").alias("_c"), F.col("nth").alias("_n"), F.col("role").alias("_role"), "text")
    met = edits.where(F.col("edit") != DELETE).join(
        turns, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("nth") == F.col("_n")) & (F.col("edit") != INSERT), "left"
    )
    # a kept system turn is the first, and the rest alternate from a user turn on
    lead = F.max(F.when((F.col("place") == 0) & (F.col("edit") == KEEP) & (F.substring("_role", 1, 1) == "s"), 1).otherwise(0))
    shift = lead.over(Window.partitionBy("conv_id"))
    given = F.when((F.col("place") - shift) % 2 == 0, ROLES["u"]).otherwise(ROLES["a"])
    return met.withColumn("role", F.when(F.col("edit") == KEEP, F.col("_role")).otherwise(given)).select(
        "conv_id", "place", "edit", "role", F.coalesce("text", F.lit("")).alias("text")
    )
