"""Repair of conversations by cheapest edits, found with the auction algorithm for shortest paths.

A conversation is a lattice: a node for each row and each state of the role order, an arc for
each edit. The auction raises node prices while it extends and contracts one path; where it ends
a price is the cost still to come, and the arcs that the prices leave no slack are the cheapest
edits, of which the first in ASCII order are traced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import batches_of, materialise

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: An undeleted row whose text breaks off costs so much more.
TRUNCATED_COST = 3
#: States: nothing yet, behind a system row, behind a user row, behind an assistant row. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What a role with this initial leads to; a role without a first character changes nothing.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {q: q for q in range(4)}}
#: The one role, user or assistant, that may follow a state.
TURN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
FAR = 1 << 60
#: Rows of a block. The auction runs in one block after the other, from the end, so that its path stays short.
BLOCK = 64
#: Edits of a row of the table of edits.
PART = 4096

WHITE = " \t\n\x0b\x0c\r"


def arcs(q: int, code: tuple[str, bool, bool]) -> list[tuple[str, int, int, bool]]:
    """(edit, cost, next state, whether it takes the row) from state q before a row (initial of its role, must go, truncated), in ASCII order."""
    initial, must_go, truncated = code
    turn = NEXT[TURN[q][0]][q]
    out = [(DELETE, COST[DELETE], q, True), (INSERT, COST[INSERT], turn, False)]
    if not must_go:
        more = TRUNCATED_COST if truncated else 0
        if (to := NEXT.get(initial, {}).get(q)) is not None:
            out.append((KEEP, COST[KEEP] + more, to, True))
        out.append((REROLE, COST[REROLE] + more, turn, True))
    return out


class Block:
    """The lattice of some rows: node 4 * i + q is state q before row i; ends[q] is the cost from state q behind the last row."""

    def __init__(self, codes: list[tuple[str, bool, bool]], ends: list[int]):
        self.n, self.goal = len(codes), 4 * len(codes) + 4
        known: dict[tuple, list] = {}
        self.arcs: list[list[tuple[str, int, int]]] = []
        for i, code in enumerate(codes):
            for q in range(4):
                found = known.setdefault((q, code), arcs(q, code))
                self.arcs.append([(edit, cost, 4 * (i + takes) + to) for edit, cost, to, takes in found])
        for q in range(4):
            last = [(INSERT, COST[INSERT], 4 * self.n + NEXT[TURN[q][0]][q])]
            self.arcs.append(last + [("", ends[q], self.goal)] * (ends[q] < FAR))
        self.price = [0] * (self.goal + 1)

    def auction(self, origin: int) -> None:
        """Raise prices until a path from origin, each of whose arcs leaves no slack, reaches the goal.

        At all times a price is at most an arc's cost and the price it leads to, and equal to it
        along the path. The path's last node either takes the best arc (extension), or, where
        its price is below that, has its price raised and leaves the path (contraction). No
        cycle is free, so it ends; then origin's price is the cost of the cheapest path.
        """
        price, path = self.price, [origin]
        while (node := path[-1]) != self.goal:
            best, to = FAR, -1
            for _, cost, nxt in self.arcs[node]:
                if cost + price[nxt] < best:
                    best, to = cost + price[nxt], nxt
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)

    def solve(self) -> list[int]:
        """The cost to come from each state before the first row."""
        # From the last rows on: an auction starts with prices that are already right behind it.
        for node in range(4 * self.n + 3, -1, -1):
            self.auction(node)
        return self.price[:4]

    def trace(self, q: int) -> tuple[str, int]:
        """(edits, state behind the last row) of the cheapest path from state q whose edits come first in ASCII order.

        Every price is a shortest distance, so each tight arc goes on to the goal, and the first
        one of each node is taken. The edits of a node differ.
        """
        edits, node = [], q
        while True:
            edit, _, nxt = min(arc for arc in self.arcs[node] if arc[1] + self.price[arc[2]] == self.price[node])
            if nxt == self.goal:
                return "".join(edits), node - 4 * self.n
            edits.append(edit)
            node = nxt


def cheapest_edits(codes: list[tuple[str, bool, bool]]) -> tuple[int, Iterator[str]]:
    """(cost, edits block by block) of a conversation's rows.

    Blocks are solved from the last: the prices before a block are the costs behind the one
    before it. Of each block only its prices at the border stay; it is solved again for its trace.
    """
    starts = range(0, len(codes), BLOCK)
    ends = [[0, FAR, FAR, 0]]
    for at in reversed(starts):
        ends.append(Block(codes[at : at + BLOCK], ends[-1]).solve())
    cost = ends[-1][START] if starts else 0

    def traced():
        q = START
        for k, at in enumerate(starts):
            block = Block(codes[at : at + BLOCK], ends[len(starts) - k - 1])
            block.solve()
            edits, q = block.trace(q)
            yield edits

    return cost, traced()


def damage(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) damaged by crc32 of `conv_id:turn` mod 20.

    0 drops the row, 1 empties its text, 2 takes . ! and ? out of it, 3 repeats the row, 4 makes
    its role user. A null is one space in the hash, as a role and as a text.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = conversations.select("conv_id", "turn", F.when(draw == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), draw.alias("draw")).where("draw <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("draw", "copy")


def _faults(plain: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, initial, blank, truncated, repeat); repeat: an earlier turn, null first, has the same role and text."""
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = plain.groupBy("conv_id", "role", "text").agg(F.min(turn).alias("least"))
    same = F.col("x.conv_id").eqNullSafe(F.col("y.conv_id")) & (F.col("x.role") == F.col("y.role")) & (F.col("x.text") == F.col("y.text"))
    both = plain.alias("x").join(firsts.alias("y"), same)
    last = F.right(F.rtrim(F.col("x.text"), F.lit(WHITE)), F.lit(1))
    return both.select("x.conv_id", "x.turn", "x.role", "x.text", F.left("x.role", F.lit(1)).alias("initial"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), (~F.col("least.turn").eqNullSafe(F.col("x.turn"))).alias("repeat"))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
LEGAL = {"su", "ua", "au"}
_COUNTS = [(c, pa.int64()) for c in COUNTS]
_EDITS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("edits", pa.string()), *_COUNTS])


class Held:
    """What a task holds of a conversation at hand: a reference to the code of each row, and counts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.before = conv_id, [], None
        self.low = self.high = None
        self.turns, self.counts = 0, dict.fromkeys(COUNTS, 0)

    def add(self, turn, role: str, text: str, initial: str, blank: bool, truncated: bool, repeat: bool) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        # Rows of one turn, role and text are neighbours.
        duplicate = not blank and (repeat or self.before is not None and self.before[:3] == (turn, role, text))
        fault = "blank" if blank else "duplicate" if duplicate else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before[3] + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = (turn, role, text, initial)
        # Of initials that no role of the order has, one stands for all.
        self.codes.append(CODES[initial if initial in NEXT else "x", blank or duplicate, fault == "truncated"])

    def rows(self) -> Iterator[tuple]:
        """Rows of _EDITS: edits in parts of some PART each, and the counts with the first."""
        self.counts["cost"], edits = cheapest_edits(self.codes)
        self.counts["gaps"] = self.high - self.low + 1 - self.turns if self.turns else 0
        part, held = 0, ""
        for some in edits:
            held += some
            if len(held) >= PART:
                yield self._row(part, held)
                part, held = part + 1, ""
        if held or not part:
            yield self._row(part, held)

    def _row(self, part: int, edits: str) -> tuple:
        return (self.conv_id, part, edits, *(self.counts[c] if part == 0 else None for c in COUNTS))


CODES = {c: c for c in ((i, a, b) for i in (*NEXT, "x") for a in (False, True) for b in (False, True))}


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    return batches_of(2000, rows, schema)


def _edits(rows: DataFrame) -> DataFrame:
    """Rows of _EDITS for each conversation."""

    def solved(batches):
        held = None
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or conv_id != held.conv_id:
                    if held is not None:
                        yield from held.rows()
                    held = Held(conv_id)
                held.add(*row)
        if held is not None:
            yield from held.rows()

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(lambda batches: _batched(solved(batches), _EDITS), "conv_id long, part int, edits string, " + ", ".join(f"{c} long" for c in COUNTS))


def _walk(batches) -> Iterator[tuple]:
    """(conv_id, counts, audit, event) in order; event is (role, text, edit) of an edit, or None at the conversation's end.

    A conversation's edits come before its rows; a row takes the insertions before it and its own edit.
    """
    conv_id, counts, audit, at, state = None, None, "", 0, START

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            role, state, at = TURN[state], NEXT[TURN[state][0]][state], at + 1
            yield conv_id, counts, audit, (role, "", INSERT)

    for batch in batches:
        for own_id, role, text, part, edits, *some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part == 0:
                if counts is not None:
                    yield from inserted()
                    yield conv_id, counts, audit, None
                conv_id, counts, audit, at, state = own_id, some, "", 0, START
            if part is not None:
                audit += edits
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == REROLE:
                role = TURN[state]
            if edit != DELETE:
                state = NEXT[role[:1]][state]
            yield conv_id, counts, audit, (role, text, edit)
    if counts is not None:
        yield from inserted()
        yield conv_id, counts, audit, None


def _with_edits(conversations: DataFrame) -> DataFrame:
    """Each conversation's parts of edits, then its rows, in one partition."""
    plain = conversations.select(*(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    both = materialise(_edits(_faults(plain)), "edits").unionByName(plain, allowMissingColumns=True)
    dealt = both.withColumn("behind", F.col("part").isNull()).repartition("conv_id").sortWithinPartitions("conv_id", "behind", "part", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text", "part", "edits", *COUNTS)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the repaired rows, and deleted ones with a null place, of conversations (conv_id, turn, role, text).

    See audit for rules. place counts from 0.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def apply(batches):
        place = 0
        for conv_id, _, _, event in _walk(batches):
            if event is None:
                place = 0
                continue
            gone = event[2] == DELETE
            yield conv_id, None if gone else place, *event
            place += not gone

    return _with_edits(conversations).mapInArrow(lambda batches: _batched(apply(batches), schema), "conv_id long, place long, role string, text string, edit string")


def audit(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id of conversations (conv_id, turn, role, text): its faults, cheapest edits, and the digest of what they leave.

    A conversation's rows are taken by turn, null first, then role and text. A null role or text
    is one space; a null conv_id is an id like any other. First faults are counted: blank (white
    space alone), duplicate (role and text of an earlier row), truncated (the last character
    that is not white is none of . ! ?). gaps: turns missing between the least and the greatest.
    illegal: neighbours whose roles' initials are not su, ua or au; a role without characters
    has none. Edits keep a row (0), give it the role user or assistant (3), delete it (4; blank
    rows and duplicates must go) or insert an empty row of those roles (3); a truncated row that
    stays costs 3 more. They leave an optional system row and pairs of user and assistant, or
    nothing. cost: of the cheapest edits; audit: their initials, of several the least in ASCII
    order; repaired_sha256: of the lines role:text that stay.

    Rows of a conversation pass through one task in order, for its digest is one; of its rows
    the task holds 8 bytes each. An empty table has no conversations. Other columns are left alone.
    """
    schema = pa.schema([("conv_id", pa.int64()), *_COUNTS, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digest(batches):
        sha, first = hashlib.sha256(), True
        for conv_id, counts, edits, event in _walk(batches):
            if event is None:
                yield conv_id, *counts, edits, sha.hexdigest()
                sha, first = hashlib.sha256(), True
            elif event[2] != DELETE:
                sha.update((("" if first else "\n") + f"{event[0]}:{event[1]}").encode("utf-8", "replace"))
                first = False

    return _with_edits(conversations).mapInArrow(lambda batches: _batched(digest(batches), schema), "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
