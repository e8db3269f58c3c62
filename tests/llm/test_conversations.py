"""Conversation repair against a search of all edits in order of cost and letters."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tidewire.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string"
LETTERS = {"s": "S", "u": "U", "a": "A"}


def damaged(rows):
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        yield from [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)


def order(row):
    return row[1] is not None, row[1] or 0, row[2].encode(), row[3].encode()


def brute(rows):
    """What audit says of one conversation's rows, by Dijkstra over (cost, edits) and all strings of roles that can still become right."""
    rows, seen, faults = sorted(rows, key=order), set(), []
    for _, _, role, text in rows:
        black = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not black else "duplicate" if (role, text) in seen else "truncated" if black[-1] not in ".!?" else "")
        seen.add((role, text))
    may = {"": "su", "s": "u", "u": "a", "a": "u"}  # by the last role
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            break
        for role in ("user", "assistant"):
            if role[0] in may[last]:
                heapq.heappush(heap, (cost + 3, edits + "I", i, role[0], (*out, (role, ""))))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, last, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if not role or role[0] in may[last]:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, role[:1] or last, (*out, (role, text))))
                for new in ("user", "assistant"):
                    if new[0] in may[last]:
                        heapq.heappush(heap, (cost + 3 + more, edits + "R", i + 1, new[0], (*out, (new, text))))
    turns = {t for _, t, _, _ in rows if t is not None}
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    counts = [max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost]
    return (*counts, edits, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()), out


def random_rows(seed, n=60):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "", None, "tool", "User", "ü"], ["Yes.", "No!", "Why?", "well", "", " \n", None, "a:b\n.", "x\x00", "  so. ", "...", "z\x1f"]
    for conv in (*range(n), None):
        for _ in range(rng.randrange(1, 12)):
            yield conv, rng.choice([*range(8), None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"{rng.random()}."


def test_random_conversations(spark):
    rows = list(random_rows(3))
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    held = list(damaged(rows))
    assert sorted(map(str, C.damage(df).collect())) == sorted(str(r) for r in spark.createDataFrame(held, ROWS).collect())
    found = {r.conv_id: tuple(r)[1:] for r in C.audit(C.damage(df)).collect()}
    wanted = {c: brute([r for r in held if r[0] == c])[0] for c in {r[0] for r in held}}
    assert found == wanted


def test_repaired_rows(spark):
    rows = list(random_rows(4, 30))
    df = spark.createDataFrame(rows, ROWS)
    found = {}
    for r in C.repair(df).collect():
        if r.place is not None:
            found.setdefault(r.conv_id, {})[r.place] = (r.role, r.text)
    plain = [(c, t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows]
    for c in {r[0] for r in rows}:
        out = brute([r for r in plain if r[0] == c])[1]
        assert found.get(c, {}) == dict(enumerate(out))


@pytest.mark.parametrize("n", [1, C.BLOCK - 1, C.BLOCK, 5 * C.BLOCK + 3])
def test_blocks_of_a_long_conversation(n):
    rng = random.Random(n)
    codes = [rng.choice(list(C.CODES)) for _ in range(n)]
    cost, edits = C.cheapest_edits(codes)
    heap, done = [(0, "", 0, 0)], set()
    while True:
        total, best, i, q = heapq.heappop(heap)
        if i == n and q in (C.START, C.ASSISTANT):
            break
        if (i, q) not in done:
            done.add((i, q))
            for edit, more, to, takes in C.arcs(q, codes[i] if i < n else ("x", True, False)):
                if i < n or not takes:
                    heapq.heappush(heap, (total + more, best + edit, i + takes, to))
    assert (cost, "".join(edits)) == (total, best)


def test_edits_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "PART", 5)
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t}.") for t in range(400)]
    assert tuple(C.audit(spark.createDataFrame(rows, ROWS)).first())[1:] == brute(rows)[0]


def test_empty_and_other_columns(spark):
    assert C.audit(C.damage(spark.createDataFrame([], ROWS))).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 7, "x", "y"), (1, 1, "assistant", "Ho.", 8, "x", "y")], ROWS + ", part int, edits string, blank string")
    assert [(r.role, r.place, r.edit) for r in C.repair(df).orderBy("place").collect()] == [("user", 0, "K"), ("assistant", 1, "K")]
