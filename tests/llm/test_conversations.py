"""Conversation repair against all repairs tried out, with inserted turns."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from foldcat.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(SPACE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def plain_repair(rows):
    """Uniform-cost search over all edits; the queue's order is (cost, audit)."""
    found, queue, done = faults(rows), [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, place, state, lines = heapq.heappop(queue)
        if place == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        if (place, state, len(audit)) in done:
            continue
        done.add((place, state, len(audit)))
        for new, name in (("u", "user"), ("a", "assistant")):
            if new in NEXT[state]:
                if audit.count("I") < 3:
                    heapq.heappush(queue, (cost + 5, audit + "I", place, new, (*lines, f"{name}:")))
                if place < len(rows) and found[place] not in ("blank", "duplicate"):
                    more = 1 + 5 * (found[place] == "truncated")
                    heapq.heappush(queue, (cost + more, audit + "R", place + 1, new, (*lines, f"{name}:{rows[place][1]}")))
        if place < len(rows):
            heapq.heappush(queue, (cost + 2, audit + "D", place + 1, state, lines))
            role, text = rows[place]
            if found[place] not in ("blank", "duplicate") and role[:1] and role[:1] in NEXT[state]:
                more = 5 * (found[place] == "truncated")
                heapq.heappush(queue, (cost + more, audit + "K", place + 1, role[0], (*lines, f"{role}:{text}")))


def damage(conversations):
    out = defaultdict(list)
    for conv, turn, role, text in conversations:
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain(conversations):
    result = {}
    for conv, rows in damage(conversations).items():
        # Rows of one turn: by role, then by digest of content.
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = [t for t, _, _ in rows if t is not None]
        said = [(role, text) for _, role, text in rows]
        kinds, pairs = faults(said), [a[:1] + b[:1] for (a, _), (b, _) in zip(said, said[1:])]
        cost, audit, whole = plain_repair(said)
        result[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256(whole.encode()).hexdigest(),
        )
    return result


def check(spark, rows):
    got = repair.repair_damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    want = plain(rows)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    return want


def made(rng, n, conv):
    role = lambda: rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
    text = lambda: rng.choice(["Yes.", "No!", "Why?", "so", "", " \n", None, "a. ", "é…", "b?\t"]) if rng.random() < 0.6 else f"{rng.random()}."
    return [(conv, rng.choice([None, *range(n + 3)]) if rng.random() < 0.2 else k, role(), text()) for k in range(n)]


def test_made_conversations(spark):
    rng = random.Random(5)
    rows = [r for conv in range(150) for r in made(rng, rng.randrange(1, 9), conv)]
    rows += [(None, k, *r[2:]) for k, r in enumerate(made(rng, 9, 0))]
    rng.shuffle(rows)
    want = check(spark, rows)
    assert {"D", "K", "R"} <= set("".join(w[6] for w in want.values()))
    assert not any("I" in w[6] for w in want.values())


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_blocks_change_nothing(spark, monkeypatch, bits):
    """Conversations over many blocks, their paths joined at the ends of blocks."""
    monkeypatch.setattr(repair, "_BLOCK_BITS", bits)
    rng = random.Random(bits)
    check(spark, [r for conv in range(12) for r in made(rng, 14, conv)])


def test_one_conversation_has_most_rows(spark):
    """6,000 rows of one conversation, half of them equal: its repair is that of one pass over all rows."""
    rng = random.Random(2)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"{k}.", f"{k}"])) for k in range(6_000)]
    rows += [(2, k, "user", "x.") for k in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in repair.repair_damaged(frame).collect()}
    said = [(role, text) for _, role, text in sorted(damage(rows)[1], key=lambda r: r[0])]
    kinds = faults(said)
    paths = repair.cheapest([(r[:1], k) for (r, _), k in zip(said, kinds)], repair.START)
    cost, steps = min((c, s) for e, (c, s) in paths.items() if e in (repair.START, repair.ASSISTANT))
    assert (got[1].cost, got[1].audit) == (cost, steps.replace("u", "R").replace("a", "R"))
    assert got[1].duplicate == kinds.count("duplicate") > 1_000
    ordered = repair.ordered_turns(repair.damage(frame))
    sizes = repair.segments(repair.with_faults(ordered)).selectExpr("length(moves[0].steps) AS n").collect()
    assert max(r.n for r in sizes) <= repair.BLOCK


def test_repaired_turns_are_the_digested_ones(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    ordered = repair.ordered_turns(repair.damage(rows))
    _, steps = repair.plan_repairs(ordered)
    lines = defaultdict(list)
    for r in sorted(repair.repaired_turns(ordered, steps).collect(), key=lambda r: r["at"]):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for r in repair.digests(ordered, steps).collect():
        roles = "".join(line[0] for line in lines[r.conv_id])
        assert re.fullmatch("(s?(ua)+)?", roles)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(lines[r.conv_id]).encode()).hexdigest()


def test_empty_and_dropped(spark):
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(k for k in range(1_000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    (row,) = repair.repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_extra_columns_and_long_texts(spark):
    rng = random.Random(9)
    rows = [(1, k, role, "word " * 200_000 + f"{k}.") for k, role in enumerate(("user", "assistant"))]
    rows += made(rng, 6, 2)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS at", "2 AS content", "3 AS steps", "4 AS `a.b`", "5 AS cost")
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_damaged(frame).collect()}
    assert got == plain(rows)
