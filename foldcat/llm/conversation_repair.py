"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

Rows of a conversation are taken by turn. A row is blank, a duplicate or truncated, whichever comes
first. Rows are kept, given another role or deleted until the roles' initials read ``(s?(ua)+)?``. Costs:

* keep 0, but 5 more for a truncated row that stays; give it the role user or assistant 1; delete 2;
* blank and duplicate rows must be deleted;
* insert an empty turn of user or assistant 5. No cheapest repair has one: its partner in the pair ``ua``
  can be deleted instead with it, and with the last pair the system row, for 4 at most. So edges for
  inserted turns are left out, and a repair has one letter for each row.

The repair is a shortest path through a graph of (row, state of the pattern). An edge weighs one big
integer: its cost in the high digits, and in a low digit of three bits, whose place is that of the row,
the letter of the edit. Plain integer minima so find the least cost and, among equal costs, the audit
that is least as text (D < I < K < R; 0 ends it).

A conversation may hold a third of all rows, so the path is found by blocks:

1. Rows are sorted by ranges (conversation, turn) and numbered; ``BLOCK`` consecutive numbers are a block.
   A row repeats an earlier one if it is not the least number of its conversation and content.
2. Each block gives, for each conversation in it, the cheapest paths from each state to each state.
3. One pass over these, in order, finds the states between blocks: of paths of equal length, it needs the
   cost of a prefix and its place among the prefixes that end in the other states, no letters.
4. The chosen letters go back to the rows by number. Nothing holds a conversation, but the result: its
   audit is one text and its digest one hash, so one task streams its repaired lines.

Defined results: NULL roles and texts count as one space. NULL turns come first; rows of one turn are
taken by role and then by content digest. Rows of a NULL ``conv_id`` are one conversation. Repeated rows
are duplicates. Texts are moved twice and stored once, and read whole. Extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foldcat.llm.ordering import placed
from foldcat.llm.text import bound_batches
from foldcat.staging import stored

REROLE, DELETE, TRUNCATED = 1, 2, 5
_BLOCK_BITS = 10
BLOCK = 1 << _BLOCK_BITS

# The states of the pattern, and where a role's initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
_ENDS = (START, ASSISTANT)
_LEGAL = ("su", "ua", "au")
# Digits of the letters D, I, K, R; R is told by the role that it gives.
_D, _K, _R = 1, 3, 4
_BITS = 3
# Rows go to Spark when so many characters wait.
_MOST_HELD = 1 << 22
_SPACES = " \t\n\x0b\x0c\r"
_COUNTS = ["blank", "duplicate", "truncated"]


def ordered_turns(rows: DataFrame) -> DataFrame:
    """The rows in order of conversation and turn, stored: conv_id, turn, role, text, content, at."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    shaped = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    shaped = shaped.withColumn("content", F.unhex(F.sha2(content, 256)))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("content")]
    return placed(shaped, order, "turns")


def with_faults(ordered: DataFrame) -> DataFrame:
    """Without texts: conv_id, turn, at, initial, fault (blank, duplicate, truncated or NULL)."""
    last = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    narrow = ordered.select("conv_id", "turn", "at", F.left("role", F.lit(1)).alias("initial"), last.alias("last"))
    firsts = ordered.groupBy("conv_id", "content").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("last") == "", "blank").when(F.col("new").isNull(), "duplicate")
    fault = fault.when(~F.col("last").isin(".", "!", "?"), "truncated")
    return narrow.join(firsts, "at", "left").select("conv_id", "turn", "at", "initial", fault.alias("fault"))


def cheapest(rows: list[tuple[str, str | None]], start: int) -> dict[int, tuple[int, str]]:
    """Of the repairs of rows (initial, fault) from a state: by last state, the least (cost, steps).

    Steps are K, D, or the initial of the role that is given.
    """
    width = _BITS * len(rows)
    best = {start: 0}
    came: list[dict[int, tuple[int, str]]] = []
    for place, (initial, fault) in enumerate(rows, 1):
        digit = width - _BITS * place
        edges = []
        for state in best:
            edges.append((state, state, DELETE, _D, "D"))
            if fault in ("blank", "duplicate"):
                continue
            stays = TRUNCATED if fault == "truncated" else 0
            for symbol, to in _NEXT[state].items():
                if symbol == initial:
                    edges.append((state, to, stays, _K, "K"))
                if symbol != "s":
                    edges.append((state, to, stays + REROLE, _R, symbol))
        after: dict[int, int] = {}
        steps: dict[int, tuple[int, str]] = {}
        for state, to, cost, letter, step in edges:
            value = best[state] + (cost << width) + (letter << digit)
            if to not in after or value < after[to]:
                after[to], steps[to] = value, (state, step)
        best = after
        came.append(steps)
    found = {}
    for end, value in best.items():
        path, state = [], end
        for steps in reversed(came):
            state, step = steps[state]
            path.append(step)
        found[end] = (value >> width, "".join(reversed(path)))
    return found


def _audit(steps: str) -> str:
    return steps.replace("u", "R").replace("a", "R")


_MOVES = "array<struct<from:int,to:int,cost:long,steps:string>>"


def segments(marked: DataFrame) -> DataFrame:
    """What each block holds of each conversation: counts, both ends, and the cheapest paths through it."""
    key = marked.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key)])
    fields = "first_at long, first string, last string, illegal long, low long, high long, turns long"
    for name, kind in (part.split() for part in (*fields.split(", "), *[f"{c} long" for c in _COUNTS])):
        schema = schema.add(name, kind)
    schema = schema.add("moves", T.DataType.fromDDL(_MOVES))

    def of_block(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["at"])
        out = []
        for conv_id, own in groupby(rows, key=lambda r: r["conv_id"]):
            own = list(own)
            # Only the conversation that the block begins with can have rows before it.
            starts = range(len(_NEXT)) if own[0] is rows[0] else [START]
            roles = [(r["initial"], r["fault"]) for r in own]
            paths = [(s, e, *found) for s in starts for e, found in cheapest(roles, s).items()]
            turns = [r["turn"] for r in own if r["turn"] is not None]
            out.append(
                {
                    "conv_id": conv_id,
                    "first_at": own[0]["at"],
                    "first": own[0]["initial"],
                    "last": own[-1]["initial"],
                    "illegal": sum(a["initial"] + b["initial"] not in _LEGAL for a, b in zip(own, own[1:])),
                    "low": min(turns, default=None),
                    "high": max(turns, default=None),
                    "turns": len(set(turns)),
                    **{c: sum(r["fault"] == c for r in own) for c in _COUNTS},
                    "moves": [dict(zip(("from", "to", "cost", "steps"), p)) for p in paths],
                }
            )
        return pa.Table.from_pylist(out, to_arrow_schema(schema))

    narrow = marked.select("conv_id", "turn", "at", "initial", "fault", F.shiftright("at", _BLOCK_BITS).alias("block"))
    return narrow.groupBy("block").applyInArrow(of_block, schema)


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """The rows of sorted batches, one conversation after the other."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda r: r["conv_id"])


def _walk(parts: Iterator[dict]) -> tuple[dict, list[tuple[int, int, int]]]:
    """Of a conversation's segments in order: its counts, and the states (first_at, from, to) of each."""
    total = dict.fromkeys(["illegal", "turns", *_COUNTS], 0)
    low = high = last = None
    costs, places = {START: 0}, {START: 0}
    came: list[tuple[int, dict[int, int]]] = []
    for part in parts:
        for name in total:
            total[name] += part[name]
        if last is not None:
            total["illegal"] += last + part["first"] not in _LEGAL
        if part["low"] is not None:
            total["turns"] -= part["low"] == high
            low, high = part["low"] if low is None else low, part["high"]
        last = part["last"]
        options: dict[int, list] = {}
        for m in part["moves"]:
            if m["from"] in costs:
                value = (costs[m["from"]] + m["cost"], places[m["from"]], _audit(m["steps"]))
                options.setdefault(m["to"], []).append((value, m["from"]))
        best = {to: min(found) for to, found in options.items()}
        costs = {to: value[0] for to, (value, _) in best.items()}
        # Prefixes that end here have one length: their order is all that later comparisons need.
        order = sorted({value[1:] for value, _ in best.values()})
        places = {to: order.index(value[1:]) for to, (value, _) in best.items()}
        came.append((part["first_at"], {to: before for to, (_, before) in best.items()}))
    state = min((costs[s], places[s], s) for s in _ENDS if s in costs)[2]
    total["cost"] = costs[state]
    total["gaps"] = 0 if low is None else high - low + 1 - total.pop("turns")
    path = []
    for first_at, before in reversed(came):
        path.append((first_at, before[state], state))
        state = before[state]
    total.pop("turns", None)
    return total, path


_SUMMARY = ["gaps", *_COUNTS, "illegal", "cost"]


def _walked(parts: DataFrame) -> DataFrame:
    """(conv_id, first_at, from, to) of every segment; a conversation's summary stands on its last one."""
    schema = T.StructType([parts.schema["conv_id"]])
    for name in ("first_at", "from", "to", *_SUMMARY):
        schema = schema.add(name, T.LongType())

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for conv_id, own in _conversations(batches):
            total, path = _walk(own)
            for k, (first_at, before, after) in enumerate(path):
                found = {"conv_id": conv_id, "first_at": first_at, "from": before, "to": after}
                yield found | (dict.fromkeys(_SUMMARY) if k else total)

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), schema)

    spread = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = parts.repartition(spread, "conv_id").sortWithinPartitions("conv_id", "first_at")
    return in_order.mapInArrow(walk, schema)


def plan_repairs(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How the conversations look, and how they are repaired.

    First, one row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost. Second, the
    steps of consecutive rows from number ``at`` on: conv_id, at, steps (a letter each: K, D, or u or a for
    a new role).
    """
    parts = stored(segments(with_faults(ordered)), "turn-segments")
    walked = stored(_walked(parts), "turn-path")
    found = walked.where(F.col("cost").isNotNull()).select("conv_id", *_SUMMARY)
    chosen = walked.select("first_at", "from", "to").join(parts.select("conv_id", "first_at", "moves"), "first_at")
    taken = F.filter("moves", lambda m: (m["from"] == F.col("from")) & (m["to"] == F.col("to")))[0]["steps"]
    return found, chosen.select("conv_id", F.col("first_at").alias("at"), taken.alias("steps"))


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """Of each conversation the rows with their ``step`` and the role that it gives."""

    def rows(own: Iterator[dict]) -> Iterator[dict]:
        steps: Iterator[str] = iter(())
        for row in own:
            if row["steps"] is not None:
                steps = iter(row["steps"])
                continue
            step = next(steps)
            role = {"u": "user", "a": "assistant"}.get(step, row["role"])
            yield {"conv_id": row["conv_id"], "at": row["at"], "step": step, "role": role, "text": row["text"]}

    for conv_id, own in _conversations(batches):
        yield conv_id, rows(own)


def _in_order(ordered: DataFrame, steps: DataFrame) -> DataFrame:
    """Rows by conversation, the steps before the rows that they are for."""
    texts = ordered.select("conv_id", "at", "role", "text")
    spread = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = texts.unionByName(steps, allowMissingColumns=True).repartition(spread, "conv_id")
    return together.sortWithinPartitions("conv_id", "at", F.asc_nulls_last("steps"))


def _batches(rows: Iterator[dict], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(waiting) >= BLOCK or held >= _MOST_HELD:
            yield pa.RecordBatch.from_pylist(waiting, to_arrow_schema(schema))
            waiting, held = [], 0
    yield pa.RecordBatch.from_pylist(waiting, to_arrow_schema(schema))


def repaired_turns(ordered: DataFrame, steps: DataFrame) -> DataFrame:
    """The rows that stay: conv_id, at (increasing in a conversation), step, role, text."""
    schema = T.StructType([ordered.schema["conv_id"]])
    for name, kind in (("at", "long"), ("step", "string"), ("role", "string"), ("text", "string")):
        schema = schema.add(name, kind)

    def edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (row for _, own in _edited(batches) for row in own if row["step"] != "D")
        yield from _batches(kept, schema)

    return _in_order(ordered, steps).mapInArrow(edit, schema)


def digests(ordered: DataFrame, steps: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of each conversation, streamed in order of its rows."""
    schema = T.StructType([ordered.schema["conv_id"]]).add("audit", "string").add("repaired_sha256", "string")

    def of_conversation(conv_id: object, own: Iterator[dict]) -> dict:
        audit, digest, between = [], hashlib.sha256(), b""
        for row in own:
            audit.append(row["step"])
            if row["step"] != "D":
                digest.update(between + f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass"))
                between = b"\n"
        return {"conv_id": conv_id, "audit": _audit("".join(audit)), "repaired_sha256": digest.hexdigest()}

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((of_conversation(*x) for x in _edited(batches)), schema)

    return _in_order(ordered, steps).mapInArrow(digest, schema)


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults that follow from conversation and turn, one kind in a twentieth of them each.

    Dropped, emptied, without sentence ends, repeated, or given the role user. NULLs become one space.
    """
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return damaged.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """One row per conversation: how its damaged rows look, their cost and audit, the repaired text's hash."""
    bound_batches(rows.sparkSession)
    ordered = ordered_turns(damage(rows))
    found, steps = plan_repairs(ordered)
    parts = rows.select("conv_id").distinct().unionByName(found, allowMissingColumns=True)
    parts = parts.unionByName(digests(ordered, steps), allowMissingColumns=True)
    # One row of each kind a conversation; a group also brings the rows of a NULL id together.
    joined = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*_SUMMARY, "audit", "repaired_sha256")])
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    filled = [F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in (*_SUMMARY, *empty)]
    return joined.select("conv_id", *filled)
