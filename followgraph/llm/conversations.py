"""Operator 11, conversation structure repair: the cheapest edits that make a
conversation's roles read ``(system? (user assistant)+)?``.

Turns are ordered by ``turn`` (null first), ties by role and text.  A turn's
first fault counts: ``blank`` (no character besides space and ``\\x09-\\x0D``),
``duplicate`` (role and text occurred before in the conversation),
``truncated`` (its last other character is none of ``.!?``).  Keeping a turn
costs 0, Rerole to user or assistant 3, Delete 4 (the only edit for blank and
duplicate turns), Insert of an empty user or assistant turn 3; a truncated
turn that stays adds 3.  Among the cheapest edits those whose initials
(D < I < K < R) are least are taken.

Secondary sort: turns are dealt by conversation once and sorted inside the
partitions.  A first stream in descending order carries the dynamic program
(the cost of the rest from each of the four states of the pattern) from Arrow
batch to Arrow batch and adds to each turn one byte: the best edit in each
state.  These bytes are the backpointers; they go through Spark's external
sort into ascending order with their turns, so a conversation of any length
spills with them.  A second stream follows them from the start and gives out
the repaired turns.  A worker holds one batch, a few numbers and, in
:func:`digest`, one letter for each edit of the conversation at hand.

A repaired text is one string in order, so a conversation is streamed by one
task however long it is; faults and damage are found before the turns are
dealt.

Null roles and texts read as one space; an empty role has no initial and
cannot be kept.  Null conversation ids are one conversation.  Repeated rows are turns like others (so duplicates of the
first).  A conversation all of whose turns are absent has one row without
edit.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm import ship

BLANK = " \t\n\x0b\x0c\r"
FAULTS = ("", "blank", "duplicate", "truncated")
RANK = {f: i for i, f in enumerate(FAULTS)}

DELETE, INSERT, KEEP, REROLE = range(4)  # in the order of their initials
LETTERS = "DIKR"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The only role that can be inserted (or given) in each state, and the state after it.
GIVEN = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
FINAL = (True, False, False, True)
#: Cost of the rest after the last turn: what is missing is inserted.
ENDED = (0, 2 * INSERT_COST, INSERT_COST, 0)

_SCHEMA = "conv_id {id}, place long, turn long, edit string, was string, role string, text string, fault string, cost int"
_DIGEST = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def fault(text: Column, nth: Column) -> Column:
    """Number of the first fault in ``FAULTS`` of a turn that is its ``nth`` alike."""
    rest = F.rtrim(text, F.lit(BLANK))
    return (
        F.when(rest == "", 1).when(nth > 1, 2).when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    )


def step(rest: tuple, kind: int) -> tuple[tuple, int]:
    """Costs from each state before a turn of this kind (initial and fault),
    less their minimum, given those after it; and the best edits, two bits a state."""
    initial, wrong = "sua-"[kind >> 2], kind & 3
    late = TRUNCATED_COST if wrong == RANK["truncated"] else 0
    options = []
    for state in range(4):
        found = {DELETE: DELETE_COST + rest[state]}
        if wrong in (RANK[""], RANK["truncated"]):
            if initial in STEPS[state]:
                found[KEEP] = late + rest[STEPS[state][initial]]
            found[REROLE] = REROLE_COST + late + rest[GIVEN[state][1]]
        options.append(found)
    plain = [min(x.values()) for x in options]
    user = min(plain[2], INSERT_COST + plain[3])
    best = (min(plain[0], INSERT_COST + user), min(plain[1], INSERT_COST + user), user, min(plain[3], INSERT_COST + plain[2]))
    code = 0
    for state, found in enumerate(options):
        found[INSERT] = INSERT_COST + best[GIVEN[state][1]]
        code |= min(edit for edit, cost in found.items() if cost == best[state]) << (2 * state)
    least = min(best)
    return tuple(x - least for x in best), code


def backwards(batches: Iterator[pa.RecordBatch], schema: pa.Schema | None = None) -> Iterator[pa.RecordBatch]:
    """Adds ``edits`` to turns in descending order."""
    rest, current, memo = ENDED, object(), {}
    for batch in batches:
        ids, kinds = batch.column("conv_id").to_pylist(), batch.column("kind").to_pylist()
        out = bytearray(len(ids))
        for i, (conv, kind) in enumerate(zip(ids, kinds)):
            if conv != current:
                rest, current = ENDED, conv
            if kind is not None:
                found = memo.get((rest, kind))
                if found is None:
                    found = memo[rest, kind] = step(rest, kind)
                rest, out[i] = found
        column = pa.Array.from_buffers(pa.uint8(), len(out), [None, pa.py_buffer(bytes(out))]).cast(pa.int16())
        yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "edits"])


def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of turns in ascending order with their ``edits``."""
    current, state, place, begun = None, 0, 0, False
    out: list = []
    id_type = None

    def emit(turn, edit, was, role, text, wrong, cost):
        nonlocal place
        out.append((current, place, turn, edit, was, role, text, wrong, cost))
        place += 1

    def insert():
        nonlocal state
        role, state = GIVEN[state]
        emit(None, "I", None, role, "", None, INSERT_COST)

    def close():
        while not FINAL[state]:
            insert()
        if not place:
            emit(None, None, None, None, None, None, 0)

    def flush():
        rows = list(zip(*out)) if out else [()] * 9
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(rows, (id_type, pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int32()))],
            names=["conv_id", "place", "turn", "edit", "was", "role", "text", "fault", "cost"],
        )

    for batch in batches:
        id_type = batch.column("conv_id").type
        rows = (batch.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text", "kind", "edits"))
        for conv, turn, role, text, kind, edits in zip(*rows):
            if not begun or conv != current:
                if begun:
                    close()
                current, state, place, begun = conv, 0, 0, True
            if kind is None:
                continue
            while (edit := edits >> 2 * state & 3) == INSERT:
                insert()
            wrong = kind & 3
            late = TRUNCATED_COST if wrong == RANK["truncated"] else 0
            if edit == DELETE:
                emit(turn, "D", role, None, None, FAULTS[wrong] or None, DELETE_COST)
            elif edit == KEEP:
                state = STEPS[state][role[:1]]
                emit(turn, "K", role, role, text, FAULTS[wrong] or None, late)
            else:
                given, state = GIVEN[state]
                emit(turn, "R", role, given, text, FAULTS[wrong] or None, REROLE_COST + late)
        yield flush()
    if begun:
        close()
        yield flush()


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """Edited turns of ``turns`` (``conv_id, turn, role, text``).

    One row for each edit, numbered from 0 by ``place`` in each conversation:
    ``turn`` and the role it ``was`` (null for insertions), the ``edit``'s
    initial, ``role`` and ``text`` after it (null if deleted), the ``fault``
    and the edit's ``cost``.  Rows where ``present`` is not true only name a
    conversation.  Partitions hold whole conversations, in order.
    """
    ship.package(turns.sparkSession)
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    alike = F.sha2(F.concat_ws("\0", "role", "text"), 256)
    rows = (
        turns.select(
            "conv_id",
            F.when(here, F.col("turn").cast("long")).alias("turn"),
            F.when(here, F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(here, F.coalesce("text", F.lit(" "))).alias("text"),
        )
        .withColumn("alike", F.when(F.col("role").isNotNull(), alike))
        .repartition("conv_id")
    )
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"), F.asc("nth")]
    back = [F.desc_nulls_last("turn"), F.desc_nulls_last("role"), F.desc_nulls_last("text"), F.desc("nth")]
    nth = F.row_number().over(Window.partitionBy("conv_id", "alike").orderBy(*order[:3]))
    first = F.left("role", F.lit(1))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    kind = F.when(F.col("role").isNotNull(), initial * 4 + fault(F.col("text"), F.col("nth"))).cast("short")
    known = rows.withColumn("nth", nth).select("conv_id", "turn", "role", "text", "nth", kind.alias("kind"))
    down = known.sortWithinPartitions(F.desc("conv_id"), *back)
    marked = down.mapInArrow(backwards, known.schema.add("edits", "short"))
    up = marked.sortWithinPartitions(F.asc("conv_id"), *order).drop("nth")
    return up.mapInArrow(forwards, _SCHEMA.format(id=turns.schema["conv_id"].dataType.simpleString()))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of edited turns in order."""
    current, begun, id_type = None, False, None
    out: list = []

    def fresh():
        return {"low": None, "high": None, "distinct": 0, "faults": dict.fromkeys(FAULTS[1:], 0), "illegal": 0, "before": None, "cost": 0, "audit": bytearray(), "sha": hashlib.sha256(), "lines": 0}

    def close():
        gaps = 0 if now["low"] is None else min(now["high"] - now["low"] + 1 - now["distinct"], (1 << 63) - 1)
        out.append((current, gaps, *now["faults"].values(), now["illegal"], now["cost"], now["audit"].decode(), now["sha"].hexdigest()))

    def flush():
        rows = list(zip(*out)) if out else [()] * 9
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(rows, (id_type, *[pa.int64()] * 6, pa.string(), pa.string()))],
            names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
        )

    for batch in batches:
        id_type = batch.column("conv_id").type
        rows = (batch.column(x).to_pylist() for x in ("conv_id", "turn", "edit", "was", "role", "text", "fault", "cost"))
        for conv, turn, edit, was, role, text, wrong, cost in zip(*rows):
            if not begun or conv != current:
                if begun:
                    close()
                current, begun, now = conv, True, fresh()
            if edit is None:
                continue
            if turn is not None and turn != now["high"]:
                now["low"] = turn if now["low"] is None else now["low"]
                now["high"] = turn
                now["distinct"] += 1
            if wrong:
                now["faults"][wrong] += 1
            if was is not None:
                if now["before"] is not None:
                    now["illegal"] += now["before"] + was[:1] not in ("su", "ua", "au")
                now["before"] = was[:1]
            now["cost"] += cost
            now["audit"] += edit.encode()
            if role is not None:
                now["sha"].update(("\n" * (now["lines"] > 0) + role + ":" + text).encode())
                now["lines"] += 1
        yield flush()
    if begun:
        close()
        yield flush()


def digest(edited: DataFrame) -> DataFrame:
    """One row for each conversation of :func:`repair`'s result: gaps in the
    turn numbers, faults, illegal neighbours, cost, the edits' initials and the
    SHA-256 of the repaired turns (``role:text`` joined by line feeds)."""
    return edited.mapInArrow(digests, _DIGEST.format(id=edited.schema["conv_id"].dataType.simpleString()))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with known damage, by ``crc32(conv_id:turn) % 20`` (nulls one
    space): 0 drops a turn (``present`` is false), 1 empties its text, 2
    removes ``.!?``, 3 repeats it, 4 sets the role user."""
    spaced = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn", "role", "text")]
    hit = F.crc32(F.concat_ws(":", *spaced[:2])) % 20
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        turns.select("conv_id", "turn", spaced[2].alias("role"), spaced[3].alias("text"), hit.alias("hit"))
        .select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "hit")
        .withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text", (F.col("hit") != 0).alias("present"))
    )
