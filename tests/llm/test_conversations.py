import hashlib
import itertools
import random
import re
import zlib

import pytest

from followgraph.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile("[^\x20\x09-\x0d]")


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        role, text = shown[2:]
        hit = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        kept = out.setdefault(conv, [])
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        kept += [(turn, role, text)] * (hit != 0) * (1 + (hit == 3))
    for kept in out.values():
        kept.sort(key=lambda x: ((0, 0) if x[0] is None else (1, x[0]), x[1], x[2]))
    return out


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        marks = BLANK.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(turns):
    """The least (cost, audit) over all edits: full words over whole sequences."""
    wrong = faults(turns)
    best = {("", ""): (0, ())}  # (roles so far, audit) -> cost, lines

    def inserted(states):
        for _ in range(len(turns) * 2 + 3):
            new = {}
            for (roles, audit), (cost, lines) in states.items():
                for role in ("user", "assistant"):
                    key = (roles + role[0], audit + "I")
                    if re.fullmatch("s?(ua)*u?", key[0]) and audit.count("I") < 4:
                        new[key] = (cost + 3, (*lines, f"{role}:"))
            if not new.keys() - states.keys():
                return states
            states = {**new, **states}
        return states

    for (turn, role, text), fault in zip(turns, wrong):
        new = {}
        for (roles, audit), (cost, lines) in inserted(best).items():
            new[roles, audit + "D"] = (cost + 4, lines)
            if fault in ("", "truncated"):
                late = 3 * (fault == "truncated")
                if role:  # a turn without a role cannot be kept
                    new[roles + role[0], audit + "K"] = (cost + late, (*lines, f"{role}:{text}"))
                for given in ("user", "assistant"):
                    key = (roles + given[0], audit + "R")
                    new[key] = (cost + late + 3, (*lines, f"{given}:{text}"))
        best = {k: v for k, v in new.items() if re.fullmatch("(s?(ua)*u?)?", k[0])}
    ends = [(cost, audit, lines) for (roles, audit), (cost, lines) in inserted(best).items() if re.fullmatch("(s?(ua)+)?", roles)]
    cost, audit, lines = min(ends, key=lambda x: x[:2])
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(turns)]
    return (
        gaps,
        *[wrong.count(x) for x in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def random_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randrange(1, 6)):
            turn = None if rng.random() < 0.05 else turn + rng.randrange(2) * 3
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No.", "Yes", "A b?", "\t", "", None, "é ", "long é. \n"])
            rows.append((conv, turn, role, text))
    rng.shuffle(rows)
    return rows


def rows_of(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_agrees_with_all_edits(spark):
    rows = random_rows(3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = rows_of(conversations.digest(conversations.repair((x := conversations.damaged(df)), x.present)))
    want = damage(rows)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        assert got[conv] == brute(turns), (conv, turns)


def test_given_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in queries.table(spark, path, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = rows_of(queries.op11_conversations(spark, path))
    want = damage(rows)
    assert got.keys() == want.keys()
    short = {c: t for c, t in want.items() if len(t) <= 5}
    assert len(short) > 30
    for conv, turns in short.items():
        assert got[conv] == brute(turns), (conv, turns)


def test_edited_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "There"), (1, 4, "assistant", "Ok.")]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    # a truncated turn that stays costs 3: deleting it is cheaper than a second pair
    assert [(r["edit"], r["was"], r["role"], r["fault"]) for r in got] == [
        ("K", "user", "user", None),
        ("D", "user", None, "duplicate"),
        ("D", "user", None, "truncated"),
        ("K", "assistant", "assistant", None),
    ]


def test_long_conversation_over_many_batches(spark):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        n = 5_001
        rows = spark.range(n).selectExpr(
            "cast(1 as long) conv_id", "id turn", "case when id % 2 = 0 then 'user' else 'assistant' end role", "concat('t', id, '.') text"
        )
        out = conversations.digest(conversations.repair(rows)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    lines = [f"{'ua'[i % 2] and ('user', 'assistant')[i % 2]}:t{i}." for i in range(n)] + ["assistant:"]
    assert len(out) == 1
    assert out[0]["audit"] == "K" * n + "I" and out[0]["cost"] == 3 and out[0]["gaps"] == 0
    assert out[0]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.digest(conversations.repair(empty)).collect() == []
    # numbers at either end of the range; extra columns that look like the operator's own
    wide = spark.createDataFrame([("a", -(1 << 63), "user", "x."), ("a", (1 << 63) - 1, "assistant", "y.")], "conv_id string, turn long, role string, text string")
    wide = wide.selectExpr("*", "1 kind", "2 nth", "3 alike", "'x' edit", "'y' present")
    (row,) = conversations.digest(conversations.repair(wide)).collect()
    assert row["gaps"] == (1 << 63) - 1 and row["audit"] == "KK" and row["conv_id"] == "a"
    # all turns absent
    gone = spark.createDataFrame([(7, 1, "user", "x.")], SCHEMA)
    from pyspark.sql import functions as F

    (row,) = conversations.digest(conversations.repair(gone, F.lit(False))).collect()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_step_prefers_the_least_letters():
    rest, edits = conversations.step(conversations.ENDED, 1 * 4)  # a good user turn at the end
    assert [conversations.LETTERS[edits >> 2 * s & 3] for s in range(4)] == ["K", "K", "R", "K"]
    with pytest.raises(IndexError):
        conversations.step(conversations.ENDED, 16 * 4)
