"""Operator 2, secret scans: all rules in one pass over the bytes.

The rules are compiled together by subset construction and minimisation
into one transition array.  A batch of texts is one byte string, cut into
lanes right after bytes that lead every state to the same state, so that
each lane starts in a known state; all lanes step through the array at
once, and every byte is read once.  Where a rule's bit is set, the match is
bounded with the rule's own small automata (backwards to the leftmost
start, forwards to the longest end).  Matches of one rule do not overlap;
different rules may.

Offsets are code points, end exclusive.  Null and empty texts have no
spans.  Rows, repeated ones too, are scanned one by one; other columns stay
untouched and the column asked for replaces one of the same name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import arrays, ship
from followgraph.llm.automaton import Dfa, Nfa

SLICE_BYTES = 4 << 20
LANES = 4096


@dataclass(frozen=True)
class Rule:
    """``scan`` is what the automaton looks for; a match counts if ``group``
    of ``pattern`` (``scan`` by default) has ``least`` characters or more."""

    kind: str
    scan: str
    least: int = 0
    group: int = 0
    base: bool = False


# The base rules, then the further ones.
# In a run of its characters, a match of 16 (18) or more is the whole match
# that the open-ended rule finds; the short ones are dropped either way.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    Rule("hex", r"[0-9a-f]{16,}", 16, 0, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)

SPANS = "array<struct<kind:string,start:long,end:long>>"


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        both = Nfa()
        for i, rule in enumerate(rules):
            both.add(rule.scan, i)
        self.all = Dfa(both, search=True)
        self.settles, self.settled = self.all.settled()
        self.forward, self.backward, self.check = [], [], []
        for rule in rules:
            one = Nfa()
            one.add(rule.scan, 0)
            self.forward.append(Dfa(one, search=False))
            self.backward.append(Dfa(one.reverse(), search=False))
            self.check.append(re.compile(rule.scan.encode()))
        self.walks = [[(d.rows(), d.tags.tolist(), d.dead) for d in (f, b)] for f, b in zip(self.forward, self.backward, strict=True)]

    def ends(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions after which some rule has matched, and the rules' bits."""
        n = len(buf)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cuts = np.flatnonzero(self.settles[buf]) + 1
        wanted = np.arange(1, LANES) * (n // LANES + 1)
        place = np.searchsorted(cuts, wanted)
        begin = np.unique(np.concatenate(([0], cuts[place[place < len(cuts)]])))
        begin = begin[begin < n]
        length = np.diff(np.append(begin, n))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        width = self.all.table.shape[1]
        table = self.all.table.ravel().astype(np.int32)
        symbol = self.all.class_of[buf]
        seen = np.zeros(n, dtype=np.int32)
        state = np.where(begin > 0, self.settled[buf[np.maximum(begin, 1) - 1]], 0).astype(np.int32)
        active = np.searchsorted(-length, -np.arange(int(length[0])), side="left")
        for step in range(int(length[0])):
            k = active[step]
            at = begin[:k] + step
            state = table[state[:k] * width + symbol[at]]
            seen[at] = state
        bits = self.all.tags[seen]
        hit = np.flatnonzero(bits)
        return hit + 1, bits[hit]

    def bounds(self, rule: int, text: bytes, ends: list[int]) -> list[tuple[int, int]]:
        """Leftmost, longest, non-overlapping matches of a rule, given where matches of it end."""
        (ahead, ahead_tags, ahead_dead), (back, back_tags, back_dead) = self.walks[rule]
        cursor, out = 0, []
        for end in ends:
            if end <= cursor:
                continue
            state, start = 0, -1
            for i in range(end - 1, cursor - 1, -1):
                state = back[state][text[i]]
                if state == back_dead:
                    break
                if back_tags[state]:
                    start = i
            if start < 0:
                continue
            state, cursor = 0, end
            for i in range(start, len(text)):
                state = ahead[state][text[i]]
                if state == ahead_dead:
                    break
                if ahead_tags[state]:
                    cursor = i + 1
            found, need = self.check[rule].fullmatch(text, start, cursor), self.rules[rule]
            if found and found.end(need.group) - found.start(need.group) >= need.least:
                out.append((start, cursor))
        return out

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Spans ``(kind, start, end)`` of each text by start, then rule."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for a, b in arrays.slices(texts, SLICE_BYTES):
            part = texts[a:b]
            buf = np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8)
            length = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            begin = np.concatenate(([0], np.cumsum(length + 1)))[:-1]
            at, bits = self.ends(buf)
            owner = np.searchsorted(begin, at - 1, side="right") - 1
            found: dict[int, list[tuple[int, int, int]]] = {}
            for rule in range(len(self.rules)):
                mine = np.flatnonzero(bits >> rule & 1)
                docs, head = np.unique(owner[mine], return_index=True)
                place = (at[mine] - begin[owner[mine]]).tolist()
                for doc, x, y in zip(docs.tolist(), head.tolist(), [*head[1:].tolist(), len(mine)], strict=False):
                    ends = [e for e in place[x:y] if e <= length[doc]]
                    found.setdefault(doc, []).extend((s, rule, e) for s, e in self.bounds(rule, part[doc], ends))
            for doc, spans in found.items():
                raw = np.frombuffer(part[doc], dtype=np.uint8)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                out[a + doc] = [(self.rules[r].kind, int(chars[s]), int(chars[e])) for s, r, e in sorted(spans)]
        return out


def spans(spark: SparkSession, text: str = "text", rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of ``(kind, start, end)`` for the secrets in a text column.  The
    rules are compiled here; the arrays (their size depends on the rules
    alone, a few MB) are broadcast."""
    ship.package(spark)
    compiled = spark.sparkContext.broadcast(Scanner(rules))

    @F.arrow_udf(SPANS)
    def scanned(column: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        found = compiled.value.scan(arrays.texts_of(column))
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in found], kind)

    return scanned(F.col(text).cast("binary"))


def redacted(text: str, spans: str, mark: str = "[secret]") -> Column:
    """The text with every stretch of code points that a span covers replaced by ``mark``."""
    # Spans come by start: keep the end so far, and copy the text between it and the next start.
    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("end"))

    def join(done: Column, span: Column) -> Column:
        gap = F.substring(F.col(text), done["end"] + 1, span["start"] - done["end"])
        return F.struct(
            F.when(span["start"] >= done["end"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
            F.greatest(done["end"], span["end"]).alias("end"),
        )

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(F.col(text), done["end"] + 1, F.lit(2**31 - 1)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, empty, join, finish)).otherwise(F.col(text))
