"""Byte automata: regular expressions to minimal transition arrays.

The standard library parses each expression; Thompson's construction, the
subset construction and partition refinement follow.  Supported: literals,
sets, ranges, groups, alternatives, greedy repeats and ``(?i:...)`` (ASCII
letters).  Expressions match bytes.
"""

from __future__ import annotations

import re
from re import _constants as K
from re import _parser

import numpy as np


class Nfa:
    """``moves[s]``: ``(byte set, state)`` pairs; ``free[s]``: states reached without a byte."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []
        self.start = self.state()
        self.accept: dict[int, int] = {}

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, pattern: str, tag: int) -> None:
        """Add ``pattern`` from the start state; its last state accepts ``tag``."""
        end = self._tree(_parser.parse(pattern), self.start, False)
        self.accept[end] = self.accept.get(end, 0) | 1 << tag

    def _tree(self, tree, at: int, fold: bool) -> int:
        for op, arg in tree:
            if op is K.LITERAL:
                at = self._step(at, {arg}, fold)
            elif op is K.IN:
                at = self._step(at, _members(arg), fold)
            elif op is K.SUBPATTERN:
                _, flags, _, inner = arg
                at = self._tree(inner, at, fold or bool(flags & re.IGNORECASE))
            elif op is K.BRANCH:
                end = self.state()
                for inner in arg[1]:
                    first = self.state()
                    self.free[at].append(first)
                    self.free[self._tree(inner, first, fold)].append(end)
                at = end
            elif op is K.MAX_REPEAT:
                low, high, inner = arg
                for _ in range(low):
                    at = self._tree(inner, at, fold)
                if high is K.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.free[at].append(loop)
                    self.free[loop].append(end)
                    self.free[self._tree(inner, loop, fold)].append(loop)
                    at = end
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.free[at].append(end)
                        at = self._tree(inner, at, fold)
                    self.free[at].append(end)
                    at = end
            else:
                raise ValueError(f"unsupported in a rule: {op}")
        return at

    def _step(self, at: int, members: set[int], fold: bool) -> int:
        if fold:
            members = members | {b ^ 32 for b in members if chr(b).isascii() and chr(b).isalpha()}
        if max(members) > 127:
            raise ValueError("rules are ASCII")
        end = self.state()
        self.moves[at].append((frozenset(members), end))
        return end

    def reverse(self) -> Nfa:
        """An automaton for the mirrored words (one accepting tag: 0)."""
        out = Nfa()
        out.moves, out.free = [[] for _ in self.moves], [[] for _ in self.free]
        for s, moves in enumerate(self.moves):
            for members, t in moves:
                out.moves[t].append((members, s))
        for s, ts in enumerate(self.free):
            for t in ts:
                out.free[t].append(s)
        out.start = out.state()
        out.free[out.start] = list(self.accept)
        out.accept = {self.start: 1}
        return out


def _members(items) -> set[int]:
    out: set[int] = set()
    negate = False
    for op, arg in items:
        if op is K.NEGATE:
            negate = True
        elif op is K.LITERAL:
            out.add(arg)
        elif op is K.RANGE:
            out.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"unsupported in a set: {op}")
    return set(range(128)) - out if negate else out


class Dfa:
    """Minimal deterministic automaton.

    ``table[state, class_of[byte]]`` is the next state, ``tags[state]`` the
    bits of the rules that end there, ``dead`` the state that nothing leaves
    (-1 where there is none).  With ``search`` a match may begin anywhere.
    """

    def __init__(self, nfa: Nfa, search: bool):
        sets = sorted({m for moves in nfa.moves for m, _ in moves}, key=sorted)
        member = np.zeros((256, max(len(sets), 1)), dtype=bool)
        for i, members in enumerate(sets):
            member[list(members), i] = True
        kinds, self.class_of = np.unique(member, axis=0, return_inverse=True)
        self.class_of = self.class_of.reshape(256).astype(np.int32)
        sample = [int(np.flatnonzero(self.class_of == c)[0]) for c in range(len(kinds))]

        def closure(state: int) -> frozenset[int]:
            seen, todo = {state}, [state]
            while todo:
                for t in nfa.free[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            return frozenset(seen)

        reach = [closure(s) for s in range(len(nfa.moves))]
        always = reach[nfa.start] if search else frozenset()
        after = [
            {c: frozenset().union(*(reach[t] for members, t in moves if byte in members)) for c, byte in enumerate(sample) if any(byte in m for m, _ in moves)}
            for moves in nfa.moves
        ]
        index, order, rows = {reach[nfa.start]: 0}, [reach[nfa.start]], []
        for states in order:
            targets = [set(always) for _ in sample]
            for s in states:
                for c, ts in after[s].items():
                    targets[c] |= ts
            row = []
            for target in map(frozenset, targets):
                if target not in index:
                    index[target] = len(order)
                    order.append(target)
                row.append(index[target])
            rows.append(row)
        table = np.array(rows, dtype=np.int64)
        tags = np.zeros(len(order), dtype=np.int64)
        for i, states in enumerate(order):
            for s in states:
                tags[i] |= nfa.accept.get(s, 0)
        self._minimise(table, tags)

    def _minimise(self, table: np.ndarray, tags: np.ndarray) -> None:
        _, block = np.unique(tags, return_inverse=True)
        while True:
            key = np.column_stack([block, block[table]])
            _, finer = np.unique(key, axis=0, return_inverse=True)
            finer = finer.reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        first = np.unique(block, return_index=True)[1]
        place = np.empty(len(first), dtype=np.int64)  # by first member, so that the start state is state 0
        place[np.argsort(first, kind="stable")] = np.arange(len(first))
        self.table = np.empty((len(first), table.shape[1]), dtype=np.int32)
        self.tags = np.empty(len(first), dtype=np.int64)
        self.table[place] = place[block[table[first]]]
        self.tags[place] = tags[first]
        stuck = np.flatnonzero((self.table == np.arange(len(first))[:, None]).all(axis=1) & (self.tags == 0))
        self.dead = int(stuck[0]) if len(stuck) else -1

    def rows(self) -> list[list[int]]:
        """Next states by state and byte, as lists for short walks."""
        return self.table[:, self.class_of].tolist()

    def settled(self) -> tuple[np.ndarray, np.ndarray]:
        """For every byte whether all states lead to the same one, and that state."""
        wide = self.table[:, self.class_of]
        return (wide == wide[:1]).all(axis=0), wide[0]
