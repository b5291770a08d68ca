"""Operator 9, token counts: the exact count at every prefix of a text.

For a byte-level BPE vocabulary, the text is split as its pre-tokenizer
splits it, and each piece runs through a dynamic program over its bytes:
the last token of the prefix of ``i`` bytes is the one vocabulary entry
``t`` that ends there and whose predecessor, the last token of the prefix
before it, stays next to it when both are merged on their own.  The count
at ``i`` is then one more than the count before ``t``.  Pieces repeat, so
each worker remembers the steps of the short pieces it has met (at most
``CACHE_BYTES`` of them; it starts afresh beyond that, which changes no result).

What is stored for a text is one signed byte for each of its UTF-8 bytes:
by how much the count changes there.  The running sum is the token count of
every prefix that ends at a character; the total is the text's count.
:func:`count_at` and :func:`longest_prefix` answer questions about budgets
and truncation from it without encoding again.

Null texts count as empty, with no tokens.  Strings of special tokens in a
text count as one token, as the tokenizer library does by default; their
proper prefixes are ordinary text.  Texts are counted one by one: repeated
rows get equal counts, texts of any length and script are counted whole (long
strings without spaces are not remembered), and an empty table stays empty.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import arrays, ship

CACHE_BYTES = 96 << 20  # about, with what Python keeps for each string
KEPT_BYTES = 160  # the same for one piece, besides its own and its steps' bytes
FITS = 2_000_000
WIDE = 32  # bytes of a piece that is remembered
WORD = 64  # characters of a word that is remembered
SLICE_BYTES = 8 << 20

# Fixed value: the pattern by which byte-level BPE splits text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in such vocabulary files:
    printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Table:
    """Open-addressing map from 64-bit keys (not 0) to small integers, for arrays of keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.values = np.zeros(1 << self.bits, dtype=np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == 0
            take = todo[free]
            self.keys[slot[take]] = keys[take]
            self.values[slot[take]] = values[take]
            todo = todo[self.keys[slot[todo]] != keys[todo]]  # also those that lost the slot just now
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (arrays.mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(default))
        todo = np.flatnonzero((there != keys) & (there != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            found = there == keys[todo]
            out[todo[found]] = self.values[slot[todo[found]]]
            todo = todo[~found & (there != 0)]
        return out


CONTRACTION = regex.compile("'(?:re|ve|ll)").fullmatch


def _changes(count: list[int]) -> bytes:
    """Differences of the counts from 0 on, one signed byte each."""
    return bytes((b - a) & 255 for a, b in zip([0, *count], count, strict=False))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32)) | (b.astype(np.uint64) + np.uint64(1))


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ``row[:0], row[:1], ...`` for each row of bytes."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), dtype=np.uint64)
    base = arrays.powers(2)[1]
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * base + (rows[:, i].astype(np.uint64) + np.uint64(1))
    return out


class Counter:
    """Prefix counts for the vocabulary in the text of a tokenizer's JSON file."""

    def __init__(self, source: str):
        data = json.loads(source)
        model, letters = data["model"], byte_letters()
        split = data["pre_tokenizer"]
        plain = split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        if model["type"] != "BPE" or not plain or data["normalizer"] or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        special = [x for x in data["added_tokens"]]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in special):
            raise ValueError("special tokens that take in their surroundings are not supported")
        names = {x["content"] for x in special}

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ids = {raw(t): i for i, t in enumerate(t for t in model["vocab"] if t not in names)}
        self.longest = max(map(len, self.ids))
        # For each token the rank of the merge that makes it (-1: a byte) and its two parts.
        self.made = [-1] * len(self.ids)
        self.parts = [(i, i) for i in range(len(self.ids))]
        self.rank: dict[tuple[int, int], int] = {}
        for order, pair in enumerate(pairs):
            left, right = map(raw, pair)
            both = self.ids[left], self.ids[right]
            self.rank[both] = order
            whole = self.ids[left + right]
            if self.made[whole] < 0:
                self.made[whole], self.parts[whole] = order, both
        self.fits: dict[tuple[int, int], bool] = {}
        usable = {t: i for t, i in self.ids.items() if len(t) == 1 or self.adjacent(*self.parts[i], self.made[i])}
        if any(self.made[i] < 0 for t, i in usable.items() if len(t) > 1):
            raise ValueError("a token of the vocabulary is not made by merges")
        self.ids = usable
        self.made_of, self.parts_of = np.array(self.made), np.array(self.parts)
        self.power = arrays.powers(self.longest + 1)
        keys = [_prefix_hashes(np.frombuffer(t, dtype=np.uint8)[None, :])[0, -1] for t in usable]
        self.id_table = Table(np.array(keys, dtype=np.uint64), np.array(list(usable.values())))
        left, right = np.array(list(self.rank)).reshape(-1, 2).T
        self.rank_table = Table(_pair(left, right), np.array(list(self.rank.values())))
        self.pieces = regex.compile(PIECES)
        self.double = regex.compile(r"\p{White_Space}{2}")
        self.special = regex.compile("|".join(map(regex.escape, sorted(names, key=len, reverse=True)))) if names else None
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0  # bytes of both
        # The longest token that ends in each three bytes.
        self.reach = np.zeros(1 << 24, dtype=np.uint8)
        for token in sorted(usable, key=len):
            if len(token) >= 3:
                self.reach[int.from_bytes(token[-3:], "big")] = min(len(token), 255)

    def adjacent(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Whether tokens ``a`` and ``b`` meet unmerged up to merge ``limit``.

        Merges are undone from the latest on.  Whenever the tokens at the
        boundary could have merged before the merge undone last, they would
        have.  Of equal merges the left one comes first.
        """
        made, parts, rank = self.made, self.parts, self.rank
        while True:
            if rank.get((a, b), limit) < limit:
                return False
            if made[a] > made[b]:
                limit, a = made[a], parts[a][1]
            elif made[b] >= 0:
                limit, b = made[b] + 1, parts[b][0]
            else:
                return True

    def counts(self, piece: bytes) -> list[int]:
        """Token counts of ``piece[:1], piece[:2], ...`` by the dynamic program."""
        ids, fits, longest = self.ids, self.fits, self.longest
        last, count = [-1], [0]
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - longest), end):
                token = ids.get(piece[start:end])
                if token is None:
                    continue
                if start:
                    pair = last[start], token
                    fit = fits.get(pair)
                    if fit is None:
                        if len(fits) >= FITS:
                            fits.clear()
                        fit = fits[pair] = self.adjacent(*pair)
                    if not fit:
                        continue
                last.append(token)
                count.append(count[start] + 1)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count[1:]

    def adjacent_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`adjacent` for arrays of tokens; repeated pairs are tested once."""
        pairs, back = np.unique(_pair(a, b), return_inverse=True)
        a = (pairs >> np.uint64(32)).astype(np.int64)
        b = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1
        out = np.ones(len(pairs), dtype=bool)
        limit = np.full(len(pairs), 1 << 30)
        todo = np.arange(len(pairs))
        while len(todo):
            x, y = a[todo], b[todo]
            out[todo] = self.rank_table.get(_pair(x, y), 1 << 30) >= limit[todo]
            left = self.made_of[x] > self.made_of[y]
            limit[todo] = np.where(left, self.made_of[x], self.made_of[y] + 1)
            a[todo] = np.where(left, self.parts_of[x, 1], x)
            b[todo] = np.where(left, y, self.parts_of[y, 0])
            todo = todo[out[todo] & (left | (self.made_of[y] >= 0))]
        return out[back]

    def changes_many(self, pieces: list[bytes]) -> list[bytes]:
        """Changes of the count along many pieces of at most ``WIDE`` bytes, end by end."""
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        length = np.array([len(pieces[i]) for i in order])
        width = int(length[0])
        rows = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in order), dtype=np.uint8).reshape(-1, width)
        prefix = _prefix_hashes(rows)
        last = np.full((len(rows), width + 1), -1)
        count = np.zeros((len(rows), width + 1), dtype=np.int8)
        for end in range(1, width + 1):
            todo = np.arange(np.searchsorted(-length, -end, side="right"))
            size = np.full(len(todo), min(end, 2))
            if end > 2:
                tail = rows[todo, end - 3 : end].astype(np.int32)
                size = np.clip(self.reach[(tail[:, 0] << 16) | (tail[:, 1] << 8) | tail[:, 2]].astype(np.int64), 2, min(end, self.longest))
            while len(todo):
                start = end - size
                token = self.id_table.get(prefix[todo, end] - prefix[todo, start] * self.power[size], -1)
                hit = np.flatnonzero(token >= 0)
                inner = hit[start[hit] > 0]
                good = token >= 0
                good[inner] = self.adjacent_many(last[todo[inner], start[inner]], token[inner])
                at = todo[good]
                last[at, end] = token[good]
                count[at, end] = count[at, start[good]] + 1
                todo, size = todo[~good], size[~good] - 1
                if len(size) and not size.all():
                    raise ValueError("the vocabulary lacks a byte")
        data = np.diff(count, axis=1).tobytes()
        out: list[bytes] = [b""] * len(pieces)
        for at, (i, n) in enumerate(zip(order, length.tolist(), strict=True)):
            out[i] = data[at * width : at * width + n]
        return out

    def learn(self, pieces: set[str]) -> None:
        """Remember the steps of these pieces, as far as they are short."""
        known = self.known
        new = [(p, d) for p in pieces if p not in known and len(d := p.encode()) <= WIDE and not (p[0] == "'" and CONTRACTION(p))]
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            known.update(zip([p for p, _ in part], self.changes_many([d for _, d in part]), strict=True))
            self.held += sum(KEPT_BYTES + 2 * len(d) for _, d in part)

    def steps(self, piece: str) -> bytes:
        """Changes of the count along a piece, one signed byte each."""
        found = self.known.get(piece)
        if found is None:
            data = piece.encode()
            if CONTRACTION(piece):
                # 're, 've, 'll: the prefix of two bytes is split after the apostrophe.
                count = [1, 2, self.counts(data)[2]]
            else:
                count = self.counts(data)
            found = _changes(count)
            if len(data) <= WIDE:
                self.known[piece] = found
                self.held += KEPT_BYTES + 2 * len(data)
        return found

    def plain_deltas(self, text: str) -> bytes:
        """Changes of the count along a text without special tokens."""
        pieces = self.pieces.findall(text)
        known, steps = self.known.get, self.steps
        out = [known(p) or steps(p) for p in pieces]
        if not self.double.search(text):
            return b"".join(out)
        # White space before a word gives its last character to the next piece; the prefix
        # that ends right there still has all of it in one piece.
        for i in range(1, len(pieces)):
            before, piece = pieces[i - 1], pieces[i]
            if before[-1].isspace() and piece[0].isspace() and regex.fullmatch(r"\p{White_Space}+", before):
                data = (before + piece[0]).encode()
                n = len(piece[0].encode())
                shift = self.counts(data)[-1] - self.counts(before.encode())[-1]
                own = np.frombuffer(out[i], dtype=np.int8).astype(np.int64)
                delta = shift - own[:n].sum()
                if delta:
                    own[n - 1] += delta
                    if len(own) > n:
                        own[n] -= delta
                        out[i] = own.astype(np.int8).tobytes()
                    else:  # the next piece takes it back
                        out[i] = own.astype(np.int8).tobytes()
                        follow = np.frombuffer(self.steps(pieces[i + 1]), dtype=np.int8).copy()
                        follow[0] -= delta
                        out[i + 1] = follow.tobytes()
        return b"".join(out)

    def deltas(self, text: str) -> bytes:
        """Changes of the token count along the bytes of ``text``."""
        if self.special is None or not self.special.search(text):
            return self.plain_deltas(text)
        out, total, after = [], 0, 0
        for found in self.special.finditer(text):
            # Until the last byte of a special string, it is ordinary text after what precedes it.
            ahead = np.frombuffer(self.plain_deltas(text[after : found.end()]), dtype=np.int8).astype(np.int64)
            counts = np.cumsum(ahead)
            before = np.frombuffer(self.plain_deltas(text[after : found.start()]), dtype=np.int8).astype(np.int64).sum()
            counts[-1] = before + 1
            out.append(np.diff(counts, prepend=0).astype(np.int8).tobytes())
            total += int(counts[-1])
            after = found.end()
        out.append(self.plain_deltas(text[after:]))
        return b"".join(out)

    def deltas_many(self, texts: list[str]) -> list[bytes]:
        """:meth:`deltas` of each text.

        A text is cut before every single space, where a new piece always
        begins; the cut pieces, too, are remembered.  Texts with white space
        in front of a space, special tokens or long words go the longer way.
        """
        if self.held > CACHE_BYTES:
            self.words.clear()
            self.known.clear()
            self.held = 0
        cut = [text.split(" ") for text in texts]
        new: set[str] = set()
        for words in cut:
            new.update(words[1:])
        new = {w for w in new if w not in self.words}
        odd = {w for w in new if not w or len(w) > WORD or w[-1].isspace()}
        plain = {w: self.pieces.findall(" " + w) for w in new - odd}
        pieces = {p for found in plain.values() for p in found}
        slow = []
        for i, words in enumerate(cut):
            apart = words[0][-1:].isspace() or len(words[0]) > WORD or not odd.isdisjoint(words[1:])
            slow.append(apart or bool(self.special and self.special.search(texts[i])))
            if not slow[-1]:
                pieces.update(self.pieces.findall(words[0]))
        for text, apart in zip(texts, slow, strict=True):
            if apart and len(text) < 1 << 20:  # longer ones repeat enough pieces of their own
                pieces.update(self.pieces.findall(text))
        self.learn(pieces)
        steps, known = self.steps, self.known.get
        for w, found in plain.items():
            if w.isalnum() or not self.double.search(" " + w):
                self.words[w] = whole = b"".join([known(p) or steps(p) for p in found])
            else:
                self.words[w] = whole = self.plain_deltas(" " + w)
            self.held += KEPT_BYTES + 2 * len(whole)
        known = self.words.__getitem__
        out = []
        for text, words, apart in zip(texts, cut, slow, strict=True):
            out.append(self.deltas(text) if apart else self.plain_deltas(words[0]) + b"".join(map(known, words[1:])))
        return out


def deltas(spark: SparkSession, source: str, text: str = "text") -> Column:
    """Binary column: the change of the token count at each byte of the text.
    ``source`` is the text of the vocabulary file, read by the driver and
    broadcast (its size does not depend on the data)."""
    ship.package(spark)
    shared = spark.sparkContext.broadcast(source)
    made: list[Counter] = []

    @F.arrow_udf("binary")
    def stepped(column: pa.Array) -> pa.Array:
        if not made:
            made.append(Counter(shared.value))
        texts = arrays.texts_of(column)
        out: list[bytes] = []
        for a, b in arrays.slices(texts, SLICE_BYTES):
            out += made[0].deltas_many([x.decode() for x in texts[a:b]])
        return pa.array(out, pa.binary())

    return stepped(F.col(text).cast("binary"))


def total(steps: str) -> Column:
    """Token count of the whole text from its stored changes."""

    @F.arrow_udf("long")
    def summed(column: pa.Array) -> pa.Array:
        return pa.array([int(np.frombuffer(x, dtype=np.int8).sum(dtype=np.int64)) for x in arrays.texts_of(column)], pa.int64())

    return summed(F.col(steps))


def count_at(steps: str, end: str) -> Column:
    """Token count of the text's first ``end`` bytes (a character's end)."""

    @F.arrow_udf("long")
    def counted(column: pa.Array, ends: pa.Array) -> pa.Array:
        rows = zip(arrays.texts_of(column), ends.to_pylist(), strict=True)
        return pa.array([None if e is None else int(np.frombuffer(x[:e], dtype=np.int8).sum(dtype=np.int64)) for x, e in rows], pa.int64())

    return counted(F.col(steps), F.col(end))


def longest_prefix(text: str, steps: str, budget: int) -> Column:
    """Bytes of the longest prefix, cut at a character, of at most ``budget`` tokens."""

    @F.arrow_udf("long")
    def cut(texts: pa.Array, column: pa.Array) -> pa.Array:
        out = []
        for x, step in zip(arrays.texts_of(texts), arrays.texts_of(column), strict=True):
            after = np.frombuffer(x[1:] + b"a", dtype=np.uint8) if x else np.zeros(0, np.uint8)
            good = np.flatnonzero(((after & 0xC0) != 0x80) & (np.cumsum(np.frombuffer(step, dtype=np.int8), dtype=np.int64) <= budget))
            out.append(int(good[-1]) + 1 if len(good) else 0)
        return pa.array(out, pa.int64())

    return cut(F.col(text).cast("binary"), F.col(steps))
