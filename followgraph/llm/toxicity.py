"""Operator 12, toxicity: a linear-chain conditional random field over tokens.

Tokens are runs of letters, digits and bytes beyond ASCII; ASCII and Latin-1
capitals are made small.
A token's features are hashed into ``SIZE`` weights: the token, its first 3 to
7 bytes, its last 4 and both neighbours.  Two tags (clean, toxic) form a chain
with learned transitions.

Labelled tokens: documents alone are labelled, so the toxic tokens of a toxic
document are found first, by a greedy cover: tokens and beginnings of tokens
that occur often in toxic documents and hardly (``CLEAN_SHARE``) in clean ones are
taken, best first, until the next one explains fewer than ``LEAST_GAIN`` more
toxic documents.  Tokens with a taken key are labelled toxic there.  Toxic
documents without any are left out when the chain is fitted, not when its
scores are calibrated.

Fitting (Adam on the likelihood of the tags, forward-backward) runs on the
driver over whole texts of a bounded sample, at most ``MAX_ROWS`` rows and
``MAX_BYTES`` bytes of each class; the model (about 1 MB) is broadcast.

Scoring covers whole texts: forward and backward messages run through blocks
of ``BLOCK`` tokens side by side and are joined by the blocks' products, which
is exact.  The marginals give the offending spans (tokens with at least
``SPAN_LINE``, neighbours joined); the probability that no token is toxic, the
expected number of toxic tokens and the length give the document's score by a
logistic unit.

Null and empty texts have no tokens, no spans and a score as well.  Without
labels every score is 0.5; with labels of one class it is that class, and
where no token tells the classes apart it is the share of toxic documents.
Repeated rows get equal results; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.llm import arrays, samples, ship

BITS = 16
SIZE = 1 << BITS
PREFIXES, SUFFIX = (3, 4, 5, 6, 7), 4
KINDS = 1 + len(PREFIXES) + 3  # token, prefixes, suffix, both neighbours
KEYS = 1 + len(PREFIXES)  # kinds that can label a token
BLOCK = 48
MAX_ROWS, MAX_BYTES = 1200, 4 << 20
CLEAN_SHARE, LEAST_GAIN = 0.1, 4
EPOCHS, UPDATES, BATCH, RATE, DECAY = 4, 160, 48, 0.05, 1e-6  # at least so many of both
CLIP = 20.0
SPAN_LINE = 0.5
SEED = 12

_SALTS = np.random.default_rng(SEED).integers(1, 1 << 63, KINDS, dtype=np.uint64)


@dataclass
class Model:
    """``weights[kind * SIZE + hash]`` for the toxic tag (the last one, 0, stands
    for absent features); ``chain[i, j]``: log weight of tag ``j`` after ``i``;
    ``unit``: bias and weights of :func:`summary`."""

    weights: np.ndarray
    chain: np.ndarray
    unit: np.ndarray
    constant: float | None = None


class Tokens:
    """Tokens of a few texts with the 64-bit keys of their features."""

    def __init__(self, texts: list[bytes]):
        self.words = words = arrays.Words(texts, lower=True, members=arrays.IS_ALNUM)
        capital = np.flatnonzero((words.buf[:-1] == 0xC3) & (words.buf[1:] >= 0x80) & (words.buf[1:] < 0x9F) & (words.buf[1:] != 0x97))
        words.buf[capital + 1] += 0x20  # from U+00C0 to U+00DE
        self.count = np.diff(words.first)
        n = len(words)
        self.keys = np.zeros((KINDS, n), dtype=np.uint64)  # 0: absent
        if not n:
            return
        whole = words.hashes()
        length = words.end - words.start
        power = arrays.powers(max(*PREFIXES, SUFFIX))
        self.keys[0] = arrays.mix(whole ^ _SALTS[0]) | np.uint64(1)
        last = len(words.buf) - 1
        total = np.zeros(n, dtype=np.uint64)
        for j in range(max(PREFIXES)):
            total += words.value[words.buf[np.minimum(words.start + j, last)]] * power[j]
            if j + 1 in PREFIXES:
                kind = 1 + PREFIXES.index(j + 1)
                self.keys[kind] = np.where(length > j, arrays.mix(total ^ _SALTS[kind]) | np.uint64(1), 0)
        kind = KEYS
        total = np.zeros(n, dtype=np.uint64)
        for j in range(SUFFIX):
            total += words.value[words.buf[np.maximum(words.end - 1 - j, 0)]] * power[j]
        self.keys[kind] = np.where(length >= SUFFIX, arrays.mix(total ^ _SALTS[kind]) | np.uint64(1), 0)
        same = words.text[1:] == words.text[:-1]
        self.keys[kind + 1, 1:] = np.where(same, arrays.mix(whole[:-1] ^ _SALTS[kind + 1]) | np.uint64(1), 0)
        self.keys[kind + 2, :-1] = np.where(same, arrays.mix(whole[1:] ^ _SALTS[kind + 2]) | np.uint64(1), 0)

    def places(self) -> np.ndarray:
        """Places of all features in the table of weights."""
        place = (self.keys >> np.uint64(64 - BITS)).astype(np.int32) + np.arange(KINDS, dtype=np.int32)[:, None] * SIZE
        return np.where(self.keys == 0, KINDS * SIZE, place)


class Chain:
    """Forward-backward over all texts at once.

    ``toxic[i]`` is the marginal of token ``i``, ``log_z[t]`` the logarithm of
    the sum over all taggings of text ``t`` relative to the all-clean one, and
    ``pairs`` the expected numbers of tag pairs, with clean before the start.
    """

    def __init__(self, odds: np.ndarray, count: np.ndarray, chain: np.ndarray, pairs: bool = False):
        a = np.exp(chain - chain[0, 0])
        blocks = -(-count // BLOCK)
        first = np.concatenate(([0], np.cumsum(blocks)))
        text = np.repeat(np.arange(len(count)), count)
        inside = np.arange(len(odds)) - np.repeat(np.cumsum(count) - count, count)
        row, column = inside % BLOCK, first[text] + inside // BLOCK
        n = int(first[-1])
        e = np.ones((BLOCK, n))
        e[row, column] = np.exp(np.clip(odds, -CLIP, CLIP))
        used = np.zeros((BLOCK, n), dtype=bool)
        used[row, column] = True

        product = np.stack([np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)])
        scale = np.zeros(n)
        for t in range(BLOCK):
            p, now = product, e[t]
            step = np.stack([p[0] + p[1] * a[1, 0], (p[0] * a[0, 1] + p[1] * a[1, 1]) * now, p[2] + p[3] * a[1, 0], (p[2] * a[0, 1] + p[3] * a[1, 1]) * now])
            product = np.where(used[t], step, product)
            if t % 8 == 7:
                size = product.sum(axis=0)
                product /= size
                scale += np.log(size)

        start, end = np.empty((2, n)), np.empty((2, n))
        self.log_z = np.zeros(len(count))
        parts, scales = product.T.tolist(), scale.tolist()
        bounds = first.tolist()
        for t in range(len(count)):
            x, y, total = 1.0, 0.0, 0.0
            for b in range(bounds[t], bounds[t + 1]):
                start[0, b], start[1, b] = x, y
                p = parts[b]
                x, y = x * p[0] + y * p[2], x * p[1] + y * p[3]
                size = x + y
                x, y, total = x / size, y / size, total + scales[b] + np.log(size)
            self.log_z[t] = total
            x = y = 0.5
            for b in range(bounds[t + 1] - 1, bounds[t] - 1, -1):
                end[0, b], end[1, b] = x, y
                p = parts[b]
                x, y = p[0] * x + p[1] * y, p[2] * x + p[3] * y
                size = x + y
                x, y = x / size, y / size

        forward = np.empty((BLOCK + 1, 2, n))
        forward[0] = start
        for t in range(BLOCK):
            x, y = forward[t]
            step = np.stack([x + y * a[1, 0], (x * a[0, 1] + y * a[1, 1]) * e[t]])
            forward[t + 1] = np.where(used[t], step / step.sum(axis=0), forward[t])
        self.pairs = np.zeros((2, 2))
        marginal = np.empty((BLOCK, n))
        x, y = end
        for t in range(BLOCK - 1, -1, -1):
            up = forward[t + 1, 1] * y
            marginal[t] = up / (forward[t + 1, 0] * x + up)
            if pairs:
                f0, f1 = forward[t]
                joint = np.stack([f0 * x, f0 * a[0, 1] * e[t] * y, f1 * a[1, 0] * x, f1 * a[1, 1] * e[t] * y])
                self.pairs += (joint / joint.sum(axis=0))[:, used[t]].sum(axis=1).reshape(2, 2)
            step = np.stack([x + a[0, 1] * e[t] * y, a[1, 0] * x + a[1, 1] * e[t] * y])
            x, y = np.where(used[t], step / step.sum(axis=0), np.stack([x, y]))
        self.toxic = marginal[row, column]


def summary(log_z: np.ndarray, expected: np.ndarray, count: np.ndarray) -> np.ndarray:
    """What the logistic unit sees of each text: 1, the log odds that any token
    is toxic, the logarithms of the expected toxic tokens and of all tokens."""
    some = np.maximum(log_z, 1e-6)
    odds = np.clip(some + np.log1p(-np.exp(-some)), -10, 10)
    return np.stack([np.ones(len(some)), odds, np.log1p(expected), np.log1p(count)], axis=1)


def labelled_tokens(tokens: Tokens, labels: np.ndarray) -> np.ndarray:
    """Tags of all tokens, by the greedy cover of the toxic texts."""
    text = tokens.words.text
    out = np.zeros(len(text), dtype=bool)
    n = len(labels)
    keys = tokens.keys[:KEYS]
    names, number = np.unique(keys, return_inverse=True)
    number = number.reshape(keys.shape)
    pair = np.unique((number * n + text[None, :])[keys != 0])  # each key once for each text
    key, doc = pair // n, pair % n
    toxic = labels[doc] == 1
    equal = (labels == 1).sum() / (labels == 0).sum()  # as if both classes had as many texts
    in_toxic = np.bincount(key[toxic], minlength=len(names))
    in_clean = np.bincount(key[~toxic], minlength=len(names)) * equal
    bad = np.broadcast_to(labels[text] == 1, keys.shape)
    often = np.bincount(number[bad], minlength=len(names))
    seldom = np.bincount(number[~bad], minlength=len(names)) * equal
    fit = (in_toxic >= LEAST_GAIN) & (seldom <= CLEAN_SHARE * often)
    some = toxic & fit[key]
    key, doc = key[some], doc[some]
    open_doc = np.ones(n, dtype=bool)
    taken = np.zeros(len(names), dtype=bool)
    while len(key):
        gain = np.bincount(key, minlength=len(names)) - 2 * in_clean * fit
        best = int(gain.argmax())
        if gain[best] < LEAST_GAIN:
            break
        taken[best] = True
        open_doc[doc[key == best]] = False
        left = open_doc[doc]
        key, doc = key[left], doc[left]
    for kind in range(KEYS):
        out |= taken[number[kind]] & (keys[kind] != 0)
    return out & (labels[text] == 1)


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Fit on whole texts; the same input gives the same model."""
    rng = np.random.default_rng(SEED)
    tokens = Tokens(texts)
    tags = labelled_tokens(tokens, labels)
    share = float((labels * weights).sum() / weights.sum())
    if not tags.any():
        return Model(np.zeros(1), np.zeros((2, 2)), np.zeros(4), constant=share)
    places = tokens.places()
    first = tokens.words.first
    tagged = np.bincount(tokens.words.text, tags, minlength=len(texts)) > 0
    seen = np.flatnonzero((tagged | (labels == 0)) & (tokens.count > 0))
    table, chain = np.zeros(KINDS * SIZE + 1), np.array([[0.0, -4.0], [0.0, -2.0]])
    m1, m2 = np.zeros_like(table), np.zeros_like(table)
    c1, c2 = np.zeros((2, 2)), np.zeros((2, 2))
    steps = 0
    epochs = max(EPOCHS, -(-UPDATES * BATCH // len(seen)))
    for epoch in range(epochs):
        order = rng.permutation(seen)
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            count = tokens.count[docs]
            index = np.repeat(first[docs] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            place, tag = places[:, index], tags[index]
            run = Chain(table[place].sum(axis=0), count, chain, pairs=True)
            before = np.concatenate(([False], tag[:-1]))
            before[np.cumsum(count)[:-1]] = False
            true = np.bincount(2 * before + tag, minlength=4).reshape(2, 2)
            error = np.broadcast_to(run.toxic - tag, place.shape)
            grad = np.bincount(place.ravel(), error.ravel(), len(table)) / len(docs) + DECAY * table
            pull = (run.pairs - true) / len(docs)
            steps += 1
            rate = RATE * (1 - (epoch + at / len(order)) / epochs)
            for x, g, u, v in ((table, grad, m1, m2), (chain, pull, c1, c2)):
                u += 0.1 * (g - u)
                v += 0.01 * (g * g - v)
                x -= rate * (u / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)
            table[-1] = 0
            chain -= chain[0, 0]
    model = Model(table.astype(np.float32), chain, np.zeros(4))
    seen_as = np.concatenate([summaries(model, texts[a:b])[0] for a, b in arrays.slices(texts)])
    unit = np.zeros(4)
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(seen_as @ unit, -30, 30)))
        hess = (seen_as * (weights * p * (1 - p))[:, None]).T @ seen_as + 0.1 * np.eye(4)
        unit -= np.linalg.solve(hess, seen_as.T @ (weights * (p - labels)) + 0.1 * unit)
    model.unit = unit
    return model


def summaries(model: Model, texts: list[bytes]) -> tuple[np.ndarray, Tokens, np.ndarray]:
    tokens = Tokens(texts)
    odds = model.weights[tokens.places()].sum(axis=0, dtype=np.float64)
    run = Chain(odds, tokens.count, model.chain)
    expected = np.bincount(tokens.words.text, run.toxic, minlength=len(texts))
    return summary(run.log_z, expected, tokens.count), tokens, run.toxic


def tag_texts(model: Model, texts: list[bytes]) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """Score and offending spans (code points) of every text."""
    if model.constant is not None:
        return [(model.constant, [])] * len(texts)
    out = []
    for a, b in arrays.slices(texts, 1 << 19):
        seen_as, tokens, toxic = summaries(model, texts[a:b])
        score = 1 / (1 + np.exp(-np.clip(seen_as @ model.unit, -30, 30)))
        words = tokens.words
        hits = np.flatnonzero(toxic >= SPAN_LINE)
        spans: list[list] = [[] for _ in range(b - a)]
        if len(hits):
            point = np.concatenate(([0], np.cumsum((words.buf & 0xC0) != 0x80)))
            new = np.concatenate(([True], (np.diff(hits) > 1) | (np.diff(words.text[hits]) > 0)))
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(hits)) - 1
            text = words.text[hits[begin]]
            offset = point[words.text_start[text]]
            left, right = point[words.start[hits[begin]]] - offset, point[words.end[hits[last]]] - offset
            peak = np.maximum.reduceat(toxic[hits], begin)
            for t, *span in zip(text.tolist(), left.tolist(), right.tolist(), peak.tolist()):
                spans[t].append(tuple(span))
        out += zip(score.tolist(), spans)
    return out


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on a sample of ``labels`` (``doc_id``, ``label``) joined to ``docs``."""
    rows, sizes = samples.labelled(docs, labels, max_rows, max_bytes)
    y = np.array([label for _, label, _ in rows], dtype=np.int64)
    seen = np.bincount(y, minlength=2)
    if not seen.all():
        known = sizes if not rows else {int(y[0]): 1}
        return Model(np.zeros(1), np.zeros((2, 2)), np.zeros(4), constant=float(next(iter(known))) if len(known) == 1 else 0.5)
    weight = np.array([sizes[0], sizes[1]]) / seen
    return fit([text for _, _, text in rows], y, weight[y])


RESULT = pa.struct(
    [
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))),
    ]
)


def tagged(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column ``struct<score, spans: array<struct<start, end, probability>>>``
    of each row's whole text; spans in code points, end exclusive."""
    ship.package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score: double, spans: array<struct<start: long, end: long, probability: double>>>")
    def tag(column: pa.Array) -> pa.Array:
        found = tag_texts(shared.value, arrays.texts_of(column))
        return pa.array([{"score": s, "spans": [dict(zip(("start", "end", "probability"), x)) for x in spans]} for s, spans in found], RESULT)

    return tag(F.col(text).cast("binary"))
