"""Operator 10, quality classifier: a byte-level convolutional network.

A text is cut into overlapping chunks of ``CHUNK`` bytes every ``STEP``
bytes, up to its last byte.  Every filter is ``WIDTH`` bytes wide and has a
learned weight for each byte value at each place; its responses are
rectified and max-pooled within a chunk.  The mean and the maximum of the
chunk vectors over the whole document feed one logistic unit, with the share
of a chunk that a text shorter than one leaves empty (its maxima are low).

Fitting runs on the driver over all chunks of the whole texts of a bounded
sample: of each class at most ``MAX_ROWS`` labelled rows (smallest hash of the
id first) and ``MAX_BYTES`` bytes; class weights restore the share of each
class among all training labels.  Scoring covers whole texts of all rows.  The
model's size is fixed by the architecture (about 130 kB), so it is
broadcast.

Null and empty texts are one empty chunk and get a score as well.  Without
labels the score is 0.5; with labels of one class it is that class.
Repeated label rows of a document count once (their mean, rounded up);
labels with null in either column are skipped, and of a repeated ``doc_id``
the least text is fitted on.  Repeated rows get equal scores; an empty table
of documents gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.llm import arrays, samples, ship

CHUNK, STEP, WIDTH, FILTERS = 256, 224, 8, 16
MAX_ROWS, MAX_BYTES = 1500, 4 << 20
UPDATES, BATCH, RATE = 560, 64, 0.02
SEED = 5


@dataclass
class Model:
    """``tables[j, byte, f]``: weight of filter ``f`` for ``byte`` at place ``j``."""

    tables: np.ndarray
    bias: np.ndarray
    mean: np.ndarray
    peak: np.ndarray
    gap: float
    base: float
    constant: float | None = None

    def pairs(self) -> np.ndarray:
        """Weights for two neighbouring bytes at once: half the look-ups."""
        t = self.tables
        return np.stack([(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(1 << 16, -1) for j in range(0, WIDTH, 2)])


def chunk_count(length: np.ndarray) -> np.ndarray:
    """Chunks of texts of these lengths; the last one reaches the text's end."""
    return np.maximum(1, -(-(length - (CHUNK - STEP)) // STEP))


def empty_share(length: np.ndarray) -> np.ndarray:
    return np.maximum(0, 1 - length / CHUNK)


def chunk_starts(length: int) -> np.ndarray:
    return np.arange(int(chunk_count(np.array(length)))) * STEP


def score_texts(model: Model, texts: list[bytes], pairs: np.ndarray | None = None) -> np.ndarray:
    """Probability of label 1 for each text."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    pairs = model.pairs() if pairs is None else pairs
    out = np.empty(len(texts))
    for a, b in arrays.slices(texts, 1 << 19):
        part = texts[a:b]
        length = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        buf = np.frombuffer(b"".join(x + bytes(WIDTH) for x in part), dtype=np.uint8)
        begin = np.concatenate(([0], np.cumsum(length + WIDTH)))[:-1]
        code = buf[:-1].astype(np.intp) << 8
        code |= buf[1:]
        n = len(buf) - WIDTH + 1
        conv = np.take(pairs[0], code[:n], axis=0)
        row = np.empty_like(conv)
        for j in range(1, WIDTH // 2):
            np.take(pairs[j], code[2 * j : 2 * j + n], axis=0, out=row, mode="clip")
            conv += row
        count = chunk_count(length)
        text = np.repeat(np.arange(len(part)), count)
        head = np.concatenate(([0], np.cumsum(count)))[:-1]
        inside = (np.arange(len(text)) - head[text]) * STEP
        first = begin[text] + inside
        last = begin[text] + np.minimum(np.maximum(length[text], 1), inside + CHUNK)
        both = np.minimum(np.stack([first, last], axis=1).ravel(), n - 1)
        top = np.maximum.reduceat(conv, both, axis=0)[0::2]
        top = np.maximum(top + model.bias, 0)
        mean = np.add.reduceat(top, head, axis=0) / count[:, None]
        peak = np.maximum.reduceat(top, head, axis=0)
        logit = mean @ model.mean + peak @ model.peak + model.gap * empty_share(length) + model.base
        out[a:b] = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))
    return out


def chunked(text: bytes) -> bytes:
    """All chunks of a text, each ``CHUNK + WIDTH - 1`` bytes (zeros after the
    end) after its number of valid places."""
    size = CHUNK + WIDTH - 1
    out = []
    for s in chunk_starts(len(text)).tolist():
        valid = max(1, min(CHUNK, len(text) - s))
        out.append(valid.to_bytes(2, "little") + text[s : s + size].ljust(size, b"\0"))
    return b"".join(out)


def fit(chunks: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Train on the chunks of each document by Adam; the same input gives the same model."""
    rng = np.random.default_rng(SEED)
    size = CHUNK + WIDTH - 1 + 2
    split = [np.frombuffer(x, dtype=np.uint8).reshape(-1, size) for x in chunks]
    x = {
        "tables": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "mean": rng.normal(0, 0.3, FILTERS).astype(np.float32),
        "peak": np.zeros(FILTERS, np.float32),
        "gap": np.zeros(1, np.float32),
        "base": np.zeros(1, np.float32),
    }
    m1 = {k: np.zeros_like(v) for k, v in x.items()}
    m2 = {k: np.zeros_like(v) for k, v in x.items()}
    steps = 0
    epochs = -(-UPDATES // -(-len(split) // BATCH))
    total = epochs * -(-len(split) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(split))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            count = np.array([len(split[d]) for d in docs])
            head = np.concatenate(([0], np.cumsum(count)))[:-1]
            doc = np.repeat(np.arange(len(docs)), count)
            rows = np.concatenate([split[d] for d in docs])
            valid = rows[:, 0].astype(np.int64) + (rows[:, 1].astype(np.int64) << 8)
            data = rows[:, 2:].astype(np.intp)
            conv = x["tables"][0][data[:, :CHUNK]]
            for j in range(1, WIDTH):
                conv += x["tables"][j][data[:, j : j + CHUNK]]
            conv[np.arange(CHUNK)[None, :] >= valid[:, None]] = -1e9
            arg = conv.argmax(axis=1)
            top = np.maximum(np.take_along_axis(conv, arg[:, None, :], axis=1)[:, 0] + x["bias"], 0)
            mean = np.add.reduceat(top, head, axis=0) / count[:, None]
            peak = np.maximum.reduceat(top, head, axis=0)
            gap = np.where(count == 1, empty_share(valid[head]), 0).astype(np.float32)
            p = 1 / (1 + np.exp(-(mean @ x["mean"] + peak @ x["peak"] + gap * x["gap"] + x["base"])))
            err = ((p - labels[docs]) * weights[docs] / weights[docs].sum()).astype(np.float32)
            back = (err / count)[doc][:, None] * x["mean"] + err[doc][:, None] * x["peak"] * (top == peak[doc])
            back *= top > 0
            place = arg[:, None, :] + np.arange(WIDTH)[None, :, None]
            byte = data[np.arange(len(data))[:, None, None], place]
            index = (np.arange(WIDTH)[None, :, None] * 256 + byte) * FILTERS + np.arange(FILTERS)
            spread = np.broadcast_to(back[:, None, :], index.shape)
            grad = {
                "tables": np.bincount(index.ravel(), spread.ravel(), x["tables"].size).reshape(x["tables"].shape),
                "bias": back.sum(axis=0),
                "mean": err @ mean + 1e-4 * x["mean"],
                "peak": err @ peak + 1e-4 * x["peak"],
                "gap": (err * gap).sum(keepdims=True),
                "base": err.sum(keepdims=True),
            }
            rate = RATE * (1 - steps / total)
            steps += 1
            for k, g in grad.items():
                m1[k] = (0.9 * m1[k] + 0.1 * g).astype(np.float32)
                m2[k] = (0.999 * m2[k] + 0.001 * g * g).astype(np.float32)
                x[k] -= (rate * (m1[k] / (1 - 0.9**steps)) / (np.sqrt(m2[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return Model(x["tables"], x["bias"], x["mean"], x["peak"], float(x["gap"][0]), float(x["base"][0]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on a sample of ``labels`` (``doc_id``, ``label``) joined to ``docs``
    (``doc_id``, ``text``), bounded for each class."""
    rows, sizes = samples.labelled(docs, labels, max_rows, max_bytes)
    found = sorted({label for _, label, _ in rows}) or sorted(sizes)
    if len(found) != 2:
        return Model(*[np.zeros(1)] * 4, 0.0, 0.0, constant=float(found[0]) if len(found) == 1 else 0.5)
    if not rows:
        return Model(*[np.zeros(1)] * 4, 0.0, 0.0, constant=0.5)
    y = np.array([label for _, label, _ in rows], dtype=np.float64)
    seen = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = np.array([sizes[0], sizes[1]]) / seen
    return fit([chunked(text) for _, _, text in rows], y, weight[y.astype(int)])


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column with the probability of label 1 of each row's whole text."""
    ship.package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict = {}

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        if "pairs" not in cache:
            m = shared.value
            cache["pairs"] = None if m.constant is not None else m.pairs()
        return pa.array(score_texts(shared.value, arrays.texts_of(column), cache["pairs"]))

    return scored(F.col(text).cast("binary"))
