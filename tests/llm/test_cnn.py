"""The classifier: held-out accuracy, whole texts, odd inputs."""

import random

import numpy as np
import pytest

from followgraph.llm import cnn
from tests.llm import corpus


def labelled(seed, n):
    """Word texts (1), and texts with a noisy part somewhere (0)."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        text = " ".join("".join(rnd.choice(["ta", "lo", "min", "der"]) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(5, 300)))
        if i % 3 == 0:
            at = rnd.randrange(len(text))
            text = text[:at] + "".join(rnd.choice(["###", "$$ ", "%%", "| "]) for _ in range(12)) + text[at:]
        out.append((text, int(i % 3 != 0)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = labelled(1, 400)
    return cnn.fit([cnn.chunked(t.encode()) for t, _ in rows], np.array([y for _, y in rows], float), np.ones(len(rows)))


def test_held_out(model):
    rows = labelled(2, 300)
    score = cnn.score_texts(model, [t.encode() for t, _ in rows])
    assert ((score >= 0.5) == np.array([y for _, y in rows], bool)).mean() > 0.95


def test_noise_at_the_very_end_of_a_long_text_counts(model):
    text = " ".join(t for t, y in labelled(3, 300) if y)
    plain, noisy = cnn.score_texts(model, [text.encode(), (text + "### $$ %%| ### $$ %%| ###").encode()])
    assert noisy < plain


def test_chunks_cover_every_byte():
    for n in [0, 1, 255, 256, 257, 479, 480, 481, 10_000]:
        starts = cnn.chunk_starts(n)
        assert starts[0] == 0 and (np.diff(starts) == cnn.STEP).all() and starts[-1] + cnn.CHUNK >= n
        assert len(starts) == 1 or starts[-1] < n


def test_scores_do_not_depend_on_neighbours(model):
    rows = [t.encode() for t, _ in labelled(4, 40)] + [b"", b"x"]
    together = cnn.score_texts(model, rows)
    assert np.allclose(together, [cnn.score_texts(model, [r])[0] for r in rows])


def test_train_and_odd_rows(spark):
    rows = labelled(5, 120)
    docs = corpus.frame(spark, [t for t, _ in rows] + [None, ""])
    schema = "doc_id long, label int"
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(3, None), (None, 1), (4, rows[4][1])], schema)
    first, again = cnn.train(docs, labels, 50), cnn.train(docs, labels, 50)
    assert np.array_equal(first.tables, again.tables)
    scored = docs.withColumn("extra", cnn.score(docs, first))
    assert all(0 <= r["extra"] <= 1 for r in scored.collect()) and scored.count() == 122
    assert cnn.train(docs, labels.where("false")).constant == 0.5
    assert cnn.train(docs, labels.where("label = 1")).constant == 1.0
    assert scored.where("doc_id < 0").collect() == []


def test_agrees_with_plain_loops(model):
    """The network by its definition, byte by byte."""
    for text in (b"", b"x", "é### | ab".encode() * 3, bytes(range(256)) * 3, b"lo min " * 90):
        chunks = []
        for start in range(0, max(1, len(text)), cnn.STEP):
            if start and start + (cnn.CHUNK - cnn.STEP) >= len(text):
                break
            best = [-np.inf] * cnn.FILTERS
            for place in range(start, max(start + 1, min(start + cnn.CHUNK, len(text)))):
                for f in range(cnn.FILTERS):
                    window = [text[place + j] if place + j < len(text) else 0 for j in range(cnn.WIDTH)]
                    best[f] = max(best[f], sum(float(model.tables[j, b, f]) for j, b in enumerate(window)))
            chunks.append([max(0.0, b + float(model.bias[f])) for f, b in enumerate(best)])
        vectors = np.array(chunks)
        logit = vectors.mean(axis=0) @ model.mean + vectors.max(axis=0) @ model.peak + model.gap * max(0, 1 - len(text) / cnn.CHUNK) + model.base
        assert abs(cnn.score_texts(model, [text])[0] - 1 / (1 + np.exp(-logit))) < 1e-4


def test_fits_on_every_chunk_and_the_least_text_of_a_repeated_id(spark):
    assert len(cnn.chunked(b"a" * 100_000)) == len(cnn.chunk_starts(100_000)) * (cnn.CHUNK + cnn.WIDTH + 1)
    rows = labelled(6, 60)
    docs = corpus.frame(spark, [*[t for t, _ in rows], (4, "zzz"), (5, "!!!")])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, label int")
    one, other = cnn.train(docs, labels), cnn.train(docs.repartition(6), labels.repartition(3))
    assert np.array_equal(one.tables, other.tables)
    assert cnn.train(docs.where("false"), labels).constant == 0.5
    assert docs.where("false").select(cnn.score(docs, one)).collect() == []
