"""Small made-up corpora for the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}x" for _ in range(n)]


def edited(rnd, text, share):
    """``text`` with this share of its words replaced."""
    out = text.split(" ")
    for i in rnd.sample(range(len(out)), int(len(out) * share)):
        out[i] = f"e{rnd.randrange(10**6)}"
    return " ".join(out)


def frame(spark, texts, **more):
    """A documents table: ``texts`` is a list of texts or of (id, text)."""
    rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
    rows = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t), "x") for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA)


def mixed(seed=1, base=25):
    """Originals with exact copies, near copies of many degrees, chains, short, empty and null texts."""
    rnd = random.Random(seed)
    texts = []
    for _ in range(base):
        text = " ".join(words(rnd, rnd.choice([6, 40, 120, 250])))
        texts.append(text)
        for _ in range(rnd.choice([0, 1, 4, 8])):
            text = edited(rnd, text, rnd.choice([0, 0.01, 0.02, 0.03, 0.05, 0.08]))
            texts.append(text)
    texts += ["", None, " \n ", "one", "one", "One two", "one  two", "one two three", "ONE two\tthree"]
    rnd.shuffle(texts)
    return texts
