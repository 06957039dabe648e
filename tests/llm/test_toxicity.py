"""Toxicity: the gradient, held-out accuracy, misspellings, long and odd texts, whole-text scoring."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as X

BAD = ["blorgish", "snarkful", "grumptious", "vexatron", "malodore"]
SYLLABLES = ["an", "er", "the", "in", "on", "ti", "es", "or", "re", "ed", "nd", "ha", "at"]


def _words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def _corpus(seed, n, share=0.3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = _words(rng, rng.choice([5, 20, 80, 300]))
        toxic = int(rng.random() < share)
        if toxic:
            for at in rng.sample(range(len(words)), max(1, len(words) // 30)):
                words[at] = rng.choice(BAD)
        out.append((i, " ".join(words).capitalize() + ".", toxic))
    return out


@pytest.fixture(scope="module")
def model():
    return X.train([(y, X.sample_windows(t.encode())) for _, t, y in _corpus(1, 700)])


def _score(model, texts):
    return 1 / (1 + np.exp(-np.clip(X.text_logits([t.encode() for t in texts], model.table()) - 0 + model.bias(), -500, 500)))


def test_held_out_accuracy_and_misspellings(model):
    fresh = _corpus(2, 400)
    p = _score(model, [t for _, t, _ in fresh])
    y = np.array([y for *_, y in fresh])
    assert (p >= 0.5)[y == 1].mean() > 0.95 and (p >= 0.5)[y == 0].mean() < 0.03
    misspelt = ["blorgissh", "snarkfull", "grumptius", "vexxatron", "malodoree", "BLORGISH", "snarkful!"]
    rng = random.Random(3)
    assert (_score(model, [" ".join([*_words(rng, 3), w]) for w in misspelt]) >= 0.5).mean() > 0.8


def test_gradient_of_every_kind_of_weight(monkeypatch):
    monkeypatch.setattr(X, "BUCKETS", 512)
    windows = [w for _, t, _ in _corpus(5, 12) for w in X.sample_windows(t.encode())]
    bags, model, y = X.Bags(windows), X.Model(), np.arange(len(windows)) % 2
    model.embedding = model.embedding.astype("float64")
    model.dense, model.offset = model.dense.astype("float64"), model.offset.astype("float64")
    pick = np.arange(len(windows))
    _, (touched, rows), dense, offset = model.gradients(bags, pick, y)

    def slope(array, at, eps=1e-5):
        keep = array[at]
        array[at] = keep + eps
        up = model.gradients(bags, pick, y)[0]
        array[at] = keep - eps
        down = model.gradients(bags, pick, y)[0]
        array[at] = keep
        return (up - down) / (2 * eps)
    rng = np.random.Generator(np.random.PCG64(1))
    for k in rng.integers(0, len(touched), 12):
        d = int(rng.integers(0, X.DIMENSIONS))
        assert slope(model.embedding, (touched[k], d)) == pytest.approx(rows[k, d], abs=1e-6)
    for at in np.ndindex(dense.shape):
        assert slope(model.dense, at) == pytest.approx(dense[at], abs=1e-6)
    assert slope(model.offset, 1) == pytest.approx(offset[1], abs=1e-6)


def _plain(text: bytes, table):
    """The score of one text, word by word."""
    folded = bytes(X._FOLD[np.frombuffer(text, "uint8")])
    words = [w for w in folded.split(b"\0") if w]
    if not words:
        return 0.0
    logits = []
    for w in words:
        marked = b"\0" + w + b"\0"
        buckets, owner, _ = X.subwords(np.frombuffer(marked, "uint8"))
        assert set(owner.tolist()) == {0} and len(buckets) == 1 + sum(max(0, len(marked) - n + 1) for n in X.GRAMS)
        logits.append(table[buckets].mean())
    windows = [np.mean(logits[i:i + X.WINDOW]) for i in range(0, len(words), X.WINDOW)]
    return max(windows) * X.SHARP


def test_texts_are_scored_whole_and_apart(model, monkeypatch):
    rng = random.Random(8)
    texts = ["", "a", " ", "Ünï cödé wörds", "x" * 50, " ".join(_words(rng, 1000)), "tail " + " ".join(_words(rng, 333)) + " blorgish", "\n\n.,", "two words"]
    raw = [t.encode() for t in texts]
    want = [_plain(t, model.table()) for t in raw]
    assert X.text_logits(raw, model.table()) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(X, "PIECE", 200)  # the same in pieces, where words are shorter than a piece
    assert X.text_logits(raw, model.table()) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(X, "PIECE", 20)  # a longer word counts as several, nothing is lost
    assert b"".join(X.pieces(raw[4])) == raw[4] and np.isfinite(X.text_logits(raw, model.table())).all()


def test_query(spark, documents):
    rows = _corpus(11, 500)
    docs = [(i, t, "en", "a") for i, t, _ in rows] + [(None, "blorgish snarkful", "en", "a"), (9000, None), (9001, ""), (3, rows[3][1], "en", "b"), (9002, "ha " * 40000 + "vexatron malodore")]
    labels = [(i, y) for i, _, y in rows if i % 7] + [(None, 1), (3, None), (5, 9), (77777, 1), (10, 0), (10, 0)]
    table = documents(docs, ("score", "toxic", "windows", "chance"))
    marks = spark.createDataFrame([(a, b, "x") for a, b in labels], "doc_id long, toxic int, text string")
    out = X.predictions(table, marks)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(docs)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.9
    by = {r["doc_id"]: r for r in got}
    assert by[None]["held_out"] is False and by[None]["predicted"] == 1 and by[9002]["predicted"] == 1
    assert by[9000]["score"] == by[9001]["score"] and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    # scores come from the text alone
    again = {r["doc_id"]: r["score"] for r in X.predictions(table.withColumn("source", F.lit("z")).withColumn("lang", F.lit(None).cast("string")), marks).collect()}
    assert again[9002] == by[9002]["score"]


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[2:] for r in X.predictions(documents([(1, "any text")]), none).collect()] == [(0.0, 0)]
    assert X.predictions(documents([]), none).count() == 0
