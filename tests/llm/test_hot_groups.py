"""Near copies of hot groups: linked by plain Jaccard, whatever weight the group's shingles lose."""

import random

import numpy as np

from tidemark.llm import minhash
from tidemark.llm.words import shingles, texts_words
import pyarrow as pa


def prose(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n)]


def plain(a, b):
    x, y = ({tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def edited(words, rng, n):
    """``n`` words changed, well apart: each changes five shingles."""
    out = list(words)
    for i in range(n):
        out[10 + i * (len(words) - 20) // n] = "zz" + prose(rng, 1)[0]
    return out


def test_near_copy_of_a_hot_exact_group(documents):
    rng = random.Random(3)
    hot = prose(rng, 204)
    near = edited(hot, rng, 4)
    assert 0.81 < plain(hot, near) < 0.83
    rows = [(i, " ".join(hot)) for i in range(100)] + [(100, " ".join(near))] + [(200 + i, " ".join(prose(rng, 60))) for i in range(200)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(rows)).collect()}
    assert got[100] == 0 and got[200] == 200
    levels = minhash.frequent_levels(documents(rows))
    words = next(iter(texts_words(pa.array([" ".join(hot)]), 0, 1)))
    assert levels[(shingles(words, 5) % np.uint64(minhash.DF_BUCKETS)).astype("int64")].max() <= 1  # two of 202 texts


def test_near_all_rows_near_copies_of_one_text(documents):
    rng = random.Random(4)
    hot = prose(rng, 204)
    texts = [edited(hot, rng, 2) for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert min(plain(texts[0], t) for t in texts[1:]) > 0.8
    assert {r["class_id"] for r in minhash.near_duplicates(documents(rows)).collect()} == {0}
