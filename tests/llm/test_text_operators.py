"""Near-duplicates, decontamination, tokens and languages against brute force, and their edge cases."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, language, minhash, token_counts, token_files
from tidemark.session import scratch_path

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
CLASHES = ("row", "_row", "words", "h", "key", "id", "copies", "_id", "uid", "items", "at")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(seed=1):
    """Texts with exact, near and chained copies, and one group larger than a block."""
    rng, rows = random.Random(seed), []
    for i in range(40):
        base = prose(rng, rng.randint(20, 200)).split(" ")
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(len(other))] = prose(rng, 1)
            rows.append(" ".join(other))
    hot = prose(rng, 150).split(" ")
    for _ in range(60):
        other = list(hot)
        other[rng.randrange(150)] = prose(rng, 1)
        rows.append(" ".join(other))
    return [(i, t) for i, t in enumerate(rows)]


def jaccard_classes(rows):
    sets = {i: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if (w := words(t)) else None for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [1024, 16])
def test_near_duplicates_match_brute_force(documents, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus()
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(rows, CLASHES)).collect()}
    assert got == jaccard_classes(rows)


def test_near_duplicates_edge_cases(documents):
    long = prose(random.Random(2), 30_000)
    rows = [(1, None), (2, ""), (3, "..."), (4, "One two"), (5, "one, TWO"), (6, "one three"), (7, long), (8, long + " end"), (9, long), (None, long), (7, long)]
    got = sorted((r["doc_id"] or -1, r["class_id"]) for r in minhash.near_duplicates(documents(rows)).collect())
    assert got == [(-1, None), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (7, 7), (8, 7), (9, 7)]
    assert minhash.near_duplicates(documents([])).count() == 0


def test_sketches_estimate_weighted_jaccard():
    rng = np.random.Generator(np.random.PCG64(1))
    found = np.sort(rng.integers(0, 1 << 63, 400, dtype="uint64"))
    w = np.where(rng.random(400) < 0.3, 2, 1).astype("float32") * np.float32(minhash.idf(np.zeros(1))[0])
    agree, exact, tables = [], [], minhash._variates()
    for k in range(30):
        keep = np.sort(rng.permutation(400)[:340])
        a, b = minhash.sketch(found, w, tables), minhash.sketch(found[keep], w[keep], tables)
        agree.append((a == b).mean())
        exact.append(minhash.weighted_jaccard(found, w, found[keep], w[keep]))
    assert abs(np.mean(agree) - np.mean(exact)) < 0.03


def brute_contamination(docs, items):
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            k = min(10, len(iw))
            for s in range(len(iw) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == iw[s:s + k]:
                        hit.update(range(p, p + k))
                        found.add(str(item))
        out[i] = (len(w), len(hit), len(found), bool(hit), ",".join(sorted(found)))
    return out


def test_decontamination_matches_brute_force(spark, documents):
    import hashlib

    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(9, 21)] + [(30, None), (31, "..."), (32, "É Ü x y"), (33, "a a a a a a a a a a a a")]
    docs = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            cut = rng.randint(0, max(0, len(w) - 9))
            parts += [" ".join(w[cut:]).upper() if i % 2 else " - ".join(w[cut:]), prose(rng, rng.randint(0, 4))]
        docs.append((i, "  ".join(parts)))
    docs += [(100, None), (101, ""), (102, "É ü x y É Ü x y"), (103, "a " * 40), (104, "K")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"], r["items_sha256"]) for r in decontaminate.report(documents(docs, CLASHES), bench).collect()}
    assert got == {i: (*v[:4], hashlib.sha256(v[4].encode()).hexdigest()) for i, v in brute_contamination(docs, items).items()}
    clean = decontaminate.remove_documents(documents(docs, CLASHES), bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, v in brute_contamination(docs, items).items() if not v[3]}
    assert clean.columns == documents([], CLASHES).columns and clean.first()["_row"] == "x"
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(documents(docs), bench).collect()}
    assert all(len(words(cut[i])) == v[0] - v[1] for i, v in brute_contamination(docs, items).items())
    assert decontaminate.report(documents([]), bench).count() == 0
    assert decontaminate.report(documents(docs), bench.limit(0)).where("contaminated").count() == 0


ODD = ["a", "b", "The", " ", "  ", "\n", "\n\n", "\t", "'s", "'", ".", ",", "é", "é", "\x1c", "\xa0", "1", "23", "<|endoftext|>", "<|startoftext|>", "İ", "Σ", "क़", "\r\n", "日本", "😀", "_"]


def odd_texts():
    rng = random.Random(3)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(400)]


def test_token_files_round_trip(spark, documents, tmp_path):
    texts = [None, "", *odd_texts(), "word " * 30_000]
    rows = [(7 * i - 20, t) for i, t in enumerate(texts)] + [(None, "null id"), (8, "again")]
    library = Tokenizer.from_file(BYTE)
    out = scratch_path(spark, "test-tokens")
    token_files.write_tokens(documents(rows, CLASHES), out, BYTE)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_tokens(spark, out).orderBy("start").collect()]
    assert [g[0] for g in got] == [None, *sorted(i for i, _ in rows if i is not None)]
    ids = sorted(((i, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes()) for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    assert sorted((i, len(b) // 4, zlib.crc32(b)) for i, b in ids[1:]) == sorted((i, n, c) for i, _, n, c in got[1:])
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    files = sorted(p for p in __import__("pathlib").Path(out.removeprefix("file:")).glob("part-*"))
    mapped = np.concatenate([token_files.open_mapped(str(p))[0] for p in files])
    assert len(mapped) == sum(g[2] for g in got)
    with pytest.raises(ValueError):
        token_files.parse_file(files[0].read_bytes()[:-3])


def test_prefix_counts(documents):
    texts = [None, "", *odd_texts()]
    rows = list(enumerate(texts))
    library = Tokenizer.from_file(WORD)
    counted = token_counts.prefix_counts(documents(rows, CLASHES), WORD)
    got = {r["doc_id"]: r for r in counted.withColumn("n", token_counts.total(F.col("counts"))).withColumn("cut", token_counts.cut_at(F.col("ends"), F.col("counts"), 3)).collect()}
    count = lambda t: len(library.encode(t, add_special_tokens=False))
    for i, t in rows:
        assert (got[i]["n_bytes"], got[i]["n"]) == (len((t or "").encode()), count(t or ""))
        assert all(count(t[:e]) == c for e, c in zip(got[i]["ends"], got[i]["counts"]))
        assert count((t or "")[:got[i]["cut"]]) <= 3
    chars = {r["doc_id"]: r for r in token_counts.prefix_counts(documents(rows[:60]), WORD, grain="char").collect()}
    for i, t in rows[2:60]:
        assert chars[i]["ends"] == list(range(1, len(t) + 1))
        if not re.search("́|क़", t):  # a mark composed with the letter before it changes that letter's piece, as it should
            assert chars[i]["counts"] == [count(t[:e]) for e in range(1, len(t) + 1)]


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.9
    assert got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()


def test_language_edge_cases(documents):
    rows = [(i, "the cat sat on the mat and that was that" if i % 2 else "der Hund und die Katze sind müde", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "123 !!! 456"), (103, "der Hund " * 20_000), (None, "the cat sat on that mat"), (104, "the cat sat", None)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predictions(documents(rows, CLASHES)).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "de" and got[None][0] == "en"
    assert {r["lang_pred"] for r in language.predictions(documents([(1, "abc")])).collect()} == {"und"}
    assert language.predictions(documents([])).count() == 0


def test_gradients_match_differences():
    net = language.Net(["a", "b", "c"], seed=1)
    rng = np.random.Generator(np.random.PCG64(2))
    x, y = rng.integers(0, 256, (4, language.WINDOW + language.REACH)).astype("uint8"), np.array([0, 1, 2, 1])
    for p in net.parameters():
        p[...] = p * 0.5
    _, grads = net.step(x, y)
    dense = net.parameters()[-2]
    for at in [(0, 0), (5, 2), (20, 1)]:
        dense[at] += 1e-2
        up = net.step(x, y)[0]
        dense[at] -= 2e-2
        down = net.step(x, y)[0]
        dense[at] += 1e-2
        assert abs((up - down) / 2e-2 - grads[-2][at]) < 1e-3
    assert np.allclose(net.probabilities(x, net.tables()).sum(axis=1), 1, atol=1e-5)
