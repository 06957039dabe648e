"""The pipeline's stages against brute force, on a fixture with null ids, shared ids, copies and contaminated texts."""

import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

WORDS = {"en": ["the", "house", "river", "stone", "walks", "over", "green", "light", "under", "bread"],
         "de": ["der", "hund", "straße", "läuft", "über", "grün", "licht", "unter", "brot", "stein"]}
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
ODD = [(None, None, "en", "a"), (4000, "", "en", "a"), (4001, "123 456", "en", "b")]


def _text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "n"]) + str(rng.randint(0, 9) if rng.random() < 0.1 else "") for _ in range(n))


def _docs():
    rng = random.Random(12)
    docs = [(i, _text(rng, "en" if i % 2 else "de", rng.choice([12, 40, 90])), "en" if i % 2 else "de", "abc"[i % 3]) for i in range(260)]
    docs += [(1000 + i, docs[i][1], docs[i][2], "a") for i in range(0, 40, 4)]              # exact copies
    docs += [(5, _text(rng, "en", 60), "en", "b"), (5, docs[5][1], "en", "b")]               # a shared id: another text, and a copy of its own
    docs += [(None, docs[8][1], "de", "c"), (None, _text(rng, "de", 50), "de", "c"), (None, _text(rng, "en", 33), "en", "a")]
    docs += [(2000 + i, docs[i][1] + " " + ITEM + " " + _text(rng, docs[i][2], 20), docs[i][2], "b") for i in range(0, 12)]
    return docs + ODD


def _shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*d, len(d[1] or "")) for d in _docs()], schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([("i1", ITEM)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _key(rows):
    return Counter((r["doc_id"], r["text"], r["source"]) for r in rows)


def test_stages_match_brute_force(spark, folder):
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    told = corpus_pipeline.stored(stage["language_id"](spark, docs, folder), "t-language")
    want = Counter(d[:2] + d[3:] for d in _docs()) - Counter(d[:2] + d[3:] for d in ODD)
    assert _key(told.collect()) == want  # clean documents stay, texts without letters go

    unique = corpus_pipeline.stored(stage["minhash_near_dedup"](spark, told, folder), "t-unique")
    rows = sorted(want.elements(), key=lambda d: (d[0] is None, d[0] or 0))
    shingles = [_shingles(d[1]) for d in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(shingles[i] & shingles[j])
            if both >= 0.8 * (len(shingles[i]) + len(shingles[j]) - both) and group[i] != group[j]:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    kept = unique.collect()
    texts = {d[1] for g, d in zip(group, rows) if group.index(g) == rows.index(d)}
    assert len(kept) == len(set(group)) and {r["text"] for r in kept} == texts  # a row of each group, none lost to a shared id
    ids = Counter(d[0] for n, d in enumerate(rows) if group.index(group[n]) == n)
    assert Counter(r["doc_id"] for r in kept) == ids

    clean = corpus_pipeline.stored(stage["benchmark_decontamination"](spark, unique, folder), "t-clean")
    assert _key(clean.collect()) == _key([r for r in kept if ITEM not in r["text"]]) and clean.count() < len(kept)

    mixed = corpus_pipeline.stored(stage["source_mixing"](spark, clean, folder), "t-mixed")
    out, pool = mixed.collect(), clean.collect()
    size = lambda r: len(r["text"].split())
    have, got = Counter(), Counter()
    for r in pool:
        have[r["source"]] += size(r)
    for r in out:
        got[r["source"]] += size(r)
    assert _key(out) - _key(pool + pool) == Counter()  # each row as often as the mix says, twice at most
    target, rest, weight = {}, 1.5 * sum(have.values()), {"a": 3, "b": 1, "c": 2}
    while set(have) - set(target):  # water-filling
        level = rest / sum(weight[s] for s in have if s not in target)
        full = [s for s in have if s not in target and weight[s] * level >= 2 * have[s]] or [s for s in have if s not in target]
        for s in full:
            target[s] = min(2.0 * have[s], weight[s] * level)
        rest -= sum(target[s] for s in full)
    longest = max(map(size, out))
    assert all(abs(got[s] - target[s]) <= longest / 2 for s in have)

    tokens = stage["token_output"](spark, mixed, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = lambda t: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 2]))
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in tokens) == Counter((r["doc_id"], crc(r["text"])) for r in out)


def test_extra_columns_of_clashing_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in ("_row", "class_id", "copies", "_copies", "taken"):
        docs = docs.withColumn(c, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "t-" + name)
        assert docs.columns[-5:] == ["_row", "class_id", "copies", "_copies", "taken"] and docs.count() > 100
