"""Toxicity by subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word is a run of bytes other than white space and sentence punctuation, A-Z
as a-z. Its vector is the mean of the embeddings of its byte n-grams of 3 to 5
(with a mark at either end) and of the whole word, all hashed to ``BUCKETS`` rows;
a misspelt word shares most n-grams with the word it stands for. ``WINDOW``
consecutive words are one bag: the mean of their vectors, times ``SHARP``, feeds a
softmax over the two labels. A text's score is the highest probability of its
windows, so that a long text is judged by its worst passage.

Embeddings and softmax are learnt together (Adagrad), first from all windows
with their document's label, then from the highest window of each document, as only
that one decides. The sample is bounded: at most ``TOXIC_DOCS`` and ``CLEAN_DOCS``
labelled documents (those of the smallest hashes of their ids), ``SAMPLE_WINDOWS`` windows each, evenly
spread over the text, of at most ``SAMPLE_BYTES`` bytes. Scoring reads every byte of every text.

The softmax is linear in the mean, so a bucket counts by one number when
scoring: the product of its embedding and the weights.

Defined results: a null text counts as empty; a text without words scores what the
softmax gives the zero vector; a null doc_id is scored and not held out; of several labels of
a document the toxic one counts, other labels than 0 and 1 and null ones do not; without labelled rows
every score is 0; a word of more than ``PIECE`` bytes counts as several; repeated rows are
scored each. Columns besides those named are ignored.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, text_slices
from tidemark.llm.words import mix

BUCKETS = 1 << 18
DIMENSIONS = 8
GRAMS = (3, 4, 5)
WINDOW = 8
SHARP = 16.0
TOXIC_DOCS = 2000
CLEAN_DOCS = 3000
SAMPLE_WINDOWS = 48
SAMPLE_BYTES = 256
WARM_EPOCHS = 1
EPOCHS = 8
BATCH = 256
RATE = 0.1
MIN_DOCS = 5
DECAY = 1e-5
PIECE = 1 << 20
SLICE = 1 << 14
SEPARATORS = b" \t\n\v\f\r\0.,;:!?\"()[]{}<>|/\\"


def held_out(doc_id: Column) -> Column:
    """True where 5 divides crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# --- words and their buckets ---------------------------------------------------------

_FOLD = np.arange(256, dtype="uint8")
_FOLD[65:91] = np.arange(97, 123)
_FOLD[np.frombuffer(SEPARATORS, "uint8")] = 0
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)


def folded(data: bytes) -> np.ndarray:
    """Bytes with small letters and 0 for separators, a separator at both ends."""
    return np.concatenate([[0], _FOLD[np.frombuffer(data, "uint8")], [0]]).astype("uint8")


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero((x[1:] != 0) & (x[:-1] == 0)) + 1


def subwords(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word) of every n-gram and whole word of ``folded`` bytes, and where the words start; in no order."""
    starts = _starts(x)
    none = np.empty(0, dtype="int64")
    if not len(starts):
        return none, none, starts
    inside = x != 0
    word = np.cumsum(np.concatenate([[0], (x[1:] != 0) & (x[:-1] == 0)])) - 1
    gaps = np.concatenate([[0], np.cumsum(~inside)])
    wide = x.astype("uint32")
    rolled = wide[:-1] * np.uint32(0x01000193) ^ wide[1:] * np.uint32(0x85EBCA6B)
    buckets, words = [], []
    for n in GRAMS:
        last = len(x) - n
        if last < 0:
            break
        rolled = rolled[:last + 1] * np.uint32(0x01000193) ^ wide[n - 1:] * np.uint32(0xC2B2AE35)
        at = np.flatnonzero(gaps[n - 1:n + last] == gaps[1:last + 2])  # no separator but at the ends
        h = rolled[at] + np.uint32(n)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        buckets.append((h >> np.uint32(13)) % np.uint32(BUCKETS))
        words.append(word[at + 1])
    powers = np.full(len(x), _STEP, dtype="uint64")
    powers[0] = 1
    back = np.full(len(x), _BACK, dtype="uint64")
    back[0] = 1
    sums = np.add.reduceat(x * np.multiply.accumulate(powers), starts)
    whole = mix(sums * np.multiply.accumulate(back)[starts]) % np.uint64(BUCKETS)
    return np.concatenate([*buckets, whole.astype("uint32")]).astype("int64"), np.concatenate([*words, np.arange(len(starts))]), starts


# --- the model ----------------------------------------------------------------------

def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


class Bags:
    """Windows as lists of distinct words, and the words as lists of buckets."""

    def __init__(self, windows: list[bytes]):
        seen: dict[bytes, int] = {}
        words, sizes = array("i"), array("i")
        for window in windows:
            own = [w for w in window.translate(_FOLD.tobytes()).split(b"\0") if w]
            words.extend([seen.setdefault(w, len(seen)) for w in own])
            sizes.append(len(own))
        self.word = np.frombuffer(words, "i4") if words else np.zeros(0, "i4")
        self.first = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "i4"))])
        self.window = np.repeat(np.arange(len(windows), dtype="i4"), np.diff(self.first))
        distinct, buckets, counts = list(seen), [np.zeros(0, "i4")], [np.zeros(1, "i8")]
        for start in range(0, len(distinct), SLICE):  # a slice's arrays at a time
            some = distinct[start:start + SLICE]
            bucket, word, _ = subwords(folded(b"\0".join(some)))
            buckets.append(bucket[np.argsort(word, kind="stable")].astype("i4"))
            counts.append(np.bincount(word, minlength=len(some)))
        self.bucket, self.bounds = np.concatenate(buckets), np.cumsum(np.concatenate(counts))

    def frequent(self, windows: np.ndarray) -> np.ndarray:
        """Whether MIN_DOCS documents at least hold a bucket; ``windows``: where each document's windows start, and the end."""
        held = np.zeros(BUCKETS, dtype="int64")
        edges = self.first[windows]
        for lo, hi in zip(edges, edges[1:]):
            words = np.unique(self.word[lo:hi])
            held[np.unique(self.bucket[_runs(self.bounds[words], self.bounds[words + 1] - self.bounds[words])])] += 1
        return held >= MIN_DOCS

    def entries(self, pick: np.ndarray):
        """Of picked windows: each word's window (as its place in ``pick``) and number among their distinct words; those words' buckets, and where each begins."""
        n = self.first[pick + 1] - self.first[pick]
        words, which = np.unique(self.word[_runs(self.first[pick], n)], return_inverse=True)
        size = self.bounds[words + 1] - self.bounds[words]
        return np.repeat(np.arange(len(pick)), n), which, self.bucket[_runs(self.bounds[words], size)], np.cumsum(size) - size

    def logits(self, table: np.ndarray) -> np.ndarray:
        """Of every window, without the bias."""
        size = np.diff(self.bounds)
        word = np.add.reduceat(np.append(table[self.bucket], 0.0), self.bounds[:-1]) / np.maximum(size, 1) if len(size) else np.zeros(0)
        n = np.diff(self.first)
        return np.bincount(self.window, word[self.word], minlength=len(n)) * SHARP / np.maximum(n, 1)


class Model:
    """embedding: (BUCKETS, DIMENSIONS); dense: (DIMENSIONS, 2); offset: (2,)."""

    def __init__(self, seed: int = 13):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.embedding = rng.uniform(-0.05, 0.05, (BUCKETS, DIMENSIONS)).astype("float32")
        self.dense = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype("float32")
        self.offset = np.zeros(2, dtype="float32")

    def gradients(self, bags: Bags, pick: np.ndarray, y: np.ndarray):
        """Loss of picked windows; gradients as (buckets touched, their rows), dense, offset."""
        row, which, bucket, begin = bags.entries(pick)
        size = np.diff(begin, append=len(bucket))[:, None]
        vectors = np.add.reduceat(self.embedding[bucket], begin, axis=0) / size
        part = SHARP / np.bincount(row, minlength=len(pick))[row][:, None]
        mean = np.add.reduceat(vectors[which] * part, np.searchsorted(row, np.arange(len(pick))), axis=0)
        z = mean @ self.dense + self.offset
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        loss = float(-np.log(p[np.arange(len(y)), y] + 1e-9).mean())
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = p @ self.dense.T
        by_word = np.argsort(which, kind="stable")
        words = np.add.reduceat((back[row] * part)[by_word], np.searchsorted(which[by_word], np.arange(len(begin))), axis=0) / size
        by_bucket = np.argsort(bucket, kind="stable")
        ordered = bucket[by_bucket]
        heads = np.flatnonzero(np.diff(ordered, prepend=-1))
        touched, rows = ordered[heads], np.add.reduceat(np.repeat(words, size[:, 0], axis=0)[by_bucket], heads, axis=0)
        return loss, (touched, rows), mean.T @ p, p.sum(axis=0)

    def table(self) -> np.ndarray:
        """A bucket's part of the difference of the two logits."""
        return (self.embedding @ (self.dense[:, 1] - self.dense[:, 0])).astype("float32")

    def bias(self) -> float:
        return float(self.offset[1] - self.offset[0])


def train(documents: list[tuple[int, list[bytes]]], seed: int = 17) -> Model:
    """``documents``: (label, windows)."""
    model, rng = Model(), np.random.Generator(np.random.PCG64(seed))
    documents = [(y, w) for y, w in documents if w]
    if not documents:
        return model
    bags = Bags([w for _, ws in documents for w in ws])
    owner = np.repeat(np.arange(len(documents)), [len(ws) for _, ws in documents])
    firsts = np.searchsorted(owner, np.arange(len(documents)))
    label = np.array([y for y, _ in documents])
    known = bags.frequent(np.append(firsts, len(owner)))
    model.embedding[~known] = 0
    sums = [np.full_like(model.embedding, 1e-8), np.full_like(model.dense, 1e-8), np.full_like(model.offset, 1e-8)]
    for epoch in range(WARM_EPOCHS + EPOCHS):
        if epoch < WARM_EPOCHS:
            use = np.arange(len(owner))
        else:
            z = bags.logits(model.table())
            order = np.lexsort((-z, owner))
            use = order[firsts]
        use = rng.permutation(use)
        for start in range(0, len(use), BATCH):
            pick = use[start:start + BATCH]
            _, (touched, rows), dense, offset = model.gradients(bags, pick, label[owner[pick]])
            touched, rows = touched[known[touched]], rows[known[touched]]
            rows += DECAY * model.embedding[touched]
            sums[0][touched] += rows ** 2
            model.embedding[touched] -= RATE * rows / np.sqrt(sums[0][touched])
            for own, g, s in ((model.dense, dense, sums[1]), (model.offset, offset, sums[2])):
                s += g ** 2
                own -= RATE * g / np.sqrt(s)
    return model


def pieces(text: bytes) -> list[bytes]:
    """A text in pieces of at most PIECE bytes, cut at separators where there are any."""
    out = []
    while len(text) > PIECE:
        cut = int(np.flatnonzero(_FOLD[np.frombuffer(text, "uint8", PIECE)] == 0)[-1:].sum()) or PIECE
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text]


def word_logits(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(logit, text) of every word of a few texts."""
    buckets, word, starts = subwords(folded(b"\0".join(texts)))
    total = np.bincount(word, table[buckets], minlength=len(starts)) / np.maximum(np.bincount(word, minlength=len(starts)), 1)
    return total, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts - 1, side="right")


def text_logits(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """The highest window's logit of each text, without the bias; 0 for a text without words."""
    if any(len(t) > PIECE for t in texts):
        parts = [[word_logits([p], table)[0] for p in pieces(t)] for t in texts]
        score = np.concatenate([s for ps in parts for s in ps])
        owner = np.repeat(np.arange(len(texts)), [sum(map(len, ps)) for ps in parts])
    else:
        score, owner = word_logits(texts, table)
    out = np.zeros(len(texts))
    if not len(score):
        return out
    n = np.bincount(owner, minlength=len(texts))
    number = np.arange(len(score)) - np.repeat(np.cumsum(n) - n, n)
    windows = np.maximum(-(-n // WINDOW), 1)
    window = number // WINDOW + np.repeat(np.cumsum(windows) - windows, n)
    mean = np.bincount(window, score, minlength=int(windows.sum())) / np.maximum(np.bincount(window, minlength=int(windows.sum())), 1)
    return np.where(n > 0, np.maximum.reduceat(mean, np.cumsum(windows) - windows) * SHARP, 0.0)


# --- on Spark -------------------------------------------------------------------------

def sample_windows(text: bytes) -> list[bytes]:
    """At most SAMPLE_WINDOWS windows of a text, evenly spread, of at most SAMPLE_BYTES bytes each."""
    starts = np.concatenate([_starts(folded(text)) - 1, [len(text)]])
    edges = [*starts[:-1:WINDOW], len(text)]
    n = len(edges) - 1
    pick = np.unique(np.linspace(0, n - 1, min(n, SAMPLE_WINDOWS)).round().astype(int)) if n else []
    return [text[edges[i]:edges[i + 1]][:SAMPLE_BYTES] for i in pick]


def _sampled(batches):
    for batch in batches:
        texts = batch.column(3).cast(pa.large_binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                          pa.array([sample_windows(t.as_py() or b"") for t in texts], pa.list_(pa.binary()))], names=["doc_id", "toxic", "chance", "windows"])


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on the labelled documents that aren't held out; what reaches the driver is bounded by the module's constants."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts:
        return None
    most = {0: CLEAN_DOCS, 1: TOXIC_DOCS}
    # a hash threshold a label leaves about 1.5 times as many as wanted
    share = F.when(F.col("toxic") == 1, min(1.0, (1.5 * TOXIC_DOCS + 50) / counts.get(1, 1))).otherwise(min(1.0, (1.5 * CLEAN_DOCS + 50) / counts.get(0, 1)))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    picked = known.withColumn("chance", chance).where(F.col("chance") < share).orderBy("chance").limit(2 * (TOXIC_DOCS + CLEAN_DOCS))
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "chance", "text")
            .mapInArrow(_sampled, "doc_id long, toxic int, chance double, windows array<binary>")
            .groupBy("doc_id", "toxic", "chance").agg(F.max("windows").alias("windows"))
            .orderBy("chance", "doc_id").limit(2 * (TOXIC_DOCS + CLEAN_DOCS)).collect())
    taken, sample = {0: 0, 1: 0}, []
    for r in rows:
        taken[r["toxic"]] += 1
        if taken[r["toxic"]] <= most[r["toxic"]]:
            sample.append((r["toxic"], [bytes(w) for w in r["windows"]]))
    del rows
    return train(sample)


def _score(state):
    def run(batches):
        release()
        for batch in batches:
            texts = batch.column(1)
            for start, end in text_slices(texts, PIECE):
                raw = [t or b"" for t in texts.slice(start, end - start).cast(pa.large_binary()).to_pylist()]
                if state.value is None:
                    score = np.zeros(len(raw))
                else:
                    table, bias = state.value
                    score = 1 / (1 + np.exp(-np.clip(text_logits(raw, table) + bias, -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(score)], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) per row, from the text alone."""
    state = docs.sparkSession.sparkContext.broadcast((model.table(), model.bias()) if model else None)  # BUCKETS numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(state), "doc_id long, score double")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
