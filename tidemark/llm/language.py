"""Language identification by a small byte convolutional network, trained in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last is
padded with zeros; each reads on into the next by the filters' width). Filters
of 2, 3 and 4 bytes, ``FILTERS`` each, respond to one-hot bytes; the maximum over
the window, rectified, feeds a softmax over languages. A document's probabilities
are its windows' mean, weighted by bytes, over the whole text.

Training takes a bounded sample: at most ``PER_LANG`` documents a language
(smallest hashes of their ids) of at most ``MAX_LANGS`` languages (the most
frequent), ``SAMPLE_WINDOWS`` windows each. Weights: about 2 000 filter taps a
filter and language, a fixed size.

Null texts and those without letters are ``und`` with score 0. With no labelled
rows every text is ``und``. Ties go to the first language by code point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, text_slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
REACH = max(WIDTHS) - 1
PER_LANG = 400
MAX_LANGS = 200
SAMPLE_WINDOWS = 3
EPOCHS = 12
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows_of(data: bytes) -> np.ndarray:
    """(n, WINDOW + REACH) bytes: windows side by side, each with the bytes that follow it."""
    n = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(n * WINDOW + REACH, dtype="uint8")
    padded[:len(data)] = np.frombuffer(data, "uint8")
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + REACH)[::WINDOW]


# --- the network -----------------------------------------------------------------

class Net:
    """taps[w]: (w, 256, FILTERS); dense: (len(WIDTHS) * FILTERS, languages)."""

    def __init__(self, langs: list[str], seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.langs = langs
        self.taps = {w: rng.normal(0, 0.5, (w, 256, FILTERS)).astype("float32") for w in WIDTHS}
        self.bias = np.zeros(len(WIDTHS) * FILTERS, dtype="float32")
        self.dense = rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(langs))).astype("float32")
        self.offset = np.zeros(len(langs), dtype="float32")

    def state(self) -> tuple:
        return self.langs, self.parameters()

    @classmethod
    def restored(cls, state: tuple) -> Net:
        net = cls(state[0])
        for own, kept in zip(net.parameters(), state[1]):
            own[...] = kept
        return net

    def parameters(self) -> list[np.ndarray]:
        return [*self.taps.values(), self.bias, self.dense, self.offset]

    def _responses(self, x: np.ndarray) -> np.ndarray:
        """(n, WINDOW, filters): each filter at each place."""
        return np.concatenate([sum(t[j][x[:, j:j + WINDOW]] for j in range(w)) for w, t in self.taps.items()], axis=2)

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients of a batch; the maximum passes its gradient to the place it came from."""
        n = len(x)
        responses = self._responses(x)
        at = responses.argmax(axis=1)
        top = np.take_along_axis(responses, at[:, None, :], 1)[:, 0] + self.bias
        hidden = np.maximum(top, 0)
        p = softmax(hidden @ self.dense + self.offset)
        loss = -np.log(p[np.arange(n), y] + 1e-9).mean()
        d = p.copy()
        d[np.arange(n), y] -= 1
        d /= n
        back = (d @ self.dense.T) * (top > 0)
        grads = []
        for k, (w, t) in enumerate(self.taps.items()):
            g = np.zeros_like(t)
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            for j in range(w):
                np.add.at(g[j], (x[np.arange(n)[:, None], at[:, part] + j], np.arange(FILTERS)[None, :]), back[:, part])
            grads.append(g)
        return loss, [*grads, back.sum(0), hidden.T @ d, d.sum(0)]

    def tables(self) -> tuple[np.ndarray, ...]:
        """The filters as tables of byte pairs, for fast inference: a width is one or two look-ups."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        t2, t3, t4 = self.taps[2], self.taps[3], self.taps[4]
        first = np.concatenate([pair(t2[0], t2[1]), pair(t3[0], t3[1]), pair(t4[0], t4[1])], axis=1)
        return first, np.ascontiguousarray(t3[2]), pair(t4[2], t4[3])

    def probabilities(self, x: np.ndarray, tables) -> np.ndarray:
        first, third, last = tables
        pairs = x[:, :-1].astype("uint16") * 256 + x[:, 1:]
        r = first[pairs[:, :WINDOW]]
        r[:, :, FILTERS:2 * FILTERS] += third[x[:, 2:WINDOW + 2]]
        r[:, :, 2 * FILTERS:] += last[pairs[:, 2:WINDOW + 2]]
        return softmax(np.maximum(r.max(axis=1) + self.bias, 0) @ self.dense + self.offset)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 5) -> Net:
    """Adam on shuffled batches; the sample is balanced by language."""
    net, rng = Net(langs), np.random.Generator(np.random.PCG64(seed))
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), 64):
            pick = order[start:start + 64]
            _, grads = net.step(windows[pick], labels[pick])
            t += 1
            for p, g, m, v in zip(net.parameters(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-7)
    return net


# --- on Spark ----------------------------------------------------------------------

def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Net | None:
    """Train on the labelled rows that aren't held out; the sample on the driver is bounded by the module's constants."""
    labelled = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not counts:
        return None
    langs = sorted(r["lang"] for r in counts)
    # a hash threshold a language leaves about 1.5 x PER_LANG rows of each
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, (1.5 * PER_LANG + 50) / r["count"])))])
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    # SAMPLE_WINDOWS stretches of a text, the first at a place that depends on the id
    size = F.greatest(F.length(text_col) - WINDOW, F.lit(0))
    starts = [F.pmod(F.xxhash64(F.col(id_col), F.lit(i)), size + 1).cast("int") + 1 for i in range(SAMPLE_WINDOWS)]
    picked = (labelled.where(chance < F.try_element_at(share, F.col(lang_col)))
              .select(F.col(lang_col).alias("lang"), chance.alias("chance"), F.array(*[F.substring(F.col(text_col), s, F.lit(WINDOW)) for s in starts]).alias("parts")))
    rows = picked.orderBy("chance").limit(3 * PER_LANG * len(langs)).collect()
    taken: dict[str, int] = {}
    windows, labels = [], []
    for row in rows:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= PER_LANG:
            windows += [windows_of(p.encode())[0] for p in row["parts"]]
            labels += [langs.index(row["lang"])] * len(row["parts"])
    return train(np.array(windows), np.array(labels), langs)


def _predict(model):
    def run(batches):
        release()
        net = Net.restored(model.value) if model.value else None
        tables = net.tables() if net else None
        for batch in batches:
            texts = batch.column(1)
            for start, end in text_slices(texts, 1 << 18):
                raw = [t or "" for t in texts.slice(start, end - start).to_pylist()]
                lang, score = [UNKNOWN] * len(raw), np.zeros(len(raw))
                which = [i for i, t in enumerate(raw) if net and any(map(str.isalpha, t))]
                if which:
                    data = [raw[i].encode() for i in which]
                    x = [windows_of(d) for d in data]
                    p = np.concatenate([net.probabilities(part, tables) for part in _chunks(np.concatenate(x))])
                    weight = np.concatenate([np.minimum(WINDOW, len(d) - WINDOW * np.arange(len(w))) for d, w in zip(data, x)]).astype("float64")
                    starts = np.cumsum([0, *(len(w) for w in x[:-1])])
                    mean = np.add.reduceat(p * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
                    best = mean.argmax(axis=1)
                    for i, b, m in zip(which, best, mean):
                        lang[i], score[i] = net.langs[b], min(1.0, float(m[b]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(lang, pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])
    return run


def _chunks(x: np.ndarray, rows: int = 256):
    for start in range(0, len(x), rows):
        yield x[start:start + rows]


def identify(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row, from the text alone."""
    model = docs.sparkSession.sparkContext.broadcast(net.state() if net else None)  # plain arrays, a fixed number of weights
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _predict(model), "doc_id long, lang_pred string, score double")


def predictions(docs: DataFrame) -> DataFrame:
    """Train on ``docs`` and predict all of them: doc_id, held_out, lang_pred, score."""
    return identify(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
