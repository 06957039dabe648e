"""Near-duplicate classes by improved consistent weighted sampling (ICWS).

A text's features are its five-word shingles, weighted tf x idf. Sketches of
64 ICWS samples are cut into 16 bands of 4; texts that share a band are
candidates; candidates are verified by exact Jaccard similarity, linked when the
weighted or the plain one (each shingle once, all weights equal) is ``SIMILARITY``
or more; the classes are the connected components of the verified links. A text
whose weights differ has a second sketch without weights, in the same buckets.

Document frequencies cover all distinct texts. They are counted in ``DF_BUCKETS``
hash buckets (a sketch of fixed size), as shares of the corpus in steps of
``DF_STEP``: idf = ln((1 + s) / (share + s)), s = ``IDF_SMOOTH``. Collisions add
about (shingles a text) / DF_BUCKETS to a share, well below one step at any
corpus size, so only shingles of more than a hundredth of all texts lose weight.

ICWS takes the randomness of a shingle from one of ``TABLE_ROWS`` rows of
precomputed variates (by its hash); a sample is the shingle's full hash and its
level. Most shingles share one weight, so their samples are a table look-up.

Groups: exact copies collapse first. A bucket of a band is compared in blocks
of at most ``BLOCK`` texts (every pair of blocks), so no task or pair list grows
with the square of a group: a bucket emits the texts that have a candidate,
then the links that join parts not yet joined. Pairs whose sketches agree on
less than ``MIN_AGREE`` of the samples (four standard deviations under 0.8)
aren't verified; every other candidate pair between different parts is.

Result rows: one per input row. Null or empty texts (no words) and null ids
form no group. Rows that share a doc_id count as one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import group_bounds, map_groups, stored, text_slices, worker_cache
from tidemark.llm.words import mix, shingles, texts_words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
HASHES = BANDS * ROWS
TABLE_ROWS = 1 << 16
DF_BUCKETS = 1 << 18
DF_STEP = 0.01
IDF_SMOOTH = 0.25
MIN_AGREE = 0.6
BLOCK = 1024


def idf(level: np.ndarray) -> np.ndarray:
    """Weight of a shingle in ``level`` x DF_STEP of all texts."""
    return np.log((1 + IDF_SMOOTH) / (np.minimum(level * DF_STEP, 1.0) + IDF_SMOOTH))


# --- document frequencies -------------------------------------------------

def _digest(words: np.ndarray) -> bytes:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def _buckets(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words, SHINGLE) % np.uint64(DF_BUCKETS)).astype("int64")


def _count_buckets(batches):
    counts = np.zeros(DF_BUCKETS, dtype="int64")
    shape = {"bucket": pa.int64(), "n": pa.int64(), "content": pa.binary()}
    for batch in batches:
        texts = batch.column(0)
        for start, end in text_slices(texts):
            seen = []
            for words in texts_words(texts, start, end):
                if len(words):
                    counts[_buckets(words)] += 1
                    seen.append(_digest(words))
            yield pa.RecordBatch.from_pydict({"bucket": [-1] * len(seen), "n": [1] * len(seen), "content": seen}, schema=pa.schema(shape))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"bucket": used, "n": counts[used], "content": [None] * len(used)}, schema=pa.schema(shape))


def _heavy_lists(heavy):
    """(content, its buckets among ``heavy``) of the texts that have some."""
    def run(batches):
        for batch in batches:
            texts = batch.column(0)
            for start, end in text_slices(texts):
                content, lists = [], []
                for words in texts_words(texts, start, end):
                    if len(words):
                        found = _buckets(words)
                        found = found[heavy.value[found]]
                        if len(found):
                            content.append(_digest(words)), lists.append(found.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(content, pa.binary()), pa.array(lists, pa.binary())], names=["content", "buckets"])
    return run


def _count_lists(batches):
    counts = np.zeros(DF_BUCKETS, dtype="int64")
    for batch in batches:
        for found in batch.column(0).to_pylist():
            counts[np.frombuffer(found, "<u4")] += 1
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"bucket": used, "n": counts[used]})


def frequent_levels(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Level (share of the distinct texts in steps of DF_STEP) of each bucket, 0 for most.

    A bucket can only reach a level if it does so with every copy counted, so only such buckets are counted
    again over the distinct texts. At most DF_BUCKETS small rows reach the driver, whatever the corpus.
    """
    spark = docs.sparkSession
    seen = stored(docs.select(text_col).mapInArrow(_count_buckets, "bucket long, n long, content binary"), "df")
    texts, total = seen.where("bucket = -1").groupBy("content").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    levels = np.zeros(DF_BUCKETS, dtype="uint8")
    if not total:
        return levels
    often = F.col("n") >= DF_STEP * total
    counts = seen.where("bucket >= 0").groupBy("bucket").agg(F.sum("n").alias("n")).where(often).collect()
    if counts and texts > total:
        heavy = np.zeros(DF_BUCKETS, dtype=bool)
        heavy[[row["bucket"] for row in counts]] = True
        lists = docs.select(text_col).mapInArrow(_heavy_lists(spark.sparkContext.broadcast(heavy)), "content binary, buckets binary")
        lists = lists.groupBy("content").agg(F.first("buckets").alias("buckets")).select("buckets")  # equal texts have equal lists
        counts = lists.mapInArrow(_count_lists, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(often).collect()
    for row in counts:
        levels[row["bucket"]] = min(int(row["n"] / total / DF_STEP), 100)
    return levels


def features(words: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes of a text and their tf-idf weights (float32)."""
    found, tf = np.unique(shingles(words, SHINGLE), return_counts=True)
    return found, (tf * idf(levels[(found % np.uint64(DF_BUCKETS)).astype("int64")])).astype("float32")


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    low = float(np.minimum(wa[both], wb[at[both]]).sum(dtype="float64"))
    high = float(wa.sum(dtype="float64") + wb.sum(dtype="float64")) - low
    return low / high if high > 0 else 1.0


def similar(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> bool:
    """Weighted or plain Jaccard similarity of SIMILARITY or more."""
    if weighted_jaccard(a, wa, b, wb) >= SIMILARITY:
        return True
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILARITY * (len(a) + len(b) - both)


# --- sketches -------------------------------------------------------------

def _variates():
    rng = np.random.Generator(np.random.PCG64(20240229))
    shape = TABLE_ROWS, HASHES
    r = rng.standard_gamma(2.0, shape, dtype="float32")
    log_c = np.log(rng.standard_gamma(2.0, shape, dtype="float32"))
    beta = rng.random(shape, dtype="float32")
    usual = _log_a(np.float32(idf(np.zeros(1))[0]), r, log_c, beta)
    return r, log_c, beta, usual


def _log_a(weight, r, log_c, beta):
    """ln a of ICWS: the sample is the feature whose a is smallest."""
    level = np.floor(np.log(weight) / r + beta)
    return log_c - r * (level - beta + np.float32(1))


def sketch(found: np.ndarray, weights: np.ndarray, tables) -> np.ndarray:
    """HASHES samples (64-bit) of a weighted set; similar sets agree in a share near their similarity."""
    r, log_c, beta, usual = tables
    keep = weights > 0
    if not keep.any():  # nothing but shingles of every text
        keep, weights = np.ones_like(keep), np.ones_like(weights)
    found, weights = found[keep], weights[keep]
    rows = ((found >> np.uint64(40)) % np.uint64(TABLE_ROWS)).astype("int64")
    plain = weights == np.float32(idf(np.zeros(1))[0])
    best = np.full(HASHES, np.inf, dtype="float32")
    chosen = np.zeros(HASHES, dtype="int64")
    for start in range(0, len(found), 4096):
        part = slice(start, start + 4096)
        a = usual[rows[part]]
        odd = np.flatnonzero(~plain[part])
        if len(odd):
            at = rows[part][odd]
            a[odd] = _log_a(weights[part][odd][:, None], r[at], log_c[at], beta[at])
        first = a.argmin(axis=0)
        low = a[first, np.arange(HASHES)]
        better = low < best
        best[better], chosen[better] = low[better], first[better] + start
    at, h = rows[chosen], np.arange(HASHES)
    level = np.floor(np.log(weights[chosen]) / r[at, h] + beta[at, h]).astype("int64")
    return mix(found[chosen] + mix(level.astype("uint64") * np.uint64(HASHES) + h.astype("uint64")))


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype="uint64")
    for column in samples.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x2545F4914F6CDD1D) + column)
    return keys.view("int64")


def _sketcher(levels):
    def run(batches):
        tables = worker_cache("icws", _variates)
        for batch in batches:
            texts = batch.column(1)
            for start, end in text_slices(texts):
                content, bands, short = [], [], []
                for words in texts_words(texts, start, end):
                    if not len(words):
                        content.append(None), bands.append(None), short.append(None)
                        continue
                    found, weights = features(words, levels.value)
                    usual = np.full_like(weights, idf(np.zeros(1))[0])
                    sketches = [sketch(found, weights, tables)]
                    if (weights != usual).any():
                        sketches.append(sketch(found, usual, tables))
                    content.append(_digest(words))
                    bands.append(np.concatenate([band_keys(samples) for samples in sketches]))
                    short.append((np.concatenate(sketches) >> np.uint64(32)).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(content, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                    names=["doc_id", "content", "bands", "samples"])
    return run


# --- candidates and links ---------------------------------------------------

def _pairs(samples: list[bytes], ids: np.ndarray, bands: np.ndarray, side: np.ndarray, two_sided: bool):
    """(i, the later partners j, their agreement) among one block of one bucket.

    A pair belongs to the first band its sketches share, so each is looked at once.
    """
    s = np.frombuffer(b"".join(samples), dtype="<u4").reshape(len(samples), HASHES)
    for i in range(len(s) - 1):
        same = s[i + 1:] == s[i]
        agree = same.mean(axis=1)
        ok = (agree >= MIN_AGREE) & (ids[i + 1:] != ids[i]) & (same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == bands[i])
        if two_sided:
            ok &= side[i + 1:] != side[i]
        if ok.any():
            yield i, np.flatnonzero(ok) + i + 1, agree[ok]


def _columns(table: pa.Table):
    keys = [table.column(c).to_numpy() for c in ("key", "x", "y")]
    return keys, table.column("id").to_numpy(), table.column("band").to_numpy(), table.column("side").to_numpy()


def _with_partner(table: pa.Table):
    """Members of a block that have a candidate."""
    keys, ids, bands, side = _columns(table)
    samples = table.column("samples").to_pylist()
    bounds = group_bounds(keys)
    wanted = np.zeros(table.num_rows, dtype=bool)
    for lo, hi in zip(bounds, bounds[1:]):
        for i, partners, _ in _pairs(samples[lo:hi], ids[lo:hi], bands[lo:hi], side[lo:hi], keys[1][lo] != keys[2][lo]):
            wanted[lo + i] = True
            wanted[lo + partners] = True
    yield from table.filter(pa.array(wanted)).combine_chunks().to_batches()


def _links(table: pa.Table):
    """Verified links of each block, those that join parts not yet joined in it."""
    keys, ids, bands, side = _columns(table)
    samples = table.column("samples").to_pylist()
    found = [np.frombuffer(x, dtype="<u8") for x in table.column("found").to_pylist()]
    weights = [np.frombuffer(x, dtype="<f4") for x in table.column("weights").to_pylist()]
    bounds = group_bounds(keys)
    left, right = [], []
    for lo, hi in zip(bounds, bounds[1:]):
        part = np.arange(hi - lo)
        for i, partners, agree in _pairs(samples[lo:hi], ids[lo:hi], bands[lo:hi], side[lo:hi], keys[1][lo] != keys[2][lo]):
            for j in partners[np.argsort(-agree, kind="stable")]:
                if part[i] == part[j]:
                    continue
                if similar(found[lo + i], weights[lo + i], found[lo + j], weights[lo + j]):
                    part[part == part[j]] = part[i]
                    left.append(ids[lo + i]), right.append(ids[lo + j])
    yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _featurer(levels):
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for start, end in text_slices(texts):
                both = [features(w, levels.value) for w in texts_words(texts, start, end)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array([f.tobytes() for f, _ in both], pa.binary()),
                     pa.array([w.tobytes() for _, w in both], pa.binary())], names=["id", "found", "weights"])
    return run


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in ``links`` (a, b): the smallest id it is connected to.

    Alternating large-star and small-star steps until nothing changes; each
    step is one aggregation and join on the links, written to shared files.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").where("u != v").distinct(), "edges")
    # at the end every u hangs on its root; a root is itself no u
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, copies) per row; class_id: the class's smallest doc_id, copies: documents with this very word sequence.

    A null doc_id gives a null class_id and takes no part; a text without words is a class of its own.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    levels = spark.sparkContext.broadcast(frequent_levels(docs))  # DF_BUCKETS bytes
    sketched = stored(docs.mapInArrow(_sketcher(levels), "doc_id long, content binary, bands array<long>, samples binary"), "sketches")
    usable = sketched.where("content is not null and doc_id is not null")
    exact = stored(usable.groupBy("content").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "exact")
    texts = (usable.join(exact.withColumnRenamed("id", "doc_id"), ["content", "doc_id"])
             .select(F.col("doc_id").alias("id"), "content", "bands", "samples").dropDuplicates(["id", "content"]))
    texts = stored(texts, "texts")

    members = (texts.select("id", F.posexplode("bands").alias("at", "key"))
               .select("id", "key", F.pmod("at", F.lit(BANDS)).alias("band"), F.floor(F.col("at") / BANDS).cast("int").alias("version")))
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spread = (members.join(sizes, "key")
              .withColumn("side", F.pmod(F.xxhash64("id"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("key", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "id", "band", "side", "version")
              .join(texts.select("id", F.col("samples").alias("every")), "id")
              .withColumn("samples", F.substring("every", F.col("version") * (4 * HASHES) + 1, F.lit(4 * HASHES))).drop("every", "version"))
    shape = "id long, key long, x int, y int, band int, side int, samples binary"
    wanted = stored(map_groups(spread, ["key", "x", "y"], _with_partner, shape, ["id"]), "candidates")
    # the same join at every size: the ids are a share of the corpus, so no broadcast
    texts_of = docs.join(wanted.select(F.col("id").alias("doc_id")).distinct().hint("merge"), "doc_id")
    described = stored(texts_of.mapInArrow(_featurer(levels), "id long, found binary, weights binary"), "features")
    links = stored(map_groups(wanted.join(described, "id"), ["key", "x", "y"], _links, "a long, b long", ["id"]), "links")

    roots = components(links)
    classes = exact.join(roots, "id", "left").select("content", F.coalesce("root", "id").alias("class_id"), "copies")
    return (sketched.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("content")).alias("content"))
            .join(classes, "content", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("copies", F.lit(1).cast("long")).alias("copies")))
