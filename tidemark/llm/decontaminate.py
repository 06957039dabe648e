"""Benchmark decontamination with DataFrame functions only.

Words are runs of ASCII letters, digits and all non-ASCII characters, with A-Z
lower-cased. Windows are ``WINDOW`` consecutive words of a benchmark item; an
item of fewer words, but some, is one window. Their hashes form a broadcast set
that the windows of every text are scanned against; texts with a hit are read
again and each hit is verified word by word.

The window hashes are broadcast while they are at most ``BROADCAST_ROWS`` (8
bytes each); beyond that the same join shuffles. Null or empty texts have no
words; null items none; an empty benchmark contaminates nothing. Several items
of one id count as one item; a null item id is counted but not listed. Rows
that share a doc_id and text have equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stored

WINDOW = 10
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 5_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null gives none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), lambda w: w != "")


def _joined(left: Column, right: Column, skip: int, turn: int) -> Column:
    """Hashes of spans of ``skip`` words followed by those that begin ``skip`` words later.

    The last ones run past the end and are null (zip_with pads with null).
    """
    later = F.slice(right, skip + 1, 1 << 30)
    return F.zip_with(left, later, lambda a, b: F.shiftleft(a, turn).bitwiseOR(F.shiftrightunsigned(a, 64 - turn)).bitwiseXOR(b))


def with_window_hashes(df: DataFrame, hashes: str, lengths: list[int], out: str) -> DataFrame:
    """Add ``out``: rolling hashes of all windows of the given lengths, nulls among them, from word hashes.

    Spans of 1, 2, 4, 8 words come from doubling; a window joins the spans of its length's binary digits. Each step is
    a column of its own, as an expression used twice would be evaluated twice.
    """
    spans, width = {1: hashes}, 1
    while width * 2 <= max(lengths):
        df = df.withColumn(f"_s{width * 2}", _joined(F.col(spans[width]), F.col(spans[width]), width, 17 + width))
        spans[width * 2] = f"_s{width * 2}"
        width *= 2
    for k in lengths:
        digits = [w for w in spans if k & w]
        name, covered = spans[digits[0]], digits[0]
        for w in digits[1:]:
            df = df.withColumn(f"_w{k}_{w}", _joined(F.col(name), F.col(spans[w]), covered, 7 + w))
            name, covered = f"_w{k}_{w}", covered + w
        df = df.withColumn(f"_k{k}", F.col(name))
    every = [F.col(f"_k{k}") for k in lengths]
    return df.withColumn(out, F.concat(*every) if len(every) > 1 else every[0])


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the benchmark: (k, words, items: ids as strings, n_items)."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(window))
    return (words.select("item", k.alias("k"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.slice("w", i, k))).alias("words"))
            .groupBy("k", "words").agg(F.collect_set(F.coalesce("item", F.lit("\u0000"))).alias("items")))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text, words, spans, items) of the contaminated texts only.

    ``spans``: sorted distinct 0-based word positions inside any occurrence of a window; ``items``: sorted ids of the
    items with occurring windows. One row per distinct contaminated (doc_id, text).
    """
    windows = stored(item_windows(items, window, item_id, item_text), "item-windows")
    lengths = sorted(r[0] for r in windows.select("k").distinct().collect())  # at most `window` values
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if not lengths:
        return docs.limit(0).select("doc_id", "text", F.array().cast("array<string>").alias("words"),
                                    F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    hashed = windows.select("k", _hashed(F.col("words")).alias("h"))
    hashes = None
    for k in lengths:
        one = with_window_hashes(hashed.where(F.col("k") == k), "h", [k], "w").select(F.explode_outer("w").alias("h"))
        hashes = one if hashes is None else hashes.unionAll(one)
    hashes = stored(hashes.where("h is not null").distinct(), "window-hashes")
    hashes = F.broadcast(hashes) if hashes.count() <= BROADCAST_ROWS else hashes

    # one hash of id and text stands for a row; hashed words are computed once per row, below the explode
    scanned = docs.select(F.xxhash64("doc_id", "text").alias("row"), _hashed(words_of(F.col("text"))).alias("h"))
    # explode_outer: for explode the optimizer infers size(w) > 0 and evaluates all of w a second time, step by step below
    grams = with_window_hashes(scanned, "h", lengths, "w").select("row", F.explode_outer("w").alias("h"))
    suspects = stored(grams.join(hashes, "h", "left_semi").select("row").distinct(), "suspects")

    # verify, on the suspects only: exact words, every window compared word by word
    texts = (docs.withColumn("row", F.xxhash64("doc_id", "text")).join(suspects, "row").dropDuplicates(["row", "doc_id", "text"])
             .withColumn("uid", F.sha2(F.concat_ws("\u0001", F.col("doc_id").cast("string"), F.col("doc_id").isNull().cast("string"), "text"), 256))
             .select("uid", "doc_id", "text", words_of(F.col("text")).alias("words")))
    texts = stored(texts, "suspect-texts")
    keyed = windows.withColumn("h", F.xxhash64("k", "words"))
    spots = None
    for k in lengths:
        at = texts.where(F.size("words") >= k).select(
            "uid", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("words") - k + 1), lambda i: F.xxhash64(F.lit(k), F.slice("words", i, F.lit(k))))).alias("at", "h"))
        at = at.withColumn("k", F.lit(k))
        spots = at if spots is None else spots.unionAll(at)
    wanted = keyed.select("h", "k", F.col("words").alias("expected"), "items")
    hits = spots.join(wanted, ["h", "k"]).groupBy("uid").agg(F.collect_list(F.struct("at", "k", "expected", "items")).alias("hits"))
    found = (texts.join(hits, "uid")
             .withColumn("hits", F.filter("hits", lambda x: F.slice("words", x["at"] + 1, x["k"]) == x["expected"]))
             .where(F.size("hits") > 0))
    return found.select(
        "doc_id", "text", "words",
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["at"], x["at"] + x["k"] - 1))))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.col("hits.items")))).alias("items"))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = stored(contamination(docs, items, id_col=id_col, text_col=text_col)
                   .select(F.xxhash64("doc_id", "text").alias("row"), F.size("spans").cast("long").alias("n_hit"),
                           F.size("items").cast("long").alias("n_items"),
                           F.sha2(F.array_join(F.filter("items", lambda i: i != "\u0000"), ","), 256).alias("items_sha256")), "hits")
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"),
                       F.size(words_of(F.col(text_col))).cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return base.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def remove_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of the benchmark."""
    row = fresh(docs, "_row")
    found = stored(contamination(docs, items, id_col=id_col, text_col=text_col)
                   .select(F.xxhash64("doc_id", "text").alias(row)).distinct(), "contaminated")
    return (docs.withColumn(row, F.xxhash64(F.col(id_col), F.col(text_col)))
            .join(found, row, "left_anti").select(*docs.columns))


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words cut out of contaminated texts; what is left is joined by blanks. Other texts stay as they are."""
    row, left = fresh(docs, "_row"), fresh(docs, "_left")
    found = contamination(docs, items, id_col=id_col, text_col=text_col)
    kept = found.select(F.xxhash64("doc_id", "text").alias(row), F.array_join(F.filter(
        F.transform("words", lambda w, i: F.when(~F.array_contains("spans", i), w)), lambda w: w.isNotNull()), " ").alias(left))
    return (docs.withColumn(row, F.xxhash64(F.col(id_col), F.col(text_col))).join(stored(kept, "kept"), row, "left")
            .withColumn(text_col, F.coalesce(left, F.col(text_col))).select(*docs.columns))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, k, w[i:i + k - 1] AS win FROM (
    SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, w[i:i + k - 1] AS win FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, dw.k AS k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
