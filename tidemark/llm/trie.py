"""Conversations as a trie of shared prefixes.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. Turns become positional columns, ``WIDTH`` a
block, and one ROLLUP over a block's columns, within its key, aggregates all
prefixes together; ``grouping_id`` tells a prefix's length. A longer conversation
goes on in further blocks, each keyed by the node the one before it reached.

That node is the sequence of the full blocks so far, so the keys come from the same
construction one level up, where a turn is a full block: a conversation of n turns
takes log n levels, not a step a block, and all blocks of a level share one
ROLLUP. Sums over subtrees are a ROLLUP over the nodes; what lies in later
blocks reaches a node as the sum of its key's subtree one level up.

A turn's column holds half a SHA-256 of role and text (128 bits, so that
different turns do not meet at any size), then the words of the text in 8 bytes. A
node is known by 128 bits of its block's key and its columns.

Defined results: a null role or text counts as empty; null turn numbers come
first; turns of equal number are ordered by their digest, and equal ones all
count; rows of a null conv_id belong to no conversation. A base of a negative id
is rounded toward zero, as ``%`` does. An empty table has no nodes, not even a
root. Columns besides the four are ignored, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

WIDTH = 8
DIGEST = 16
SALTS = 64
CHUNK = 4096
GROUP = 20  # conversations that share the first turns of the first of them
NOTHING = b""
ROOT = b"root"


def word_count(text: Column) -> Column:
    """Runs of characters other than blanks and line ends."""
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def _half(data: Column) -> Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, DIGEST)


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tid) of every row that belongs to a conversation."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    # the role's length first, so that no two pairs are one string
    whole = F.concat_ws(":", F.length(role), role, text).cast("binary")
    words = F.unhex(F.lpad(F.hex(word_count(text)), 16, "0"))
    return (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.concat(_half(whole), words).alias("tid")))


def positions(rows: DataFrame) -> DataFrame:
    """(conv_id, tid, at): each turn's place in its conversation, from 1.

    A range-partitioned sort written once, so that a conversation of any length
    is split over tasks: a row's place is its number among the conversation's
    rows in its part, plus those in the parts before (a row per part and conversation
    that crosses parts).
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tid")]
    row = F.monotonically_increasing_id()
    laid = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("part", F.shiftright(row, 33)).withColumn("n", row.bitwiseAND((1 << 33) - 1)), "trie-turns")
    pieces = laid.groupBy("conv_id", "part").agg(F.min("n").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a sort task
    pieces = pieces.select("conv_id", "part", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return laid.join(pieces, ["conv_id", "part"]).select("conv_id", "tid", (F.col("n") + F.col("shift")).alias("at"))


def regrouped(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations, and (conv_id, tid, at) of their rebuilt turns.

    Conversation c starts with the first h turns of c - c % GROUP (those it has), h = crc32(c as text) % 4, then
    has its own turns after its first h. Turns meet their conversation in chunks, so a long one is split over tasks.
    """
    sizes = placed.groupBy("conv_id").agg(F.max("at").alias("n"))
    heads = placed.where("at <= 3").groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "tid"))).alias("head"))
    none = F.array().cast("array<struct<at:bigint,tid:binary>>")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    plan = (sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")).join(heads, "base", "left")
            .select("conv_id", "n", "h", F.slice(F.coalesce("head", none), F.lit(1), F.col("h")).alias("head")))
    plan = stored(plan, "trie-plan")
    taken = plan.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.tid", "t.at")
    chunk = F.floor(F.col("at") / CHUNK)
    shifts = plan.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / CHUNK))).alias("chunk"),
                         F.col("h"), (F.size("head") - F.col("h")).alias("shift"))
    own = (placed.withColumn("chunk", chunk).join(shifts, ["conv_id", "chunk"]).where("at > h")
           .select("conv_id", "tid", (F.col("at") + F.col("shift")).alias("at")))
    return plan.select("conv_id"), taken.unionAll(own)


# --- blocks -----------------------------------------------------------------------

def _columns(width: int) -> list[str]:
    return [f"t{i}" for i in range(1, width + 1)]


def _digest(columns: list[Column]) -> Column:
    """Of a key and the turns that are there (all of one length)."""
    return _half(F.concat(*[F.coalesce(c, F.lit(NOTHING)) for c in columns]))


def _reached(width: int) -> Column:
    """The node that a block's turns end at."""
    names = _columns(width)
    return F.when(F.col(names[-1]).isNotNull(), F.col("next")).otherwise(_digest([F.col("key"), *map(F.col, names)]))


def keyed_blocks(turns: DataFrame, width: int) -> list[DataFrame]:
    """Blocks of (conv_id, tid, at), then those of their full blocks, and so on up to a level of one block a conversation.

    conv_id, block (from 0), t1 .. (null where it has ended), key: the node before the block, next: the node after it, if it is full.
    """
    names = _columns(width)
    place = F.pmod(F.col("at") - 1, F.lit(width))
    blocks = (turns.groupBy("conv_id", F.floor((F.col("at") - 1) / width).cast("long").alias("block"))
              .agg(*[F.max(F.when(place == i, F.col("tid"))).alias(c) for i, c in enumerate(names)]))
    blocks = stored(blocks, "trie-blocks")
    root, full = F.lit(ROOT), F.col(names[-1]).isNotNull()
    if not (blocks.agg(F.max("block")).first()[0] or 0):
        return [stored(blocks.withColumn("key", root).withColumn("next", F.when(full, _digest([root, *map(F.col, names)]))), "trie-keyed")]
    above = keyed_blocks(blocks.where(full).select("conv_id", _digest([F.col(c) for c in names]).alias("tid"), (F.col("block") + 1).alias("at")), width)
    # the node after each full block: a prefix of the block above that holds it
    after = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.col(c).isNotNull().alias("there"),
                               (F.col("next") if i == width else _digest([F.col("key"), *[F.col(x) for x in names[:i]]])).alias("node")) for i, c in enumerate(names, 1)])
    nodes = (above[0].select("conv_id", "block", F.explode(after).alias("a")).where("a.there")
             .select("conv_id", (F.col("block") * width + F.col("a.i")).alias("block"), F.col("a.node").alias("node")))
    nodes = stored(nodes, "trie-reached")
    own = blocks.join(nodes.withColumnRenamed("node", "key"), ["conv_id", "block"], "left").withColumn("key", F.coalesce("key", root))
    own = own.join(nodes.select("conv_id", (F.col("block") - 1).alias("block"), F.col("node").alias("next")), ["conv_id", "block"], "left")
    return [stored(own, "trie-keyed"), *above]


def _prefixes(rows: DataFrame, width: int, *measures: Column) -> DataFrame:
    """One row per prefix: key, the turns, j (their number), path, parent, and the measures.

    A row whose turns end before a prefix does falls out of it.
    """
    names = _columns(width)
    grouped = rows.rollup("key", *names).agg(F.grouping_id().alias("gid"), F.max("next").alias("next"), *measures)
    grouped = grouped.withColumn("j", F.lit(width) - F.bit_count("gid").cast("int")).where("j > 0")
    turns = [F.col(c) for c in names]
    grouped = grouped.where(F.try_element_at(F.array(*names), F.col("j")).isNotNull())
    shorter = _digest([F.col("key"), *[F.when(F.col("j") != i, c) for i, c in enumerate(turns, 1)]])
    # the next block's key is of use for the whole block alone
    path = F.when(F.col("j") == width, F.col("next")).otherwise(_digest([F.col("key"), *turns]))
    return (grouped.withColumn("path", path).withColumn("parent", F.when(F.col("j") == 1, F.col("key")).otherwise(shorter))
            .withColumn("next", F.when(F.col("j") == width, F.col("next"))).drop("gid"))


def _subtrees(levels: list[DataFrame], values: DataFrame, width: int) -> DataFrame:
    """(path, leaves, saved) summed over the subtree of each node of the lowest level; ``values``: the same of the nodes alone.

    ``levels``: the prefixes of each level. A block's own sum is the value of its key, which is a node one level up.
    """
    names, here = _columns(width), levels[0]
    rows = stored(here.select("key", *names, "next", "path", "j").join(values, "path"), "trie-values")
    if len(levels) > 1:
        blocks = rows.where(F.col("key") != F.lit(ROOT)).groupBy(F.col("key").alias("path")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        later = _subtrees(levels[1:], blocks, width).toDF("path", "more_leaves", "more_saved")
        rows = (rows.join(later, "path", "left").withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0)))
                .withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0))))
    return stored(_prefixes(rows, width, F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select("path", "leaves", "saved"), "trie-sums")


def _ends_of(ends: DataFrame) -> DataFrame:
    """(path, ends_sha256) of (path, conv_id): the digest of a node's ids, ascending and comma-joined.

    Ids are joined in chunks of a bounded range each; a stream over a node's chunks, in order, feeds its digest, so that no
    row or task holds a hot node's ids.
    """
    def stream(batches):
        import hashlib

        path, digest = None, None
        for batch in batches:
            out = []
            for p, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if p != path:
                    if path is not None:
                        out.append((path, digest.hexdigest()))
                    path, digest = p, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], names=["path", "ends_sha256"])
        if path is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["path", "ends_sha256"])

    chunks = (ends.groupBy("path", F.floor(F.col("conv_id") / CHUNK).alias("chunk"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    return chunks.repartition("path").sortWithinPartitions("path", "chunk").mapInArrow(stream, "path binary, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` (path, parent, conv_id, ..) plus parent_conv_id, and n_children of every node.

    A node may have a large share of all nodes as children: they meet it under SALTS keys, of which each parent has those its children use.
    """
    salt = F.pmod(F.xxhash64("path"), F.lit(SALTS))
    below = nodes.where(F.col("parent").isNotNull())
    used = below.groupBy("parent", salt.alias("salt")).agg(F.count("*").alias("n"))
    used = stored(used, "trie-children")
    named = used.join(nodes.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").select("parent", "salt", "parent_conv_id")
    counts = used.groupBy(F.col("parent").alias("path")).agg(F.sum("n").alias("n_children"))
    salted = nodes.withColumn("salt", salt)
    return (salted.join(named, ["parent", "salt"], "left").drop("salt").join(counts, "path", "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))


def trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the regrouped conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = regrouped(positions(turn_ids(conversations)))
    names = _columns(width)
    levels = keyed_blocks(turns, width)
    blocks = levels[0]

    found = _prefixes(blocks, width, F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("block").alias("block"))
    words = F.conv(F.hex(F.substring(F.element_at(F.array(*names), F.col("j")), DIGEST + 1, 8)), 16, 10).cast("long")
    found = stored(found.withColumn("depth", F.col("block") * width + F.col("j")).withColumn("value", (F.col("n_convs") - 1) * words), "trie-nodes")
    # the root: every conversation is a member
    root = F.lit(ROOT)
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = (top.select(root.alias("path"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("value"))
             .unionAll(found.select("path", "parent", "conv_id", "depth", "n_convs", "value")))
    nodes = stored(_with_parents(nodes), "trie-family")

    last = blocks.groupBy("conv_id").agg(F.max("block").alias("block"))
    ended = blocks.join(last, ["conv_id", "block"]).select("conv_id", _reached(width).alias("path"))
    digests = _ends_of(convs.join(ended, "conv_id", "left").select(F.coalesce("path", root).alias("path"), "conv_id"))

    values = nodes.select("path", (F.col("n_children") == 0).cast("long").alias("leaves"), F.col("value").alias("saved"))
    whole = values.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select(root.alias("path"), "leaves", "saved")
    above = [stored(_prefixes(level, width), "trie-above") for level in levels[1:]]
    sums = _subtrees([found, *above], values.where(F.col("path") != root), width).unionAll(whole)
    empty = F.sha2(F.lit(NOTHING), 256)
    return nodes.join(sums, "path").join(digests, "path", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", empty).alias("ends_sha256"))


_TEXT = "coalesce(role, '') AS role, coalesce(text, '') AS text"
_STEPS = ", ".join(["-1"] * 8)
ORACLE = rf"""
WITH x AS (SELECT conv_id, turn, {_TEXT} FROM conversations WHERE conv_id IS NOT NULL),
y AS (SELECT conv_id, turn, sha256(len(role) || ':' || role || ':' || text) AS id, len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM x),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS at FROM y),
h AS (SELECT conv_id, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), {_STEPS}])),
             lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT h.conv_id, 0 AS part, t.at, t.id, t.words FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.at <= h.h
      UNION ALL SELECT h.conv_id, 1, t.at, t.id, t.words FROM h JOIN t ON t.conv_id = h.conv_id AND t.at > h.h),
l AS (SELECT h.conv_id, coalesce(list(r.id ORDER BY r.part, r.at) FILTER (r.id IS NOT NULL), []) AS ids, list(r.words ORDER BY r.part, r.at) AS words
      FROM h LEFT JOIN r ON r.conv_id = h.conv_id GROUP BY h.conv_id),
p AS (SELECT conv_id, d, array_to_string(ids[1:d], '') AS prefix, len(ids) = d AS ends, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
      FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM l)),
n AS (SELECT d AS depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS value,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY d, prefix),
c AS (SELECT left(prefix, 64 * (CAST(depth AS INTEGER) - 1)) AS prefix, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.prefix = n.prefix AND c.depth = n.depth),
s AS (SELECT a AS depth, left(prefix, 64 * CAST(a AS INTEGER)) AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(value) AS saved_tokens
      FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM m) GROUP BY 1, 2)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(m.n_convs AS BIGINT) AS n_convs, CAST(m.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.prefix = m.prefix AND s.depth = m.depth LEFT JOIN n AS up ON up.depth = m.depth - 1 AND up.prefix = left(m.prefix, 64 * (CAST(m.depth AS INTEGER) - 1))
"""
