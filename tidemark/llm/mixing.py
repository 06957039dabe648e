"""Mixing sources to target weights by Pareto order sampling.

Sources share ``total`` = 150 % of all words by weight; a target stops at
``MAX_COPIES`` times its source's words and the excess is shared again by
weight, until none is above: the level L with sum(min(cap, L x weight)) = total.

A document of a source with rate r = target / words is to be taken r times on
average: floor(r) whole copies are certain, and the rest is an unequal-probability
sample. A document's inclusion probability p is the rate's fraction, or higher
or lower by an optional ``preference`` column (bent on the odds). Pareto order
sampling ranks documents by random odds over inclusion odds,
u / (1 - u) x (1 - p) / p, u from a hash of seed and doc_id, and takes the
smallest: a source's documents in that order while they bring its words nearer
to the target.

Running sums over a source use SLOTS slots of the rank, so no task or window
holds a source: words are summed per slot, then ranked inside a slot.

Documents without words (null text too) have size 0 and are taken 0 words;
a null source is a source of its own, the last. Rows that share a doc_id share
u, and are ordered by size. Documents with a null doc_id share one u.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2.0
SEED = "mix-1"
SLOTS = 4096  # of a source's order, at least; SLOT_ROWS documents share one on average where there are more
SLOT_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blanks and line ends; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, BLANKS), lambda w: w != "")), F.lit(0)).cast("long")


def _order(sources: DataFrame) -> DataFrame:
    """Add ``position`` (0-based) of each source by code point, null last, without gathering the sources in one task.

    A range-partitioned sort, written once; a row's position is its number within its part and the rows of the parts before.
    """
    cut = sources.withColumn("_last", F.col("source").isNull())
    row = F.monotonically_increasing_id()
    sorted_ = stored(cut.repartitionByRange("_last", "source").sortWithinPartitions("_last", "source")
                     .withColumn("_part", F.shiftright(row, 33)).withColumn("_at", row.bitwiseAND((1 << 33) - 1)), "sources")
    parts = sorted_.groupBy("_part").agg(F.count("*").alias("n"))  # a row per sort task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return sorted_.join(bases, "_part").withColumn("position", F.col("_base") + F.col("_at")).drop("_last", "_part", "_at", "_base")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> (source, source_size, target), by water-filling.

    Each round fixes the sources whose share exceeds their cap; the others' level can only rise, so it ends after as many
    rounds as there are levels at which a source is capped (one aggregate of the source table each).
    """
    index = F.pmod("position", F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), index + 1)
    table = stored(_order(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(cap)), "weights")
    goal = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        row = table.agg(F.sum(F.when(F.col("cap") <= F.col("weight") * level, F.col("cap"))), F.sum(F.when(F.col("cap") > F.col("weight") * level, F.col("weight"))),
                        F.count(F.when(F.col("cap") <= F.col("weight") * level, 1))).first()
        if row[2] == capped or row[1] is None:
            break
        capped, level = row[2], (goal - float(row[0] or 0)) / row[1]
    return table.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", preference: str | None = None,
        weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies (0 .. cap), taken, and the columns of ``keep``.

    ``preference``: a positive column that multiplies a document's inclusion odds; without one its size does (longer
    documents are likelier, as the target is one of words). A document is taken if that leaves the sum nearer to the
    target; one too long for what is left is passed over and takes no words from those after it.
    """
    # a row without id draws by its text
    drawn = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                        F.md5(drawn.cast("binary")).alias("draw"), *([F.col(preference).cast("double").alias("preference")] if preference else []),
                        F.struct(F.lit(0), *keep).alias("kept"))  # under one name, as theirs may be any
    sized = stored(sized if preference else sized.withColumn("preference", F.col("size").cast("double")), "sizes")
    rows, usual = sized.where("size > 0").agg(F.count("*"), F.avg("preference")).first()
    slots = max(SLOTS, rows // SLOT_ROWS)
    shares = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "targets")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    ranked = (sized.join(shares, sized["source"].eqNullSafe(shares["source"])).drop(shares["source"])
              .withColumn("whole", F.least(F.floor(rate + 1e-12), F.lit(cap)).cast("int"))
              .withColumn("odds", F.try_divide(rate - F.col("whole"), 1 - (rate - F.col("whole"))))
              .withColumn("u", (F.conv(F.substring("draw", 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52))
              .withColumn("x", F.try_divide(F.col("u"), (1 - F.col("u")) * F.coalesce("preference", F.lit(1.0)))))
    # rank = x / odds, and a source's odds are one number. y = x times the usual preference, and y / (1 + y) has x's order and is spread over (0, 1)
    spread = F.col("x") * F.lit(float(usual or 1.0))
    slotted = (ranked.withColumn("place", F.coalesce("x", F.lit(float("inf"))))
               .withColumn("slot", F.least(F.floor(F.coalesce(spread / (1 + spread), F.lit(1.0)) * slots), F.lit(slots - 1)).cast("int")))
    told = _passing_over(slotted)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("more").cast("int")).otherwise(0)
    return told.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
                       *[F.col("kept")[c].alias(c) for c in keep])


def _ahead(slotted: DataFrame) -> tuple[DataFrame, Column]:
    """``slotted`` with the words ahead of each row in its slot and in the slots before, and what they leave of the target."""
    keys = ["source", "slot"]
    slots = slotted.groupBy(*keys).agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # SLOTS rows a source
    slots = slots.select(*keys, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before_slot"))
    inside = Window.partitionBy("source", "slot").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    told = slotted.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    told = told.join(slots.withColumnRenamed("source", "s").withColumnRenamed("slot", "t"),
                     F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("t")))
    left = F.col("target") - F.col("whole") * F.col("source_size") - F.col("before") - F.col("before_slot")
    return told, left


def _passing_over(slotted: DataFrame) -> DataFrame:
    """``slotted`` plus ``more``: taken in order, where a document too long for what is left is left out of the running sum.

    A round takes each source's documents up to the first that is too long; the next goes on behind it, without those longer
    than twice what is left then (what is left only shrinks, so they stay too long). Rows without a copy to settle take no part.
    """
    base = stored(slotted.withColumn("_row", F.monotonically_increasing_id()), "to-mix")
    rest = base.where("size > 0 and odds > 0")
    taken = None
    while True:
        need = F.col("target") - F.col("whole") * F.col("source_size")
        told, left = _ahead(rest.where(F.col("size") <= 2 * need))
        told = stored(told.withColumn("_at", F.col("before") + F.col("before_slot")).withColumn("_left", left)
                      .select(*rest.columns, "_at", "_left").where("_left > 0"), "mix-round")
        stops = stored(told.where("size > 2 * _left").groupBy("source").agg(F.min("_at").alias("_stop"), F.max_by("_left", -F.col("_at")).alias("_open")), "mix-stops")
        told = told.join(stops.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
        now = told.where("_stop is null or _at < _stop").select("_row")
        taken = now if taken is None else taken.unionAll(now)
        if not stops.head(1):
            break
        # rows with nothing left at their place can fit again once the long one is out, so they come from the round's input
        rest = (rest.join(stops.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
                .join(told.where("_at <= _stop").select("_row"), "_row", "left_anti")
                .withColumn("target", F.col("_open") + F.col("whole") * F.col("source_size")).select(*rest.columns))
        rest = stored(rest, "mix-rest")
    taken = stored(taken.withColumn("more", F.lit(True)), "mix-taken")
    return base.join(taken, "_row", "left").withColumn("more", F.coalesce("more", F.lit(False)))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(text, '') AS text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
r AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY cap / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
l AS (SELECT arg_min(rest / open, cap / weight) FILTER (WHERE rest / open < cap / weight) AS level FROM r),
t AS (SELECT source, source_size, least(cap, weight * level) AS target FROM w, l),
u AS MATERIALIZED (SELECT doc_id, d.source, size, source_size, target, target / source_size AS rate, row_number() OVER () AS row,
             (CAST(CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), md5(text))), 1, 13) AS UBIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, least(floor(rate + 1e-12), 2.0) AS whole, rate - least(floor(rate + 1e-12), 2.0) AS p FROM u),
o AS MATERIALIZED (SELECT row, coalesce(source, '') AS s, source IS NULL AS is_null, size, target - whole * source_size AS need,
             row_number() OVER (PARTITION BY source ORDER BY u / ((1 - u) * size), doc_id, size) AS n FROM f WHERE size > 0 AND p > 0),
g AS (SELECT s, is_null, CAST(0 AS BIGINT) AS row, CAST(0 AS BIGINT) AS n, min(need) AS free, false AS more FROM o GROUP BY s, is_null
      UNION ALL
      SELECT o.s, o.is_null, o.row, o.n, CASE WHEN free > 0 AND size <= 2 * free THEN free - size ELSE free END, free > 0 AND size <= 2 * free
      FROM g JOIN o ON o.s = g.s AND o.is_null = g.is_null AND o.n = g.n + 1)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size > 0 THEN whole + coalesce(more, false)::INT ELSE 0 END AS INTEGER) AS copies,
       CAST(CASE WHEN size > 0 THEN (whole + coalesce(more, false)::INT) * size ELSE 0 END AS BIGINT) AS taken
FROM f LEFT JOIN (SELECT row, more FROM g WHERE row > 0) AS taking ON taking.row = f.row
"""
