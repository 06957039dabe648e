"""Result sets behind the analysis step: series, overlays, counts, summary.

All are lazy DataFrames over the enriched table; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def series_close(enriched: DataFrame) -> DataFrame:
    """Price series per symbol."""
    return enriched.select("symbol", "date", "close")


def series_close_vs_ma(enriched: DataFrame, symbol: str) -> DataFrame:
    """Close next to its 7-row moving average for one symbol."""
    return enriched.filter(F.col("symbol") == symbol).select("date", "close", "moving_avg_7")


def anomaly_points(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("is_anomaly")).select("symbol", "date", "close")


def spike_points(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("volume_spike")).select("symbol", "date", "volume")


def anomaly_counts(enriched: DataFrame) -> DataFrame:
    """Anomalies per symbol, most first; symbols without any are absent."""
    return (enriched.filter(F.col("is_anomaly")).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("anomalies"))
            .orderBy(F.col("anomalies").desc(), F.col("symbol")))


def most_volatile(enriched: DataFrame) -> DataFrame:
    """The symbol with most anomalies (ties: symbol ascending). Empty when none."""
    return anomaly_counts(enriched).limit(1)


def summary_totals(enriched: DataFrame) -> DataFrame:
    """Records, anomalies and spikes in one aggregate pass."""
    return enriched.agg(F.count(F.lit(1)).alias("total_records"),
                        F.count_if(F.col("is_anomaly")).alias("total_anomalies"),
                        F.count_if(F.col("volume_spike")).alias("total_spikes"))


def distinct_symbols(enriched: DataFrame) -> DataFrame:
    return enriched.select("symbol").distinct()


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` in which NULL equals NULL; the keys come from the left (no keys: the one row of ``right``)."""
    if not keys:
        return left.crossJoin(right)
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(other[f"_r_{k}"])
    return left.join(other, cond).drop(*[f"_r_{k}" for k in keys])


def positions(df: DataFrame, order: list[str], within: list[str] | None = None,
              bucket: Column | None = None, name: str = "pos",
              buckets: list[Column] | None = None) -> DataFrame:
    """1-based position of every row in ``order`` (per ``within`` group, or
    over the whole frame), without a window over a whole group.

    ``buckets`` are nested, order-preserving coarsenings of the ordering,
    coarse to fine (e.g. hour, then second of a timestamp); ``bucket`` is the
    single-level shorthand (default: the first 7 characters of the first
    order column). A row's position is the rank inside its finest bucket plus,
    for every level, the running count of the earlier buckets of that level
    inside the enclosing bucket. Each running count is a window over a count
    table partitioned by the enclosing bucket, so every window is bounded by
    the bucket granularity, not by the size of a group. Rows are shuffled
    once, on (group, finest bucket). Without ``within`` the top level runs
    in one task over the per-bucket counts.
    """
    within = within or []
    if buckets is None:
        buckets = [bucket if bucket is not None else F.substring(F.col(order[0]).cast("string"), 1, 7)]
    names = [f"_pb{i}" for i in range(len(buckets))]
    b = df
    for n, expr in zip(names, buckets):
        b = b.withColumn(n, expr)
    counts = b.groupBy(*within, *names).agg(F.count(F.lit(1)).alias("_cnt"))
    pos = F.lit(0).cast("long")
    offsets = None
    for level in range(len(names)):
        outer = within + names[:level]
        level_counts = counts.groupBy(*outer, names[level]).agg(F.sum("_cnt").alias("_lc"))
        w = (Window.partitionBy(*outer) if outer else Window.partitionBy()).orderBy(names[level])
        off = level_counts.select(*outer, names[level], F.coalesce(
            F.sum("_lc").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off{level}"))
        # a finer level joins the coarser offsets on its enclosing bucket
        offsets = off if offsets is None else null_safe_join(off, offsets, outer)
        pos = pos + F.col(f"_off{level}")
    ranked = b.withColumn("_rn", F.row_number().over(Window.partitionBy(*within, *names).orderBy(*order)))
    return (null_safe_join(ranked, offsets, [*within, *names])
            .withColumn(name, (pos + F.col("_rn")).cast("long"))
            .drop(*names, *[f"_off{i}" for i in range(len(names))], "_rn"))


def numbered(df: DataFrame, order: list, name: str = "pos", start: int = 0, parts: int | None = None) -> DataFrame:
    """``df`` with dense numbers from ``start`` in ``order`` over all rows; equal rows are in no given order.

    A range-partitioned sort, written once under the checkpoint folder; a row's number is its place in
    its part plus the rows of the parts before (a table of one row a part), so no task sees more than a part.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    row = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    (dealt.sortWithinPartitions(*order).withColumn("_part", F.shiftright(row, 33)).withColumn("_place", row.bitwiseAND((1 << 33) - 1))
     .write.parquet(path))
    laid = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (laid.join(F.broadcast(bases), "_part").withColumn(name, (F.lit(start) + F.col("_base") + F.col("_place")).cast("long"))
            .drop("_part", "_place", "_base"))


def sort_symbol_date(df: DataFrame) -> DataFrame:
    """Rows in (symbol, date) order with their 1-based global position ``pos``, by a distributed sort."""
    return numbered(df.select("symbol", "date", "close"), ["symbol", "date"], "pos", 1).select("pos", "symbol", "date", "close").orderBy("symbol", "date")
