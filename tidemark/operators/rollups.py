"""Rollups over tables of timings and batched writes.

The reference measures store calls and summarises them in memory (average,
min, max rounded to 1 dp, throughput = round(1000 / unrounded average, 1),
batched-write totals, a floored mean). Here the same summaries are
aggregates over a timing table ``(op, elapsed_ms)``; batch membership is a
row position in a fixed order divided by the batch size.

Sums are taken in DECIMAL, so they do not depend on the partition layout,
and every rounding happens half-even in decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.analysis import positions
from tidemark.schemas import LATENCY_DECIMALS, WRITE_BATCH_SIZE


def round_dec(x: Column, scale: int) -> Column:
    return F.bround(x.cast("decimal(38,12)"), scale).cast("double")


def exact_sum(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(38,10)"))


def latency_summary(timings: DataFrame, op: str = "op", ms: str = "elapsed_ms") -> DataFrame:
    """Per op: calls, avg/min/max (1 dp), throughput per second and the
    floored mean."""
    mean = exact_sum(ms).cast("double") / F.count(ms)
    return timings.groupBy(op).agg(
        F.count(F.lit(1)).alias("calls"),
        round_dec(mean, LATENCY_DECIMALS).alias("avg_ms"),
        round_dec(F.min(ms), LATENCY_DECIMALS).alias("min_ms"),
        round_dec(F.max(ms), LATENCY_DECIMALS).alias("max_ms"),
        round_dec(F.try_divide(F.lit(1000.0), mean), LATENCY_DECIMALS).alias("throughput"),
        F.floor(mean).cast("long").alias("floor_mean_ms"))


def floored_mean(rows: DataFrame, value: str) -> DataFrame:
    """The floored mean over the rows' values (of a summary: over its groups)."""
    return rows.agg(F.floor(F.avg(F.col(value).cast("double"))).cast("long").alias("floor_mean"))


def record_time(timings: DataFrame, op: str = "op", ms: str = "elapsed_ms") -> DataFrame:
    """Average time per record of a batched write, per op (1 dp)."""
    return timings.groupBy(op).agg(F.count(F.lit(1)).alias("records"),
                                   round_dec(exact_sum(ms).cast("double") / F.count(ms), 1).alias("avg_record_ms"))


def batch_assign(items: DataFrame, within: list[str], order: list[str], bucket: Column | None = None,
                 size: int = WRITE_BATCH_SIZE, buckets: list[Column] | None = None) -> DataFrame:
    """Chunk each group's rows, in ``order``, into batches of ``size``."""
    pos = positions(items, order, within=within, bucket=bucket, name="_pos", buckets=buckets)
    return pos.withColumn("batch", F.floor((F.col("_pos") - 1) / size).cast("long")).drop("_pos")


def batch_summary(items: DataFrame, within: list[str], order: list[str], bucket: Column | None = None,
                  size: int = WRITE_BATCH_SIZE) -> DataFrame:
    """Per (group, batch): records and the first / last ordering value."""
    first = order[0]
    return (batch_assign(items, within, order, bucket, size)
            .groupBy(*within, "batch")
            .agg(F.count(F.lit(1)).alias("records"), F.min(first).alias("first_" + first),
                 F.max(first).alias("last_" + first)))


def batch_throughput(timings: DataFrame, order: list[str], op: str = "op", ms: str = "elapsed_ms",
                     bucket: Column | None = None, size: int = WRITE_BATCH_SIZE,
                     buckets: list[Column] | None = None) -> DataFrame:
    """Batched-write summary per op: records, batches, total time, average
    batch time (0 dp), fastest/slowest batch (1 dp) and records per second."""
    per_batch = (batch_assign(timings, [op], order, bucket, size, buckets)
                 .groupBy(op, "batch")
                 .agg(F.count(F.lit(1)).alias("_n"), exact_sum(ms).alias("_ms")))
    total = F.sum("_ms").cast("double")
    return per_batch.groupBy(op).agg(
        F.sum("_n").cast("long").alias("records"),
        F.count(F.lit(1)).alias("batches"),
        round_dec(total, 0).alias("total_ms"),
        round_dec(total / F.count(F.lit(1)), 0).alias("avg_batch_ms"),
        round_dec(F.min("_ms"), 1).alias("min_batch_ms"),
        round_dec(F.max("_ms"), 1).alias("max_batch_ms"),
        round_dec(F.try_divide(F.sum("_n"), total / 1000.0), 1).alias("records_per_sec"))
