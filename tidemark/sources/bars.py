"""Bars from ticks: one row per (symbol, date unit) with open/high/low/close/volume.

The reference downloads finished daily bars. Here the bars are aggregated from
the ``events`` tick table, which is what a Spark user does with raw trades:

* ``open`` / ``close`` are the value of the first / last tick, ordered by
  ``(ts, event_id)`` so ties on the timestamp are broken deterministically;
* ``high`` / ``low`` are max / min of the value; ``volume`` counts the ticks;
* ``date`` is the timestamp formatted to the grain, so string order is time
  order (the keyed table relies on that).

``min_by`` / ``max_by`` / ``max`` / ``min`` / ``count`` all have partial
aggregation, so a hot symbol is combined map-side before the shuffle: the
exchange carries at most one row per (symbol, date) per input split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table

# Date text per grain: the first N characters of the timestamp rendered as
# 'yyyy-MM-dd HH:mm:ss' ('yyyy-MM-dd', 'yyyy-MM-dd HH', 'yyyy-MM-dd HH:mm').
# String order equals time order.
GRAIN_CHARS = {"day": 10, "hour": 13, "minute": 16}

TICK_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def symbol_column(kind: str = "event_type") -> Column:
    """Which tick column names the instrument: 5 event types, or one per user."""
    if kind == "event_type":
        return F.col("event_type")
    if kind == "user_id":
        return F.col("user_id").cast("string")
    raise ValueError(f"unknown symbol kind {kind!r}")


def tick_order_key(ts: str = "ts", seq: str = "event_id") -> Column:
    """(ts, event_id) packed into one DECIMAL(38,0) with the same ordering.

    micros since the epoch (TZ-independent for TIMESTAMP_NTZ) * 10^20 plus the
    id shifted by 2^63 into [0, 2^64). A fixed-width key keeps min_by/max_by on
    the hash-aggregate path (a struct key forces a sort-based aggregate, i.e.
    a sort of every tick before the partial aggregation).
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              F.col(ts).cast("timestamp_ntz"))
    shifted = F.col(seq).cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)")
    return micros.cast("decimal(38,0)") * F.lit(str(10 ** 20)).cast("decimal(38,0)") + shifted


def bar_date(ts: str, grain: str) -> Column:
    """Wall-clock date text of a TIMESTAMP_NTZ at the grain. Casting NTZ to
    text involves no time zone (date_format would go through the session
    zone, which shifts hours inside a DST gap)."""
    return F.substring(F.col(ts).cast("timestamp_ntz").cast("string"), 1, GRAIN_CHARS[grain])


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", TICK_COLUMNS)


def aggregate_bars(tick_df: DataFrame, grain: str = "hour", symbol: str = "event_type",
                   start: str | None = None, end: str | None = None, ts: str = "ts", seq: str = "event_id",
                   value: str = "value", symbol_col: Column | None = None) -> DataFrame:
    """Aggregate ticks into OHLCV bars, optionally restricted to ``[start, end)``.

    The half-open bound mirrors the acquisition window (end exclusive). The
    bound is applied to the tick timestamp so it reaches the Parquet scan as a
    pushed filter. Column names default to the ``events`` table; any table of
    (instrument, timestamp, sequence, value) works.
    """
    t = tick_df
    if start is not None:
        t = t.filter(F.col(ts) >= F.to_timestamp_ntz(F.lit(start)))
    if end is not None:
        t = t.filter(F.col(ts) < F.to_timestamp_ntz(F.lit(end)))
    order = tick_order_key(ts, seq)
    sym = symbol_col if symbol_col is not None else symbol_column(symbol)
    return (
        t.select(sym.alias("symbol"), bar_date(ts, grain).alias("date"), F.col(ts), F.col(seq),
                 F.col(value).alias("_v"))
        .groupBy("symbol", "date")
        .agg(F.min_by("_v", order).alias("open"),
             F.max("_v").alias("high"),
             F.min("_v").alias("low"),
             F.max_by("_v", order).alias("close"),
             F.count(F.lit(1)).alias("volume"))
    )


def order_bars(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Bars from the orders table: instrument = order priority, price = total
    price, ordered by (order date, order key)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return aggregate_bars(o, grain, ts="o_orderdate", seq="o_orderkey", value="o_totalprice",
                          symbol_col=F.col("o_orderpriority"))


def bars(spark: SparkSession, sf_dir: str, grain: str = "hour", symbol: str = "event_type",
         start: str | None = None, end: str | None = None) -> DataFrame:
    return aggregate_bars(ticks(spark, sf_dir), grain, symbol, start, end)
