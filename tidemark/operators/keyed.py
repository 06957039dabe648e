"""Mutations and reads of a table keyed by (symbol, date).

The reference calls a key-value store item by item. Here each mutation is a
DataFrame plan over the whole table and a batch of changes:

* ``upsert_latest``   full-record put, last ``seq`` wins per key;
* ``partial_update``  set one column, create the row when the key is missing;
* ``delete_by_key``   anti-join with the keys to delete (missing keys: no-op);
* ``delete_by_prefix`` drop rows whose date starts with a prefix, per symbol.

Only the change batch is aggregated (``max_by`` with partial aggregation, so
one hot key is combined map-side), and read once. Puts and updates are one full
outer join on the key. Deletes are an anti join that Spark may broadcast when
the *changes* are small enough (``spark.sql.autoBroadcastJoinThreshold`` is the
size check, and AQE re-plans on the actual size), else a shuffle on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import ENRICHED_COLUMNS

KEY = ["symbol", "date"]


def latest_per_key(changes: DataFrame, seq: str = "seq", key: list[str] = KEY) -> DataFrame:
    """The change with the highest ``seq`` per key.

    Changes without a ``seq`` have no place in the order and are left out. Ties
    of ``seq`` go by a hash of the whole change, so all columns come from one
    change. ``seq`` and hash are packed into one DECIMAL(38,0): a primitive
    buffer keeps this a hash aggregate with map-side partial aggregation.
    """
    payload = [c for c in changes.columns if c not in key and c != seq]
    hashed = F.hash(*[F.col(c) for c in payload]).cast("long") + F.lit(1 << 31) if payload else F.lit(0)
    place = (F.col(seq).cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(10,0)") + hashed).cast("decimal(38,0)")
    placed = changes.filter(F.col(seq).isNotNull()).withColumn("_place", place)
    return placed.groupBy(*key).agg(*[F.max_by(c, "_place").alias(c) for c in payload], F.max(seq).alias(seq))


def _put(table: DataFrame, latest: DataFrame, put: list[str], columns: list[str]) -> DataFrame:
    """``table`` with the ``put`` columns of ``latest``, which has one row per key; unknown keys become rows."""
    new = latest.select(*KEY, F.struct(*put).alias("_new"))
    return (table.select(*columns).join(new, KEY, "full_outer")
            .select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in put else F.col(c)
                      for c in columns]))


def upsert_latest(table: DataFrame, changes: DataFrame, seq: str = "seq",
                  columns: list[str] = ENRICHED_COLUMNS) -> DataFrame:
    """Full-record put: rows of ``changes`` replace rows with the same key."""
    latest = latest_per_key(changes.select(*columns, seq), seq)
    return _put(table, latest, [c for c in columns if c not in KEY], columns)


def partial_update(table: DataFrame, updates: DataFrame, column: str, seq: str = "seq",
                   columns: list[str] = ENRICHED_COLUMNS) -> DataFrame:
    """SET ``column`` = value for each key in ``updates`` (latest seq wins).
    Existing rows keep every other column; missing keys become new rows with
    only the key and ``column`` set."""
    return _put(table, latest_per_key(updates.select(*KEY, column, seq), seq), [column], columns)


def delete_by_key(table: DataFrame, keys: DataFrame) -> DataFrame:
    return table.join(keys.select(*KEY).distinct(), KEY, "left_anti")


def prefix_predicate(prefix: str, symbols: list[str] | None = None) -> Column:
    cond = F.col("date").startswith(prefix)
    return cond & F.col("symbol").isin(symbols) if symbols is not None else cond


def delete_by_prefix(table: DataFrame, prefix: str, symbols: list[str] | None = None) -> DataFrame:
    """Drop rows whose date starts with ``prefix`` (for ``symbols``, or all)."""
    return table.filter(~F.coalesce(prefix_predicate(prefix, symbols), F.lit(False)))


# --- reads (filters reach the scan: partition pruning on symbol, pushed date
# predicates prune row groups of the date-sorted files) -----------------------

def symbol_scan(table: DataFrame, symbol: str) -> DataFrame:
    return table.filter(F.col("symbol") == symbol)


def symbol_date_range(table: DataFrame, symbol: str, start: str, end: str) -> DataFrame:
    """Both ends included; string comparison (so 'BENCH-...' keys fall outside)."""
    return table.filter((F.col("symbol") == symbol) & F.col("date").between(start, end))


def prefix_scan(table: DataFrame, symbol: str, prefix: str) -> DataFrame:
    return table.filter((F.col("symbol") == symbol) & F.col("date").startswith(prefix))


def point_lookup(table: DataFrame, symbol: str, date: str) -> DataFrame:
    return table.filter((F.col("symbol") == symbol) & (F.col("date") == date))
