"""A (symbol, date)-keyed table as numbered snapshots, in a fixed number of files.

Layout of a version: ``<root>/v=<n>.g<groups>.b<buckets>/grp=<g>/part-*.parquet``.
``grp`` is a hash of the symbol (a fixed number of folders, however many symbols),
and within it the rows are bucketed and sorted by ``(symbol, date)``. So

* a read of one symbol prunes to its folder, and its date bounds are pushed to files
  sorted by key, whose ``symbol`` column also has a bloom filter;
* changes bucketed the same way join the base on its key without moving the base,
  and a symbol that holds a large share of the rows lies in all buckets.

Every read and every change names its base version: nothing here asks for "the
newest" on its own. ``commit`` writes version n + 1 of the base n it is given and
refuses if that is complete, so a change to an outdated base is not lost in silence. (One
writer a table: two commits running at the same moment are the caller's to keep
apart.) A version is there when Spark's commit has marked it complete; an attempt that
died is overwritten. The rows a change gives lie in their buckets already, so a commit moves none.

Numbers are stored as decimals of exact representation and read back as doubles.
Rows of a null symbol or date are kept; a null key matches no change.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keyed import KEY, latest_per_key, prefix_predicate
from tidemark.schemas import ENRICHED_COLUMNS
from tidemark.session import scratch_path
from tidemark.sources.fs import committed_dirs, delete
from tidemark.sources.keyed_store import from_sink_types, to_sink_types

GROUPS = 8
BUCKETS = 8
BUCKET_ROWS = 250_000
BLOOM = {"parquet.bloom.filter.enabled#symbol": "true"}
NAME = re.compile(r"v=(\d{10})\.g(\d+)\.b(\d+)$")


class VersionConflict(ValueError):
    """The version that a commit would write is there already."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a table; all its reads see that version alone."""

    spark: SparkSession
    root: str
    version: int
    groups: int = GROUPS
    buckets: int = BUCKETS

    @property
    def path(self) -> str:
        return f"{self.root}/v={self.version:010d}.g{self.groups}.b{self.buckets}"

    def frame(self, columns: list[str] = ENRICHED_COLUMNS) -> DataFrame:
        return from_sink_types(_bucketed(self).select(*columns))

    def stored(self) -> DataFrame:
        """With the stored (decimal) types."""
        return _bucketed(self).select(*ENRICHED_COLUMNS)

    # --- reads of one symbol: one folder, and what is asked of date pushed to its files
    def symbol(self, symbol: str) -> DataFrame:
        rows = _bucketed(self).where((F.col("grp") == group_of(F.lit(symbol), self.groups)) & (F.col("symbol") == symbol))
        return from_sink_types(rows.select(*ENRICHED_COLUMNS))

    def between(self, symbol: str, start: str, end: str) -> DataFrame:
        """Both ends included; compared as text."""
        return self.symbol(symbol).where(F.col("date").between(start, end))

    def prefix(self, symbol: str, prefix: str) -> DataFrame:
        return self.symbol(symbol).where(F.col("date").startswith(prefix))

    def point(self, symbol: str, date: str) -> DataFrame:
        return self.symbol(symbol).where(F.col("date") == date)

    # --- changes: the rows of the version after this one -------------------------------
    # (with ``stored`` in the stored types, so that a commit converts the changes alone)
    def put(self, changes: DataFrame, seq: str = "seq", stored: bool = False) -> DataFrame:
        """Full records replace or add rows; the highest ``seq`` of a key wins."""
        return self._merged(latest_per_key(changes.select(*ENRICHED_COLUMNS, seq), seq), [c for c in ENRICHED_COLUMNS if c not in KEY], stored)

    def update(self, updates: DataFrame, column: str, seq: str = "seq", stored: bool = False) -> DataFrame:
        """SET ``column`` of each key; missing keys become rows with only that column."""
        return self._merged(latest_per_key(updates.select(*KEY, column, seq), seq), [column], stored)

    def delete(self, keys: DataFrame, stored: bool = False) -> DataFrame:
        """Without the rows of ``keys``; unknown keys do nothing."""
        gone = self._beside(keys.select(*KEY).distinct())
        return self._rows(stored).join(gone.hint("merge"), KEY, "left_anti")  # by buckets; a broadcast would scan files as they come

    def delete_prefix(self, prefix: str, symbols: list[str] | None = None) -> DataFrame:
        return self.frame().where(~F.coalesce(prefix_predicate(prefix, symbols), F.lit(False)))

    def _rows(self, stored: bool) -> DataFrame:
        return self.stored() if stored else self.frame()

    def _merged(self, latest: DataFrame, put: list[str], stored: bool) -> DataFrame:
        latest = to_sink_types(latest) if stored else latest
        new = self._beside(latest.select(*KEY, F.struct(*put).alias("_new")))
        return (self._rows(stored).join(new, KEY, "full_outer")
                .select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in put else F.col(c)
                          for c in ENRICHED_COLUMNS]))

    def _beside(self, changes: DataFrame) -> DataFrame:
        """``changes`` written in this version's buckets: the only rows a change moves."""
        path = scratch_path(self.spark, "changes")
        _write(changes.repartition(self.buckets, *KEY), path, self.buckets, [])
        return self.spark.table(_name(path))


def group_of(symbol, groups: int):
    return F.pmod(F.hash(symbol), F.lit(groups))


def buckets_for(rows: int) -> int:
    """Buckets for a table that grows to ``rows`` rows, so that a task's share stays the same."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def _name(path: str) -> str:
    return "tidemark_" + hashlib.sha256(path.encode()).hexdigest()[:20]


def _write(df: DataFrame, path: str, buckets: int, partitions: list[str]) -> None:
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    writer = df.write.mode("overwrite").option("path", path).bucketBy(buckets, *KEY).sortBy(*KEY)
    (writer.options(**BLOOM).partitionBy(*partitions) if partitions else writer).saveAsTable(_name(path))


def _bucketed(snapshot: Snapshot) -> DataFrame:
    """The version's files as a bucketed table; a session that did not write them registers them first."""
    spark, name = snapshot.spark, _name(snapshot.path)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(snapshot.path).schema.fields if f.name != "grp")
        where = snapshot.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({fields}, grp int) USING parquet PARTITIONED BY (grp) "
                  f"CLUSTERED BY (symbol, date) SORTED BY (symbol, date) INTO {snapshot.buckets} BUCKETS LOCATION '{where}'")
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def versions(spark: SparkSession, root: str) -> dict[int, Snapshot]:
    """All complete versions under ``root``."""
    found = [NAME.match(d) for d in committed_dirs(spark, root, "v=")]
    return {int(m[1]): Snapshot(spark, root, int(m[1]), int(m[2]), int(m[3])) for m in found if m}


def at(spark: SparkSession, root: str, version: int) -> Snapshot:
    found = versions(spark, root)
    if version not in found:
        raise FileNotFoundError(f"no complete version {version} under {root}; there are {sorted(found)}")
    return found[version]


def create(df: DataFrame, root: str, groups: int = GROUPS, buckets: int = BUCKETS) -> Snapshot:
    """Version 0. ``groups`` x ``buckets`` files: choose them by rows, as a task sorts and joins one bucket (see ``buckets_for``)."""
    # a task holds one bucket, so there is one file a folder and bucket
    return _commit(df.repartition(buckets, *KEY), Snapshot(df.sparkSession, root, 0, groups, buckets))


def commit(base: Snapshot, df: DataFrame) -> Snapshot:
    """``df``, made from ``base`` by a change, as the version after it, in the same layout."""
    return _commit(df, Snapshot(base.spark, base.root, base.version + 1, base.groups, base.buckets))


def _commit(df: DataFrame, new: Snapshot) -> Snapshot:
    if new.version in versions(new.spark, new.root):
        raise VersionConflict(f"version {new.version} is there already under {new.root}")
    _write(to_sink_types(df).withColumn("grp", group_of(F.col("symbol"), new.groups)), new.path, new.buckets, ["grp"])
    return new


def history(spark: SparkSession, root: str) -> DataFrame:
    """(version, rows, symbols) of every version, read from its own files."""
    frames = [s.frame(["symbol"]).agg(F.lit(v).cast("long").alias("version"), F.count("*").alias("rows"), F.count_distinct("symbol").alias("symbols"))
              for v, s in sorted(versions(spark, root).items())]
    if not frames:
        return spark.createDataFrame([], "version long, rows long, symbols long")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


def prune(spark: SparkSession, root: str, keep_from: int) -> list[int]:
    """Remove versions before ``keep_from``; returns them. Readers of those must have ended."""
    old = [s for v, s in versions(spark, root).items() if v < keep_from]
    for s in old:
        spark.sql(f"DROP TABLE IF EXISTS {_name(s.path)}")
        delete(spark, s.path)
    return sorted(s.version for s in old)
