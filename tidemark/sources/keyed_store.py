"""A (symbol, date)-keyed table stored as Parquet, one directory per version.

Layout: ``<root>/v=<NNNNNNNNNN>/symbol=<s>/part-*.parquet``. Inside each
``symbol`` partition the files are sorted by ``date``, so a date range or a
prefix read skips row groups by their min/max statistics, and a symbol read
touches one directory (partition pruning).

A write never modifies a published version: it writes the next version and
Spark's commit marks it complete (``_SUCCESS``). Readers take the newest
complete version. A failed or retried write leaves at most an incomplete
directory that readers ignore, so executor loss mid-write is harmless.
Writing version ``n`` twice (a replayed micro-batch) overwrites the same
directory with the same rows: idempotent.

Prices are stored as exact-repr decimals (DECIMAL(38,18)) and computed values
as DECIMAL(18,2), like the reference's item attributes; reads cast back to
double for computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import to_computed_decimal, to_price_decimal
from tidemark.sources.fs import committed_dirs
from tidemark.schemas import ENRICHED_COLUMNS

PRICE_COLUMNS = ["open", "high", "low", "close"]
COMPUTED_COLUMNS = ["pct_change", "moving_avg_7"]


def to_sink_types(df: DataFrame) -> DataFrame:
    """Decimal sink types: prices DECIMAL(38,18), computed DECIMAL(18,2)."""
    out = []
    for c in df.columns:
        if c in PRICE_COLUMNS:
            out.append(to_price_decimal(c).alias(c))
        elif c in COMPUTED_COLUMNS:
            out.append(to_computed_decimal(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def from_sink_types(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in PRICE_COLUMNS + COMPUTED_COLUMNS else F.col(c)
                       for c in df.columns])


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions under ``root`` (directories with a _SUCCESS marker)."""
    return sorted(int(name[2:]) for name in committed_dirs(spark, root, "v="))


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version:010d}"


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write ``df`` as version ``version``: partitioned by symbol, date-sorted files.

    Range partitioning on (symbol, date) splits a large symbol into several
    date ranges (several writer tasks and files), where hashing on symbol
    would send a symbol holding a third of the rows to a single task.
    """
    path = version_path(root, version)
    (to_sink_types(df)
     .repartitionByRange("symbol", "date")
     .sortWithinPartitions("symbol", "date")
     .write.mode("overwrite").partitionBy("symbol").parquet(path))
    return path


def append_version(df: DataFrame, root: str) -> int:
    """Publish ``df`` as the next version and return its number."""
    v = versions(df.sparkSession, root)
    n = (v[-1] + 1) if v else 0
    write_version(df, root, n)
    return n


def read_by_symbol(spark: SparkSession, path: str) -> DataFrame:
    """A symbol-partitioned table with the symbol as text (inference would make 700 of the ticker 0700)."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "symbol" else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_version(spark: SparkSession, root: str, version: int | None = None,
                 columns: list[str] = ENRICHED_COLUMNS) -> DataFrame:
    """Read a version (default: newest complete); decimals come back as double."""
    if version is None:
        v = versions(spark, root)
        if not v:
            raise FileNotFoundError(f"no complete version under {root}")
        version = v[-1]
    df = read_by_symbol(spark, version_path(root, version))
    return from_sink_types(df.select(*columns))


def read_sink(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Read with the stored (decimal) types."""
    if version is None:
        version = versions(spark, root)[-1]
    return read_by_symbol(spark, version_path(root, version)).select(*ENRICHED_COLUMNS)
