"""Raw bar files: text columns, one directory per symbol, a ticker row.

The landed files have the layout ``Date,Close,High,Low,Open,Volume,symbol``
with every value as text, and right under the header one non-data row that
repeats the ticker name in the price/volume columns (Date and symbol empty).
Scanning reads everything as STRING (no inference), keeps only rows whose
Close looks like a plain decimal number, then casts.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import is_numeric_text, to_price_decimal
from tidemark.schemas import RAW_BAR, RAW_BAR_COLUMNS, RAW_NUMERIC_COLUMNS
from tidemark.sources.fs import exists

FILE_SYMBOL = "file_symbol"  # directory partition column naming the file's symbol


def plain_text(c: str) -> Column:
    """A number as plain decimal text with at least one decimal (a cast gives 1.0E7 from ten million on).

    NULL, NaN and infinities render as a cast does; magnitudes the price decimal cannot hold keep the cast's text.
    """
    finite = F.when(~F.isnan(c) & (F.abs(F.col(c)) < F.lit(1e18)), F.col(c))
    text = F.regexp_replace(to_price_decimal(finite).cast("string"), r"(\.\d+?)0+$", "$1")
    exact = finite.isNotNull() & (to_price_decimal(finite).cast("double") == F.col(c))
    return F.when(exact, text).otherwise(F.col(c).cast("string"))


def raw_bar_rows(bars: DataFrame) -> DataFrame:
    """Bars in the raw text layout (prices in plain notation)."""
    return bars.select(F.col("date").alias("Date"), plain_text("close").alias("Close"), plain_text("high").alias("High"),
                       plain_text("low").alias("Low"), plain_text("open").alias("Open"), F.col("volume").cast("string").alias("Volume"),
                       F.col("symbol"))


def with_ticker_rows(raw: DataFrame) -> DataFrame:
    """Add the per-symbol non-data row and the file partition column; ``_ord``
    puts the ticker row first within its file."""
    data = raw.withColumn(FILE_SYMBOL, F.col("symbol")).withColumn("_ord", F.lit(1))
    tick = (raw.select(F.col("symbol").alias(FILE_SYMBOL)).distinct()
            .select(F.lit(None).cast("string").alias("Date"),
                    *[F.col(FILE_SYMBOL).alias(c) for c in ("Close", "High", "Low", "Open", "Volume")],
                    F.lit(None).cast("string").alias("symbol"), F.col(FILE_SYMBOL), F.lit(0).alias("_ord")))
    return data.unionByName(tick)


def write_bar_files(bars: DataFrame, path: str) -> str:
    """Land bars as header CSV files under ``path/file_symbol=<s>/``.

    Range partitioning on (symbol, row order, date) spreads a large symbol
    over several files; the ticker row sorts first in the symbol's first file.
    """
    (with_ticker_rows(raw_bar_rows(bars))
     .repartitionByRange(FILE_SYMBOL, "_ord", "Date")
     .sortWithinPartitions(FILE_SYMBOL, "_ord", "Date")
     .drop("_ord")
     .write.mode("overwrite").option("header", True).partitionBy(FILE_SYMBOL).csv(path))
    return path


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Keep the paths that exist (a missing file is skipped, like the publisher)."""
    keep = []
    for p in paths:
        if exists(spark, p):
            keep.append(p)
        else:
            print(f"WARNING: {p} not found - skipping", file=sys.stderr)
    return keep


def scan_bar_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All files in one scan, every column STRING (no inference), with the
    source file name for provenance."""
    paths = [paths] if isinstance(paths, str) else paths
    return (spark.read.schema(RAW_BAR).option("header", True).csv(paths)
            .select(*RAW_BAR_COLUMNS, F.col("_metadata.file_name").alias("source_file")))


def numeric_rows(raw: DataFrame, column: str = "Close") -> DataFrame:
    """Rows whose ``column`` text is a plain decimal number (drops the ticker row)."""
    return raw.filter(is_numeric_text(column))


def coerce_numeric(raw: DataFrame, columns: list[str] = RAW_NUMERIC_COLUMNS, to: str = "double") -> DataFrame:
    """try_cast each numeric column that is present; unparsable text becomes NULL."""
    return raw.select(*[F.expr(f"try_cast(`{c}` AS {to})").alias(c) if c in columns else F.col(c)
                        for c in raw.columns])


def clean_bars(raw: DataFrame) -> DataFrame:
    """Raw text rows -> typed bars (symbol, date, open, high, low, close, volume)."""
    typed = coerce_numeric(numeric_rows(raw))
    return typed.select(F.col("symbol"), F.col("Date").alias("date"), F.col("Open").alias("open"),
                        F.col("High").alias("high"), F.col("Low").alias("low"), F.col("Close").alias("close"),
                        F.expr("try_cast(Volume AS bigint)").alias("volume"))
