"""Reading the shared Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table; selecting ``columns`` here keeps the Parquet ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

