"""Single-pass table profile: per group and overall, from one scan.

The reference runs about 20 jobs per file (one count per column, describe,
min, max, then all again on the union). Here every statistic is one
expression in one per-group aggregate (partial + final hash aggregate over a
single scan); the overall row is merged from the per-group rows, which is
cheaper than grouping sets (they Expand every input row once per set). The
long forms (nulls per column, describe per column) reshape that one wide
row per group, they are not further scans.

Null predicate (type-directed): NULL or NaN for float/double columns, NULL
for everything else. Describe statistics: count of non-null values, mean,
sample standard deviation, min and max, for the numeric columns only.
Means and standard deviations are rounded half-even to ``STAT_DECIMALS``
because floating sums depend on the partition layout in their last bits.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import null_display
from tidemark.session import scratch_path

STAT_DECIMALS = 6
TOTAL_LABEL_COL = "is_total"


@contextmanager
def _at_least(spark, key: str, value: int):
    """Temporarily raise an integer session setting to ``value``."""
    old = spark.conf.get(key, None)
    raise_it = old is None or int(old) < value
    if raise_it:
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if raise_it:
            if old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def resolve_date_column(df: DataFrame, preferred: str = "Date") -> str:
    """The date column, falling back to the first column when absent."""
    return preferred if preferred in df.columns else df.columns[0]


def profile_wide(df: DataFrame, group: str, date_col: str | None = None) -> DataFrame:
    """One row per group plus one total row (group NULL, is_total = 1).

    One scan and one aggregate per group; the total row is merged from the
    per-group rows (a table with one row per group), so no row is
    aggregated twice (grouping sets would Expand every row into two).
    """
    cols = df.columns
    nums = numeric_columns(df, exclude=(group,))
    date_col = date_col or resolve_date_column(df)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    # Null counts come from count(c) (non-null values, needed for describe
    # anyway) plus, for floating columns, a NaN count: fewer aggregates per row.
    floating = [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    for c in cols:
        aggs.append(F.count(c).alias(f"count__{c}"))
    for c in floating:
        aggs.append(F.count_if(F.isnan(c)).alias(f"_nan__{c}"))
    for c in nums:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"_avg__{c}"),
                 F.stddev_samp(c).alias(f"_sd__{c}"),
                 F.min(c).cast("double").alias(f"min__{c}"),
                 F.max(c).cast("double").alias(f"max__{c}")]
    aggs += [F.min(date_col).cast("string").alias("date_min"),
             F.max(date_col).cast("string").alias("date_max")]
    # One row per group, written once as a table under the shared checkpoint
    # directory: both the group rows and the total read it back, so the input
    # is scanned and aggregated exactly once (an eager Dataset.checkpoint
    # would run the aggregate twice: once to count, once to save).
    spark = df.sparkSession
    path = scratch_path(spark, "profile-groups")
    # The partial aggregate carries ~10 buffer fields per numeric column; above
    # spark.sql.codegen.maxFields whole-stage codegen is silently skipped for
    # it, so raise the limit for this one job.
    with _at_least(spark, "spark.sql.codegen.maxFields", 4 * len(aggs) + 100):
        df.groupBy(group).agg(*aggs).write.mode("overwrite").parquet(path)
    groups = spark.read.parquet(path)
    groups = groups.select("*", *[
        (F.col("row_count") - F.col(f"count__{c}") + (F.col(f"_nan__{c}") if c in floating else F.lit(0)))
        .cast("long").alias(f"nulls__{c}") for c in cols])

    # Total row from the group rows. Variance merge (parallel algorithm):
    # M2 = sum((n_g - 1) * sd_g^2) + sum(n_g * (avg_g - avg)^2).
    # The means come first, by partial sums, and meet the groups as one row.
    zero = F.lit(0).cast("long")
    mus = groups.agg(F.count(F.lit(1)).alias("_groups"), *[(F.sum(F.col(f"count__{c}") * F.col(f"_avg__{c}")) / F.nullif(F.sum(f"count__{c}"), zero)).alias(f"_mu__{c}") for c in nums])
    g2 = groups.crossJoin(F.broadcast(mus))
    tot = [F.coalesce(F.sum("row_count"), zero).alias("row_count")]
    tot += [F.coalesce(F.sum(f"nulls__{c}"), zero).cast("long").alias(f"nulls__{c}") for c in cols]
    for c in nums:
        n, a, sd, mu = F.col(f"count__{c}"), F.col(f"_avg__{c}"), F.col(f"_sd__{c}"), F.col(f"_mu__{c}")
        m2 = F.sum(F.coalesce((n - 1) * sd * sd, F.lit(0.0)) + n * (a - mu) * (a - mu))
        big_n = F.coalesce(F.sum(n), zero)
        tot += [big_n.cast("long").alias(f"count__{c}"),
                F.first(mu).alias(f"_avg__{c}"),
                F.when(big_n > 1, F.sqrt(m2 / (big_n - 1))).alias(f"_sd__{c}"),
                F.min(f"min__{c}").alias(f"min__{c}"), F.max(f"max__{c}").alias(f"max__{c}")]
    tot += [F.min("date_min").alias("date_min"), F.max("date_max").alias("date_max")]
    total = g2.agg(*tot).select(F.lit(None).cast(df.schema[group].dataType).alias(group), "*")

    both = (groups.select(*total.columns).withColumn(TOTAL_LABEL_COL, F.lit(0))
            .unionByName(total.withColumn(TOTAL_LABEL_COL, F.lit(1))))
    out = [group, "row_count", *[f"nulls__{c}" for c in cols]]
    for c in nums:
        n = F.col(f"count__{c}")
        out += [n.alias(f"count__{c}"), F.col(f"_avg__{c}").alias(f"mean__{c}"), F.col(f"_sd__{c}").alias(f"stddev__{c}"),
                f"min__{c}", f"max__{c}"]
    total_nulls = sum((F.col(f"nulls__{c}") for c in cols[1:]), F.col(f"nulls__{cols[0]}"))
    return both.select(*out, "date_min", "date_max", F.col(TOTAL_LABEL_COL).cast("int").alias(TOTAL_LABEL_COL),
                       total_nulls.cast("long").alias("total_nulls"))


def rounded(df: DataFrame, decimals: int = STAT_DECIMALS) -> DataFrame:
    """Means and standard deviations half-even to ``decimals``, for reports; the profile itself keeps full precision."""
    is_stat = lambda c: c.startswith(("mean__", "stddev__")) or c in ("mean", "stddev")
    short = lambda c: F.when(F.isnan(c), F.col(c)).otherwise(
        F.bround(F.when(~F.isnan(c), F.col(c)).cast("decimal(38,12)"), decimals).cast("double"))
    return df.select(*[short(c).alias(c) if is_stat(c) else F.col(c) for c in df.columns])


def profile_counts(wide: DataFrame, group: str) -> DataFrame:
    return wide.select(group, TOTAL_LABEL_COL, "row_count", "total_nulls")


def profile_nulls(wide: DataFrame, group: str, columns: list[str], only_nonzero: bool = False) -> DataFrame:
    """Long form: (group, is_total, column, nulls); optionally only columns with nulls."""
    long = wide.unpivot([group, TOTAL_LABEL_COL], [f"nulls__{c}" for c in columns], "column", "nulls")
    long = long.withColumn("column", F.regexp_replace("column", "^nulls__", ""))
    return long.filter(F.col("nulls") > 0) if only_nonzero else long


def profile_describe(wide: DataFrame, group: str, numeric: list[str]) -> DataFrame:
    """Long form: (group, is_total, column, count, mean, stddev, min, max)."""
    stats = ["count", "mean", "stddev", "min", "max"]
    per_col = [F.struct(F.lit(c).alias("column"),
                        *[F.col(f"{s}__{c}").cast("long" if s == "count" else "double").alias(s) for s in stats])
               for c in numeric]
    return (wide.select(group, TOTAL_LABEL_COL, F.explode(F.array(*per_col)).alias("d"))
            .select(group, TOTAL_LABEL_COL, "d.*"))


def profile_describe_text(describe: DataFrame, group: str) -> DataFrame:
    """Describe values as report text, one row per statistic; NULL shows as N/A."""
    stats = ["count", "mean", "stddev", "min", "max"]
    return describe.unpivot([group, TOTAL_LABEL_COL, "column"],
                            [F.col(s).cast("string").alias(s) for s in stats], "stat", "value") \
        .withColumn("value", null_display("value"))


def profile_date_range(wide: DataFrame, group: str) -> DataFrame:
    return wide.select(group, TOTAL_LABEL_COL, "date_min", "date_max")


def quality_verdict(wide: DataFrame) -> DataFrame:
    """Computed verdict on the total row: PASS when there are rows and no nulls."""
    return (wide.filter(F.col(TOTAL_LABEL_COL) == 1)
            .select("row_count", "total_nulls",
                    F.when((F.col("row_count") > 0) & (F.col("total_nulls") == 0), F.lit("PASS"))
                    .otherwise(F.lit("FAIL")).alias("verdict")))


def profile_schema(df: DataFrame) -> DataFrame:
    """Columns in order with their Spark type names, read off the table itself
    (``typeof`` per column in one aggregate)."""
    entries = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                        F.min(F.typeof(F.col(c))).alias("type"))
               for i, c in enumerate(df.columns)]
    return df.agg(F.array(*entries).alias("s")).select(F.explode("s").alias("e")).select("e.*")
