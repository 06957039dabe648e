"""A profile kept up part by part: an added day scans only that day.

Each part of a table (a day, a month, a landed batch) is reduced to one row per group of
mergeable moments: per column the counts, the mean, the sum of squared deviations
(M2), the least and the greatest value. Parts lie side by side in a small table,
``<root>/part=<name>``; writing a part again replaces it. A profile is their merge, by
plain aggregates on the group key (means first, then M2 around them), so no window
and no task sees more than partial sums; the total row merges the same parts.

The merged table has the columns of ``profile.profile_wide``, and all report
forms of that module apply. A part without rows leaves nothing. Parts must have the same
columns; NaN makes mean and deviation NaN, as in a profile of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.analysis import null_safe_join
from tidemark.operators.profile import TOTAL_LABEL_COL, numeric_columns, resolve_date_column


def moments(df: DataFrame, keys: list[str], date_col: str | None = None) -> DataFrame:
    """One row per group of ``keys``: row_count, nulls__c, and for numeric columns count__c, mean__c, m2__c, min__c, max__c."""
    values = [c for c in df.columns if c not in keys[1:]]  # keys after the first only place the rows
    date_col = date_col or resolve_date_column(df)
    aggs = [F.count(F.lit(1)).alias("row_count"), F.min(date_col).cast("string").alias("date_min"), F.max(date_col).cast("string").alias("date_max")]
    for c in values:
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        missing = F.col(c).isNull() | F.isnan(c) if floating else F.col(c).isNull()
        aggs.append(F.count_if(missing).alias(f"nulls__{c}"))
    for c in numeric_columns(df, tuple(keys)):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"), (F.var_pop(x) * F.count(c)).alias(f"m2__{c}"),
                 F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    return df.groupBy(*keys).agg(*aggs)


def write_parts(df: DataFrame, root: str, group: str, part: str, date_col: str | None = None) -> None:
    """Reduce ``df`` to the parts that its column ``part`` names, replacing those parts and no others."""
    (moments(df, [group, part], date_col).withColumnRenamed(part, "part").coalesce(1)  # a row a group and part
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(root))


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    found = spark.read.parquet(root).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "part" else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(root)


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The moments of all parts of each group of ``keys`` (none: of everything)."""
    nums = [c[len("m2__"):] for c in parts.columns if c.startswith("m2__")]
    nulls = [c for c in parts.columns if c.startswith("nulls__")]
    zero = F.lit(0).cast("long")
    means = parts.groupBy(*keys).agg(*[(F.sum(F.col(f"count__{c}") * F.col(f"mean__{c}")) / F.nullif(F.sum(f"count__{c}"), zero)).alias(f"_mu__{c}") for c in nums])
    both = null_safe_join(parts, means, keys) if keys else parts.crossJoin(F.broadcast(means))  # one row
    aggs = [F.coalesce(F.sum("row_count"), zero).alias("row_count"), F.min("date_min").alias("date_min"), F.max("date_max").alias("date_max")]
    aggs += [F.coalesce(F.sum(c), zero).alias(c) for c in nulls]
    for c in nums:
        n, gap = F.col(f"count__{c}"), F.col(f"mean__{c}") - F.col(f"_mu__{c}")
        aggs += [F.coalesce(F.sum(n), zero).alias(f"count__{c}"), F.first(f"_mu__{c}").alias(f"mean__{c}"),
                 F.sum(F.col(f"m2__{c}") + n * gap * gap).alias(f"m2__{c}"), F.min(f"min__{c}").alias(f"min__{c}"), F.max(f"max__{c}").alias(f"max__{c}")]
    return both.groupBy(*keys).agg(*aggs)


def profile(parts: DataFrame, group: str) -> DataFrame:
    """The profile of all parts: the columns of ``profile_wide``, a row per group and a total row."""
    nums = [c[len("m2__"):] for c in parts.columns if c.startswith("m2__")]
    nulls = [c for c in parts.columns if c.startswith("nulls__")]
    total = merged(parts, []).withColumn(group, F.lit(None).cast(parts.schema[group].dataType)).withColumn(TOTAL_LABEL_COL, F.lit(1))
    rows = merged(parts, [group]).withColumn(TOTAL_LABEL_COL, F.lit(0)).unionByName(total)
    out = [group, "row_count", *nulls]
    for c in nums:
        n = F.col(f"count__{c}")
        out += [n, F.col(f"mean__{c}"), F.when(n > 1, F.sqrt(F.col(f"m2__{c}") / (n - 1))).alias(f"stddev__{c}"), F.col(f"min__{c}"), F.col(f"max__{c}")]
    return rows.select(*out, "date_min", "date_max", F.col(TOTAL_LABEL_COL).cast("int").alias(TOTAL_LABEL_COL),
                       sum((F.col(c) for c in nulls[1:]), F.col(nulls[0])).cast("long").alias("total_nulls"))


# --- the report as a stored table --------------------------------------------------

REPORT = "section string, grp string, is_total int, item string, stat string, number double, text string"


def report(wide: DataFrame, group: str, columns: list[tuple[str, str]]) -> DataFrame:
    """The whole profile report as rows: counts, nulls per column, describe per numeric column, date range, schema and verdict."""
    nums = [c[len("mean__"):] for c in wide.columns if c.startswith("mean__")]
    nothing, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def line(section: str, item, stat: str, number=None, text=None):
        return F.struct(F.lit(section).alias("section"), (F.lit(item).cast("string")).alias("item"), F.lit(stat).alias("stat"),
                        (F.col(number).cast("double") if number else nothing).alias("number"), (F.col(text).cast("string") if text else no_text).alias("text"))

    lines = [line("counts", None, s, s) for s in ("row_count", "total_nulls")]
    lines += [line("nulls", c, "nulls", f"nulls__{c}") for c, _ in columns]
    lines += [line("describe", c, s, f"{s}__{c}") for c in nums for s in ("count", "mean", "stddev", "min", "max")]
    lines += [line("dates", None, s, text=s) for s in ("date_min", "date_max")]
    rows = wide.select(F.col(group).cast("string").alias("grp"), "is_total", F.explode(F.array(*lines)).alias("l")).select("l.section", "grp", "is_total", "l.item", "l.stat", "l.number", "l.text")
    verdict = F.when((F.col("row_count") > 0) & (F.col("total_nulls") == 0), "PASS").otherwise("FAIL")
    total = wide.where("is_total = 1")
    last = F.array(F.struct(F.lit("verdict").alias("section"), F.lit(None).cast("string").alias("item"), nothing.alias("number"), verdict.alias("text")),
                   *[F.struct(F.lit("schema").alias("section"), F.lit(c).alias("item"), F.lit(i).cast("double").alias("number"), F.lit(t).alias("text"))
                     for i, (c, t) in enumerate(columns, 1)])
    tail = total.select("is_total", F.explode(last).alias("l")).select("l.section", no_text.alias("grp"), "is_total", "l.item", F.col("l.section").alias("stat"), "l.number", "l.text")
    return rows.unionByName(tail)


def write_report(rows: DataFrame, path: str) -> None:
    """A folder a section; writing it again replaces the report."""
    rows.repartition("section").write.mode("overwrite").partitionBy("section").parquet(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    fields = REPORT.split(", ")
    return spark.read.schema(", ".join([*fields[1:], fields[0]])).parquet(path).select(*[f.split(" ")[0] for f in fields])
