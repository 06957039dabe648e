"""Stream sinks: rejects and enriched rows to files, and the keyed-table upsert.

The upsert runs per micro-batch (``foreachBatch``) and writes only the table
partitions the batch touches: the live table is partitioned by ``symbol`` and a
date prefix (``part``), the touched partitions are read (dynamic partition pruning
through the semi-join) and merged so that the highest ``seq`` of a key wins (the
live table keeps it, so a late batch replaces no newer row).

Nothing is overwritten. A batch writes its partitions into a folder of its own,
``rows/c=<n>``, and then one small table, ``commits/c=<n>.<batch>``: for every
partition of the live table, the folder that holds it. Spark's marker on that table is
the publication: readers take the newest complete one, so they see the table before
the batch or after it, never a part of it, and a batch that is run again after it was
published does nothing. Folders that the last two commits no longer name are removed.
One stream at a time writes a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keyed import KEY, latest_per_key
from tidemark.schemas import ENRICHED_COLUMNS
from tidemark.sources.fs import committed_dirs, delete
from tidemark.sources.keyed_store import from_sink_types, to_sink_types

KEPT = 2  # commits whose files stay: readers of the one before the newest can end
COMMIT = re.compile(r"c=(\d{10})\.(.*)$")
PART_CHARS = 7  # 'yyyy-MM': partition unit of the live table


def _live_schema():
    from pyspark.sql import types as T
    from tidemark.schemas import COMPUTED_DECIMAL, ENRICHED_BAR, PRICE_DECIMAL
    fields = []
    for f in ENRICHED_BAR.fields:
        if f.name in ("open", "high", "low", "close"):
            fields.append(T.StructField(f.name, PRICE_DECIMAL, True))
        elif f.name in ("pct_change", "moving_avg_7"):
            fields.append(T.StructField(f.name, COMPUTED_DECIMAL, True))
        elif f.name != "symbol":
            fields.append(f)
    # Partition columns typed explicitly: inference would turn 'yyyy-MM' values
    # into non-strings and break the key match.
    return T.StructType(fields + [T.StructField("seq", T.LongType(), True), T.StructField("c", T.LongType(), True),
                                  T.StructField("symbol", T.StringType(), True), T.StructField("part", T.StringType(), True)])


def commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, batch) of every published batch, oldest first."""
    found = [COMMIT.match(d) for d in committed_dirs(spark, f"{root}/commits", "c=")]
    return sorted((int(m[1]), m[2]) for m in found if m)


def _manifest(spark: SparkSession, root: str, commit: tuple[int, str]) -> DataFrame:
    """(symbol, part, c): the folder that holds each partition of the live table."""
    return spark.read.schema("symbol string, part string, c bigint").parquet(f"{root}/commits/c={commit[0]:010d}.{commit[1]}")


def _rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_live_schema()).parquet(f"{root}/rows")


def _live(spark: SparkSession, root: str, commit: tuple[int, str]) -> DataFrame:
    """The table as of a commit; the partitions it names are pruned to before any file is read."""
    held = _manifest(spark, root, commit)
    return from_sink_types(_rows(spark, root).join(held, ["c", "symbol", "part"], "left_semi").drop("c"))


def _merged(ch: DataFrame, existing: DataFrame | None, columns: list[str]) -> DataFrame:
    """All rows of the partitions that ``ch`` (one row a key, with ``seq`` and ``part``) touches, after the upsert."""
    if existing is None:
        return ch.select(*columns, "seq", "part")
    rest = [c for c in columns if c not in KEY] + ["seq", "part"]
    old = (existing.join(ch.select("symbol", "part").distinct(), ["symbol", "part"], "left_semi")
           .select(*KEY, F.struct(*rest).alias("_old")))
    new = ch.select(*KEY, F.struct(*rest).alias("_new"))
    row = F.when(F.col("_new").isNull() | (F.col("_old.seq") > F.col("_new.seq")), F.col("_old")).otherwise(F.col("_new"))
    return (old.join(new, KEY, "full_outer").select(*KEY, row.alias("_row"))
            .select(*[c if c in KEY else F.col(f"_row.{c}").alias(c) for c in columns], "_row.seq", "_row.part"))


def merge_partitions(changes: DataFrame, root: str, seq: str = "seq",
                     columns: list[str] = ENRICHED_COLUMNS, batch: str | None = None) -> None:
    """Upsert ``changes`` (columns + ``seq``) into the live table at ``root``; ``batch`` names them, so that they count once."""
    spark = changes.sparkSession
    done = commits(spark, root)
    if batch is not None and batch in [name for _, name in done]:
        return
    last = done[-1] if done else None
    n = last[0] + 1 if last else 0
    ch = (latest_per_key(changes.select(*columns, seq), seq).withColumnRenamed(seq, "seq")
          .withColumn("part", F.substring("date", 1, PART_CHARS)).persist())  # read twice; a lost block is computed again
    try:
        merged = to_sink_types(_merged(ch, _live(spark, root, last) if last else None, columns))
        # a partition goes to tasks by date ranges, so a hot symbol is split
        (merged.repartitionByRange("symbol", "part", "date").sortWithinPartitions("symbol", "part", "date")
         .write.mode("overwrite").partitionBy("symbol", "part").parquet(f"{root}/rows/c={n}"))
        touched = ch.select("symbol", "part").distinct()
        held = touched.withColumn("c", F.lit(n).cast("long"))
        if last:
            held = _manifest(spark, root, last).join(touched, ["symbol", "part"], "left_anti").unionByName(held)
        held.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/c={n:010d}.{batch or 'once'}")  # a row a partition
    finally:
        ch.unpersist()
    if n and n % KEPT == 0:
        clean(spark, root)


def clean(spark: SparkSession, root: str, keep: int = KEPT) -> int:
    """Remove partition folders that none of the last ``keep`` commits names, and older commits; returns their number."""
    done = commits(spark, root)
    if len(done) <= keep:
        return 0
    held = _manifest(spark, root, done[-1])
    for commit in done[-keep:-1]:
        held = held.unionByName(_manifest(spark, root, commit))
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    old = (_rows(spark, root).select("c", "symbol", "part", folder.alias("folder")).where(F.col("c") <= done[-1][0])
           .distinct().join(held.distinct(), ["c", "symbol", "part"], "left_anti").select("folder").collect())  # names of folders
    for row in old:
        delete(spark, row["folder"])
    # the last commit of a stream stays known by its newest ones: a replay is of the newest batch
    for n, name in done[:-keep]:
        delete(spark, f"{root}/commits/c={n:010d}.{name}")
    return len(old)


def read_live_table(spark, root: str) -> DataFrame:
    done = commits(spark, root)
    if not done:
        return spark.createDataFrame([], _live_schema()).select(*ENRICHED_COLUMNS)
    return _live(spark, root, done[-1]).select(*ENRICHED_COLUMNS)


def upsert_sink(root: str):
    """foreachBatch function merging each micro-batch into the live table."""
    def _apply(batch: DataFrame, batch_id: int) -> None:
        # the query id is kept in the stream's checkpoint, so a restarted stream finds what it published
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_partitions(batch, root, batch=f"{stream}-{batch_id}" if stream else None)
    return _apply
