"""A message log on plain files, read as a stream whose offsets are message numbers.

``append`` numbers messages densely in their order of arrival and writes them as
Parquet under ``<root>/rows=<first number>``, range-partitioned and sorted by number, then
an index of its files (path, first and last number) under ``<root>/index=<first number>``.
An append counts once its index is complete; what a dead attempt left is overwritten, as
the next append starts at the same number.

``MessageLog`` is the streaming source over it. An offset is the number of the next
message, kept in the query's checkpoint; nothing depends on file times or
names, so the order holds on any store. ``rows_per_batch`` bounds a micro-batch by
messages; the source then reads where the query stands from its ``checkpoint``, so a
restarted one goes on in the same steps (run it with ``drain``: an available-now trigger
asks such a source once only). A micro-batch's partitions are the files, or the parts of files, that hold its
range; tasks skip the row groups outside it. Paths are opened with pyarrow: local ones
or those of a store that it knows by URI.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.operators.analysis import numbered
from tidemark.sources.fs import committed_dirs

# Workers, and the driver's source process, need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "message_log"


def append(messages: DataFrame, root: str, order: list[str], files: int = 8) -> tuple[int, int]:
    """Append ``messages`` (value, and the columns of ``order``); returns the first number and the one after the last."""
    spark = messages.sparkSession
    first = end(spark, root)
    rows, index = f"{root}/rows={first:020d}", f"{root}/index={first:020d}"
    (numbered(messages, order, "seq", first, files).select("seq", "value").repartitionByRange(files, "seq").sortWithinPartitions("seq")
     .write.mode("overwrite").parquet(rows))
    found = (spark.read.parquet(rows).groupBy(F.input_file_name().alias("file"))
             .agg(F.min("seq").alias("first"), F.max("seq").alias("last")))
    found.coalesce(1).write.mode("overwrite").parquet(index)  # a row a file
    return first, end(spark, root)


def end(spark: SparkSession, root: str) -> int:
    """The number of the next message."""
    indexes = [f"{root}/{d}" for d in committed_dirs(spark, root, "index=")]
    if not indexes:
        return 0
    return (spark.read.schema("file string, first bigint, last bigint").parquet(*indexes).agg(F.max("last")).first()[0] or -1) + 1


def stream(spark: SparkSession, root: str, rows_per_batch: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """(seq, value) of the log as a stream, from its start or the checkpoint's offset."""
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(FORMAT).option("path", root)
    if rows_per_batch:
        if not checkpoint:
            raise ValueError("rows_per_batch needs the query's checkpoint")
        reader = reader.option("rows_per_batch", rows_per_batch).option("checkpoint", checkpoint)
    return reader.load()


def drain(writer) -> str:
    """Run a stream (a DataStreamWriter) over all that is in its log now, in as many micro-batches as it takes; returns the query's id."""
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query.id


class Stretch(InputPartition):
    """Messages ``first`` to ``last`` of one file."""

    def __init__(self, file: str, first: int, last: int):
        self.file, self.first, self.last = file, first, last


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "seq bigint, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogReader(self.options["path"], int(self.options.get("rows_per_batch", 0)), self.options.get("checkpoint"))


class LogReader(DataSourceStreamReader):
    def __init__(self, root: str, rows_per_batch: int, checkpoint: str | None):
        self.root, self.rows_per_batch, self.checkpoint, self.at = root, rows_per_batch, checkpoint, None

    def initialOffset(self) -> dict:
        return {"seq": 0}

    def latestOffset(self) -> dict:
        last = max((f[2] for f in self._files()), default=-1) + 1
        if not self.rows_per_batch:
            return {"seq": last}
        if self.at is None:
            self.at = _planned(self.checkpoint)
        return {"seq": max(self.at, min(last, self.at + self.rows_per_batch))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = start["seq"], end["seq"] - 1
        self.at = end["seq"]
        return [Stretch(f, max(a, lo), min(b, hi)) for f, a, b in self._files() if a <= hi and b >= lo]

    def read(self, partition: Stretch) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, path = _opened(partition.file)
        with store.open_input_file(path) as handle:
            file = pq.ParquetFile(handle)
            groups = [g for g in range(file.num_row_groups) if _overlaps(file.metadata.row_group(g), partition)]
            for batch in file.iter_batches(row_groups=groups, columns=["seq", "value"]):
                kept = batch.filter(pc.and_(pc.greater_equal(batch["seq"], partition.first), pc.less_equal(batch["seq"], partition.last)))
                if kept.num_rows:
                    yield kept

    def commit(self, end: dict) -> None:
        pass

    def _files(self) -> list[tuple[str, int, int]]:
        """(file, first, last) of every append whose index is complete."""
        import pyarrow.fs as pf
        import pyarrow.parquet as pq

        store, root = _opened(self.root)
        found = []
        for entry in store.get_file_info(pf.FileSelector(root, allow_not_found=True)):
            if entry.base_name.startswith("index=") and store.get_file_info(f"{entry.path}/_SUCCESS").type == pf.FileType.File:
                for f in store.get_file_info(pf.FileSelector(entry.path)):
                    if f.base_name.endswith(".parquet"):
                        table = pq.read_table(store.open_input_file(f.path))
                        found += list(zip(*(table[c].to_pylist() for c in ("file", "first", "last"))))
        return sorted(found, key=lambda f: f[1])


def _planned(checkpoint: str) -> int:
    """Where the last planned micro-batch of a query ends, 0 if there is none."""
    import json

    import pyarrow.fs as pf

    store, root = _opened(checkpoint)
    batches = [f for f in store.get_file_info(pf.FileSelector(f"{root}/offsets", allow_not_found=True)) if f.base_name.isdigit()]
    if not batches:
        return 0
    with store.open_input_file(max(batches, key=lambda f: int(f.base_name)).path) as handle:
        return json.loads(handle.read().decode().splitlines()[-1])["seq"]  # one source: its offset is the last line


def _opened(path: str):
    import pyarrow.fs as pf
    from urllib.parse import unquote, urlparse

    if urlparse(path).scheme in ("", "file"):
        return pf.LocalFileSystem(), unquote(urlparse(path).path)
    return pf.FileSystem.from_uri(path)


def _overlaps(group, partition: Stretch) -> bool:
    stats = group.column(0).statistics
    return stats is None or not stats.has_min_max or (stats.min <= partition.last and stats.max >= partition.first)
