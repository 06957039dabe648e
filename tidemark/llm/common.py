"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside is deleted at the end, but for frames stored with ``keep``: nothing else may be read later."""
    made: list[str] = []
    token = _passing.set(made)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in made:
            discard(spark, path)


def stored(df: DataFrame, name: str, keep: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage at files every executor can reread, so a lost executor
    costs a reread and not the whole plan above it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    made = _passing.get()
    if made is not None and not keep:
        made.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more, on whatever store it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def worker_cache(name: str, make: Callable):
    """One object per Python worker process, kept across tasks until another is asked for or ``release`` is called.

    The modules here are pickled by value, so a plain module global would be
    rebuilt for every task; a registered module survives.
    """
    holder = sys.modules.get("_corpus_worker_cache")
    if holder is None:
        holder = sys.modules["_corpus_worker_cache"] = types.ModuleType("_corpus_worker_cache")
        holder.items = {}
    if name not in holder.items:
        release()  # a reused worker holds one operator's tables at a time
        holder.items[name] = make()
    else:
        trim()
    return holder.items[name]


def release() -> None:
    """Free what an operator before left in this worker: its tables, and memory that the allocators keep for reuse."""
    holder = sys.modules.get("_corpus_worker_cache")
    if holder is not None:
        holder.items.clear()
    trim()


def trim() -> None:
    """Give unused memory back to the system; a reused worker otherwise holds the peak of every stage it has seen."""
    import ctypes

    pa.default_memory_pool().release_unused()
    free = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if free is not None:
        free(0)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
               schema: str, order: list[str] = ()) -> DataFrame:
    """Run ``fn`` over whole groups of ``keys``, many small groups at a time.

    Rows are hash-partitioned and sorted by key, then streamed: ``fn`` gets
    tables that hold complete groups in key order. Callers bound the size of a
    group (blocks), so memory is one Arrow batch plus one group.
    """
    def stream(batches):
        release()
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [tuple(batch.column(k)[i].as_py() for k in keys) for i in (0, batch.num_rows - 1)]
            if held and names[0] != last:
                yield from fn(pa.Table.from_batches(held))
                held = []
            last = names[1]
            if names[0] == last:
                held.append(batch)
                continue
            cut = _last_group_start(batch, keys)
            held.append(batch.slice(0, cut))
            yield from fn(pa.Table.from_batches(held))
            held = [batch.slice(cut)]
        if held:
            yield from fn(pa.Table.from_batches(held))

    return (df.repartition(*keys).sortWithinPartitions(*keys, *order)
            .mapInArrow(stream, schema))


def _last_group_start(batch: pa.RecordBatch, keys: list[str]) -> int:
    """First row of the group that the last row belongs to (rows are sorted)."""
    n = batch.num_rows
    want = tuple(batch.column(k)[n - 1] for k in keys)
    lo, hi = 0, n - 1
    while lo < hi:
        mid = (lo + hi) // 2
        if all(batch.column(k)[mid] == w for k, w in zip(keys, want)):
            hi = mid
        else:
            lo = mid + 1
    return lo


def group_bounds(columns: list) -> list[int]:
    """Start offsets (and the end) of runs of equal keys in sorted numpy columns."""
    import numpy as np

    n = len(columns[0])
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return [*np.flatnonzero(change).tolist(), n]


def text_slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``limit`` bytes each (a longer text stands alone)."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype="int64"))
    start, base = 0, 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield start, end
        start, base = end, int(sizes[end - 1])
