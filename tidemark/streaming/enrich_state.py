"""Keyed stateful enrichment for streams.

Window functions over row frames are not supported on streams, so the
trailing sums come from an arbitrary-state operator: ``groupBy(symbol)
.transformWithStateInPandas``. A symbol's state is a list of its last <= 7
rows (close, volume, seq). It never expires, like the reference's
in-memory deques, but it lives in the checkpointed state store, so a restart
resumes exactly, and ``stored_state`` reads it back as a table.

Within a micro-batch a symbol's rows arrive in chunks, in no order. A symbol
that fits one chunk is ordered by ``seq`` (arrival order) and folded at once. A
larger one is first laid into a map state, cut by ranges of ``SPAN`` sequence
numbers, and folded range by range in order, so the memory a symbol takes is one
chunk or one range, whatever its share of the batch; the map is empty again
afterwards. (State stores keep such values on disk: the RocksDB provider, which the
operator needs, is set for the query.)

The fold only emits trailing sums and frame sizes; rounding and the flags are
applied afterwards by the same Spark expressions as the batch plan, so both
paths round in the same place.

A row behind the last ``seq`` of the state (its file or offset came late) is folded
where it arrives, as in the reference, and flagged ``late``: its averages
differ from those of an ordered batch.

Work is one vectorised pass (numpy) per chunk or range, not a Python loop per row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.operators.indicators import HALO, WINDOW_ROWS, finish_indicators
from tidemark.schemas import ENRICHED_COLUMNS

# The fold runs in Python workers, which need not have this package on their
# path (only the driver imported it): ship this module's functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TAIL_SCHEMA = "close double, volume bigint, seq bigint"
NO_RANGE = 1 << 62
SPAN = 4096  # sequence numbers a range: rows of a symbol held at once, besides one chunk
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOLD_SCHEMA = ("symbol string, date string, open double, high double, low double, close double, "
               "volume bigint, seq bigint, _csum double, _vsum bigint, _rows int, late boolean")
FOLD_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume", "seq", "_csum", "_vsum", "_rows", "late"]


def trailing_sums(prev_closes, prev_volumes, closes: np.ndarray, volumes: np.ndarray):
    """Trailing (<= 7 row) sums for new rows given the previous <= 6 values.

    Sums run oldest to newest (zero padding in front adds exactly nothing),
    matching a left-to-right sum over the window.
    """
    k = len(prev_closes)
    pad = HALO - k
    c = np.concatenate([np.zeros(pad), np.asarray(prev_closes, dtype="float64"), closes.astype("float64")])
    v = np.concatenate([np.zeros(pad, dtype="int64"), np.asarray(prev_volumes, dtype="int64"),
                        volumes.astype("int64")])
    cw = np.lib.stride_tricks.sliding_window_view(c, WINDOW_ROWS)
    vw = np.lib.stride_tricks.sliding_window_view(v, WINDOW_ROWS)
    csum = cw[:, 0].copy()
    for j in range(1, WINDOW_ROWS):
        csum = csum + cw[:, j]
    vsum = vw.sum(axis=1)
    rows = np.minimum(np.arange(1, len(closes) + 1) + k, WINDOW_ROWS).astype("int32")
    return csum, vsum, rows


def fold_rows(rows: pd.DataFrame, tail: list[tuple]) -> tuple[pd.DataFrame, list[tuple]]:
    """``rows`` of one symbol, in any order, after the ``tail`` (close, volume, seq) rows before them: (folded rows, new tail).

    The new tail's rows carry the highest ``seq`` seen, which is what a later row is late against.
    """
    rows = rows.sort_values("seq", kind="stable")
    closes, volumes = rows["close"].to_numpy(dtype="float64"), rows["volume"].to_numpy(dtype="int64")
    before = tail[-HALO:]
    csum, vsum, frame = trailing_sums([t[0] for t in before], [t[1] for t in before], closes, volumes)
    last = max((t[2] for t in tail if t[2] is not None), default=None)
    late = rows["seq"] < last if last is not None else False
    known = [int(x) for x in (last, rows["seq"].max()) if not pd.isna(x)]
    highest = max(known, default=None)
    kept = (before + list(zip(closes.tolist(), volumes.tolist(), [None] * len(rows))))[-WINDOW_ROWS:]
    return rows.assign(_csum=csum, _vsum=vsum, _rows=frame, late=late)[FOLD_COLUMNS], [(c, v, highest) for c, v, _ in kept]


class TrailingFold(StatefulProcessor):
    """The last rows of a symbol as a list state; a large micro-batch goes through a map state, range by range."""

    def init(self, handle) -> None:
        self.tail = handle.getListState("tail", TAIL_SCHEMA)
        self.waiting = handle.getMapState("waiting", "range bigint, part bigint", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tail = [tuple(t) for t in self.tail.get()] if self.tail.exists() else []
        first = next(rows, None)
        second = next(rows, None) if first is not None else None
        if second is None:
            ranges = iter([first] if first is not None and len(first) else [])
        else:
            ranges = self._by_range(first, second, rows)
        for some in ranges:
            out, tail = fold_rows(some, tail)
            yield out
        if tail:
            self.tail.put(tail)

    def _by_range(self, first, second, rest) -> Iterator[pd.DataFrame]:
        import itertools
        import pickle

        parts: dict[int, int] = {}
        for n, chunk in enumerate(itertools.chain([first, second], rest)):
            # a null seq comes last, as in the sort of a single chunk
            for at, some in chunk.groupby((chunk["seq"] // SPAN).fillna(NO_RANGE).astype("int64"), sort=False):
                part = parts.get(int(at), 0)
                self.waiting.updateValue((int(at), part), (pickle.dumps(some, protocol=5),))
                parts[int(at)] = part + 1
        for at in sorted(parts):
            keys = [(at, part) for part in range(parts[at])]
            yield pd.concat([pickle.loads(self.waiting.getValue(k)[0]) for k in keys], ignore_index=True)
            for k in keys:
                self.waiting.removeKey(k)

    def close(self) -> None:
        pass


def stream_enrich(valid: DataFrame) -> DataFrame:
    """Valid bar stream (BAR columns + seq) -> enriched stream (+ seq, late)."""
    with_list_state(valid.sparkSession)
    folded = (valid.select(*FOLD_COLUMNS[:8])
              .groupBy("symbol")
              .transformWithStateInPandas(TrailingFold(), FOLD_SCHEMA, "Append", "None"))
    return finish_indicators(folded, F.col("_csum"), F.col("_vsum"), F.col("_rows")).select(*ENRICHED_COLUMNS, "seq", "late")


def with_list_state(spark: SparkSession) -> None:
    """Set the state store that list and map states need; streams started from here on use it."""
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(symbol, place, close, volume, seq) of the rows that a stopped stream of ``stream_enrich`` would go on from; place 0 is the oldest."""
    rows = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "tail").option("flattenCollectionTypes", "false").load())
    return (rows.select(F.col("key.symbol").alias("symbol"), F.posexplode("list_value").alias("place", "row"))
            .select("symbol", "place", "row.close", "row.volume", "row.seq"))
