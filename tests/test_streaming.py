"""Batch = stream: the stateful stream gives the batch rows for any in-order
slicing into micro-batches, also across a stop and restart."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.indicators import enrich_bars
from tidemark.operators.validate import valid_part, classify
from tidemark.session import scratch_path
from tidemark.sources import messages as MSG
from tidemark.sources.bars import bars
from tidemark.streaming.enrich_state import stream_enrich, trailing_sums
from tidemark.streaming.source import file_message_stream

from paths import SF_SMOKE

import numpy as np


def test_trailing_sums_partial_and_carried_state():
    c, v, n = trailing_sums([1.0, 2.0], [1, 2], np.array([3.0, 4.0]), np.array([3, 4]))
    assert list(c) == [6.0, 10.0] and list(v) == [6, 10] and list(n) == [3, 4]


def _messages(spark):
    b = bars(spark, SF_SMOKE)
    raw = b.select(F.col("date").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
                   F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"),
                   "symbol")
    # seq = arrival order = date order (hour strings sort as time)
    return (MSG.encode(raw.select("*")).select("value")
            .withColumn("seq", F.unix_timestamp(F.to_timestamp(F.get_json_object("value", "$.Date"),
                                                               "yyyy-MM-dd HH")).cast("long"))
            .withColumn("_day", F.substring(F.get_json_object("value", "$.Date"), 1, 10)))


def _land(msgs, path, days):
    for d in days:
        msgs.filter(F.col("_day") == d).select("seq", "value").write.mode("append").parquet(path)


def _run(spark, src, out, ckpt, files_per_trigger):
    valid = valid_part(classify(file_message_stream(spark, src, files_per_trigger)), ["seq"])
    q = (stream_enrich(valid).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


@pytest.mark.parametrize("files_per_trigger", [1, 50])
def test_stream_equals_batch_with_restart(spark, files_per_trigger):
    msgs = _messages(spark)
    days = sorted(r[0] for r in msgs.select("_day").distinct().collect())
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-src", "t-out", "t-ckpt"))
    half = len(days) // 2
    _land(msgs, src, days[:half])
    _run(spark, src, out, ckpt, files_per_trigger)
    _land(msgs, src, days[half:])            # more data arrives; restart from the checkpoint
    _run(spark, src, out, ckpt, files_per_trigger)
    got = sorted(map(tuple, spark.read.parquet(out).drop("seq", "late").collect()))
    expect = sorted(map(tuple, enrich_bars(bars(spark, SF_SMOKE)).collect()))
    assert got == expect


def test_bucketed_stream_equals_batch_with_restart(spark, monkeypatch):
    from tidemark.streaming import bucketed as SB
    monkeypatch.setattr(SB, "SEQ_BUCKET", 3)  # many tiny buckets: halo crosses buckets and batches
    msgs = _messages(spark)
    days = sorted(r[0] for r in msgs.select("_day").distinct().collect())
    src, state, out, ckpt = (scratch_path(spark, n) for n in ("b-src", "b-state", "b-out", "b-ckpt"))

    def run():
        valid = valid_part(classify(file_message_stream(spark, src, 3)), ["seq"])
        q = (valid.writeStream.foreachBatch(SB.bucketed_sink(state, out)).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    half = len(days) // 2
    _land(msgs, src, days[:half])
    run()
    _land(msgs, src, days[half:])
    run()
    got = sorted(map(tuple, SB.read_output(spark, out).collect()))
    expect = sorted(map(tuple, enrich_bars(bars(spark, SF_SMOKE)).collect()))
    assert got == expect


def test_fold_ships_by_value(tmp_path):
    """Python workers need not have this package on their path: the state
    fold must unpickle in an interpreter that cannot import it."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tidemark.streaming.enrich_state import TrailingFold
    blob = tmp_path / "fold.pkl"
    blob.write_bytes(cloudpickle.dumps(TrailingFold))
    code = ("import pickle, sys\n"
            "f = pickle.load(open(sys.argv[1], 'rb'))\n"
            "try:\n    import tidemark\n    print('importable')\nexcept ImportError:\n    print(f.__name__)\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", code, str(blob)], cwd="/", capture_output=True, text=True, env=env)
    assert r.returncode == 0, r.stderr[-2000:]
    assert r.stdout.strip().splitlines()[-1] == "TrailingFold"


class _Handle:
    """List and map states in memory."""

    def __init__(self):
        self.list, self.map, self.most = [], {}, 0

    def getListState(self, name, schema):
        h = self
        return type("L", (), {"exists": lambda s: bool(h.list), "get": lambda s: iter(h.list), "put": lambda s, rows: setattr(h, "list", list(rows))})()

    def getMapState(self, name, key, value):
        h = self

        def put(s, k, v):
            h.map[k] = v
            h.most = max(h.most, len(h.map))
        return type("M", (), {"updateValue": put, "getValue": lambda s, k: h.map[k], "removeKey": lambda s, k: h.map.pop(k)})()


def _ticks(n, seed=3):
    import pandas as pd
    rng = np.random.Generator(np.random.PCG64(seed))
    p = rng.normal(100, 5, n).round(2)
    return pd.DataFrame({"symbol": "A", "date": [f"d{i:06d}" for i in range(n)], "open": p, "high": p, "low": p, "close": p,
                         "volume": rng.integers(1, 99, n), "seq": np.arange(n)})


def test_hot_symbol_is_folded_in_bounded_pieces(monkeypatch):
    import pandas as pd
    from tidemark.streaming import enrich_state as ST
    monkeypatch.setattr(ST, "SPAN", 100)
    sizes, fold = [], ST.fold_rows
    monkeypatch.setattr(ST, "fold_rows", lambda rows, tail: sizes.append(len(rows)) or fold(rows, tail))
    rows = _ticks(5000)
    shuffled = rows.sample(frac=1, random_state=1)
    chunks = [shuffled.iloc[i:i + 250] for i in range(0, 5000, 250)]
    handle, folder = _Handle(), ST.TrailingFold()
    folder.init(handle)
    out = pd.concat(list(folder.handleInputRows(("A",), iter(chunks), None)))
    assert max(sizes) <= 100 and handle.map == {} and handle.most > 0
    want, tail = fold(rows, [])
    assert out.reset_index(drop=True).equals(want.reset_index(drop=True))
    assert handle.list == tail and len(tail) == ST.WINDOW_ROWS
    # the next batch goes on from the tail, whichever way it comes
    more = _ticks(30, 5).assign(seq=lambda d: d["seq"] + 5000)
    assert list(folder.handleInputRows(("A",), iter([more]), None))[0].equals(fold(more, tail)[0])


def test_hot_symbol_in_one_micro_batch_equals_batch(spark, monkeypatch):
    from tidemark.streaming import enrich_state as ST
    monkeypatch.setattr(ST, "SPAN", 24 * 3600)  # a day of the message times below
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        msgs = _messages(spark)
        src, out, ckpt = (scratch_path(spark, n) for n in ("h-src", "h-out", "h-ckpt"))
        msgs.select("seq", "value").repartition(7).write.parquet(src)
        _run(spark, src, out, ckpt, 50)
        got = sorted(map(tuple, spark.read.parquet(out).drop("seq", "late").collect()))
        assert got == sorted(map(tuple, enrich_bars(bars(spark, SF_SMOKE)).collect()))
        state = ST.stored_state(spark, ckpt)
        last = {}
        for r in enrich_bars(bars(spark, SF_SMOKE)).orderBy("symbol", "date").collect():
            last.setdefault(r["symbol"], []).append((r["close"], r["volume"]))
        kept = {}
        for r in state.orderBy("symbol", "place").collect():
            kept.setdefault(r["symbol"], []).append((r["close"], r["volume"]))
        assert kept == {s: rows[-ST.WINDOW_ROWS:] for s, rows in last.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_behind_the_state_are_flagged_and_kept(spark):
    msgs = _messages(spark)
    days = sorted(r[0] for r in msgs.select("_day").distinct().collect())
    src, out, ckpt = (scratch_path(spark, n) for n in ("l-src", "l-out", "l-ckpt"))
    _land(msgs, src, days[2:])
    _run(spark, src, out, ckpt, 50)
    _land(msgs, src, days[:2])               # older rows, in a later micro-batch
    _run(spark, src, out, ckpt, 50)
    rows = spark.read.parquet(out)
    assert rows.count() == enrich_bars(bars(spark, SF_SMOKE)).count()
    # a symbol with no row after the second day has no state to be behind
    seen = [r[0] for r in rows.filter(F.substring("date", 1, 10) > days[1]).select("symbol").distinct().collect()]
    late = rows.filter("late")
    assert late.count() == rows.filter(F.col("symbol").isin(seen) & (F.substring("date", 1, 10) <= days[1])).count() > 0
