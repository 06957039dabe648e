"""Keyed-table mutations (FIXTURES F5) and the versioned store."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import keyed as K
from tidemark.schemas import ENRICHED_BAR
from tidemark.session import scratch_path
from tidemark.sources import keyed_store as KS

COLS = [f.name for f in ENRICHED_BAR.fields]


def _row(sym, date, close, pct=0.0):
    return (sym, date, close, close, close, close, 10, pct, None, False, False)


def _table(spark, rows):
    return spark.createDataFrame(rows, ENRICHED_BAR)


def _changes(spark, rows):
    schema = T.StructType(ENRICHED_BAR.fields + [T.StructField("seq", T.LongType())])
    return spark.createDataFrame(rows, schema)


def test_put_twice_same_key_higher_seq_wins(spark):
    t = _table(spark, [_row("A", "2024-01-01", 1.0)])
    ch = _changes(spark, [_row("A", "2024-01-01", 2.0) + (5,), _row("A", "2024-01-01", 3.0) + (9,),
                          _row("A", "2024-01-02", 4.0) + (1,)])
    out = {(r.symbol, r.date): r.close for r in K.upsert_latest(t, ch).collect()}
    assert out == {("A", "2024-01-01"): 3.0, ("A", "2024-01-02"): 4.0}


def test_upsert_is_idempotent(spark):
    t = _table(spark, [_row("A", "2024-01-01", 1.0), _row("B", "2024-01-01", 1.0)])
    ch = _changes(spark, [_row("A", "2024-01-01", 2.0) + (5,)])
    once = K.upsert_latest(t, ch)
    twice = K.upsert_latest(once, ch)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_partial_update_keeps_other_columns_and_creates_missing(spark):
    t = _table(spark, [_row("A", "2024-01-01", 5.0, pct=1.0)])
    up = spark.createDataFrame([("A", "2024-01-01", 2.5, 1), ("A", "BENCH-2019-01-01", -1.0, 2)],
                               "symbol string, date string, pct_change double, seq long")
    out = {r.date: r for r in K.partial_update(t, up, "pct_change").collect()}
    assert out["2024-01-01"].pct_change == 2.5 and out["2024-01-01"].close == 5.0
    new = out["BENCH-2019-01-01"]
    assert new.pct_change == -1.0 and new.close is None and new.volume is None


def test_delete_missing_key_is_noop_and_delete_then_upsert(spark):
    t = _table(spark, [_row("A", "2024-01-01", 1.0)])
    keys = spark.createDataFrame([("A", "2099-01-01")], "symbol string, date string")
    assert K.delete_by_key(t, keys).count() == 1
    ch = _changes(spark, [_row("A", "2024-01-01", 2.0) + (1,)])
    keys2 = spark.createDataFrame([("A", "2024-01-01")], "symbol string, date string")
    a = K.upsert_latest(K.delete_by_key(t, keys2), ch)
    b = K.upsert_latest(t, ch)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_prefix_delete_and_range_read(spark):
    t = _table(spark, [_row("A", "2023-01-01", 1.0), _row("A", "2023-12-31", 1.0), _row("A", "2024-01-01", 1.0),
                       _row("A", "BENCH-2019-01-01", 1.0), _row("B", "BENCH-2019-01-01", 1.0)])
    kept = K.delete_by_prefix(t, "BENCH-", ["A"]).select("symbol", "date").collect()
    assert ("B", "BENCH-2019-01-01") in [tuple(r) for r in kept]
    assert ("A", "BENCH-2019-01-01") not in [tuple(r) for r in kept]
    rng = K.symbol_date_range(t, "A", "2023-01-01", "2023-12-31").select("date").collect()
    assert sorted(r.date for r in rng) == ["2023-01-01", "2023-12-31"]


def test_versioned_store_roundtrip_and_pruning(spark):
    root = scratch_path(spark, "test-keyed")
    t = _table(spark, [_row("A", "2024-01-01", 12.31, pct=3.0), _row("B", "2024-01-02", 1.005)])
    assert KS.append_version(t, root) == 0
    assert KS.append_version(K.delete_by_prefix(t, "2024-01-02"), root) == 1
    assert KS.versions(spark, root) == [0, 1]
    assert KS.read_version(spark, root, 0).count() == 2
    latest = KS.read_version(spark, root)
    assert latest.count() == 1
    r = KS.read_sink(spark, root, 0).filter(F.col("symbol") == "B").collect()[0]
    assert str(r.close) == "1.005000000000000000"
    plan = KS.read_version(spark, root).filter((F.col("symbol") == "A") & (F.col("date") >= "2024"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "PushedFilters" in plan


def test_incomplete_version_is_ignored(spark):
    root = scratch_path(spark, "test-incomplete")
    t = _table(spark, [_row("A", "2024-01-01", 1.0)])
    KS.write_version(t, root, 0)
    # a version directory without the commit marker (crashed writer)
    t.write.parquet(KS.version_path(root, 1) + "/symbol=A")
    assert KS.versions(spark, root) == [0]
    assert KS.read_version(spark, root).count() == 1


def test_stream_sink_merge_is_idempotent(spark):
    from tidemark.streaming.sinks import merge_partitions, read_live_table
    root = scratch_path(spark, "test-live")
    first = _changes(spark, [_row("A", "2024-01-01", 1.0) + (1,), _row("A", "2024-02-01", 1.0) + (2,),
                             _row("B", "2024-01-01", 1.0) + (3,)])
    merge_partitions(first, root)
    batch = _changes(spark, [_row("A", "2024-01-02", 2.0) + (4,), _row("A", "2024-01-01", 5.0) + (5,)])
    merge_partitions(batch, root)
    once = sorted(map(tuple, read_live_table(spark, root).collect()))
    merge_partitions(batch, root)  # replay of the same micro-batch
    twice = sorted(map(tuple, read_live_table(spark, root).collect()))
    assert once == twice
    got = {(r[0], r[1]): r[5] for r in once}
    assert got == {("A", "2024-01-01"): 5.0, ("A", "2024-01-02"): 2.0, ("A", "2024-02-01"): 1.0,
                   ("B", "2024-01-01"): 1.0}


def test_stream_sink_keeps_the_newer_row_from_a_late_batch(spark):
    from tidemark.streaming.sinks import merge_partitions, read_live_table
    root = scratch_path(spark, "test-late")
    merge_partitions(_changes(spark, [_row("A", "2024-01-01", 5.0) + (5,)]), root)
    merge_partitions(_changes(spark, [_row("A", "2024-01-01", 2.0) + (2,), _row("A", "2024-01-02", 3.0) + (3,)]), root)
    assert {(r[1], r[5]) for r in read_live_table(spark, root).collect()} == {("2024-01-01", 5.0), ("2024-01-02", 3.0)}


def _live(spark, root):
    from tidemark.streaming.sinks import read_live_table
    return sorted(map(tuple, read_live_table(spark, root).collect()))


@pytest.mark.parametrize("dies_in", ["rows", "commit"])
def test_readers_see_the_table_before_or_after_a_publish(spark, monkeypatch, dies_in):
    from tidemark.streaming import sinks
    root = scratch_path(spark, "test-crash")
    sinks.merge_partitions(_changes(spark, [_row("A", "2024-01-01", 1.0) + (1,), _row("B", "2024-01-01", 1.0) + (2,)]), root, batch="s-0")
    before = _live(spark, root)
    batch = _changes(spark, [_row("A", "2024-01-02", 2.0) + (3,), _row("A", "2024-01-01", 7.0) + (4,)])
    if dies_in == "rows":  # some of the batch's files, no marker, no commit
        spark.read.parquet(f"{root}/rows/c=0").where("symbol = 'A'").write.partitionBy("symbol", "part").parquet(f"{root}/rows/c=1")
    else:  # all its files, but its commit is not complete
        sinks.merge_partitions(batch, root, batch="s-1")
        from tidemark.sources.fs import delete
        delete(spark, f"{root}/commits/c={1:010d}.s-1/_SUCCESS")
    assert _live(spark, root) == before
    sinks.merge_partitions(batch, root, batch="s-1")  # the batch is run again
    after = _live(spark, root)
    assert {(r[0], r[1]): r[5] for r in after} == {("A", "2024-01-01"): 7.0, ("A", "2024-01-02"): 2.0, ("B", "2024-01-01"): 1.0}
    monkeypatch.setattr(sinks, "_merged", lambda *a: 1 / 0)
    sinks.merge_partitions(batch, root, batch="s-1")  # published: nothing is done
    assert _live(spark, root) == after


def test_stream_sink_names_its_batches_and_removes_old_folders(spark):
    from tidemark.streaming import sinks
    root, src = scratch_path(spark, "test-commits"), scratch_path(spark, "test-commit-source")
    for i in range(6):
        _changes(spark, [_row("A", "2024-01-01", float(i)) + (i,), _row("B", f"2024-0{i + 1}-01", 1.0) + (i,)]).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    query = (stream.writeStream.foreachBatch(sinks.upsert_sink(root)).option("checkpointLocation", scratch_path(spark, "test-commit-ckpt"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert [name for _, name in sinks.commits(spark, root)][-1] == f"{query.id}-5"
    got = {(r[0], r[1]): r[5] for r in _live(spark, root)}
    assert got == {("A", "2024-01-01"): 5.0, **{("B", f"2024-0{i + 1}-01"): 1.0 for i in range(6)}}
    sinks.clean(spark, root)
    assert {(r[0], r[1]): r[5] for r in _live(spark, root)} == got
    assert [n for n, _ in sinks.commits(spark, root)] == [4, 5]
    # A's partition was written six times; those of the last two commits are left
    files = spark.read.schema(sinks._live_schema()).parquet(f"{root}/rows").inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in files if "symbol=A" in f}) == 2


def test_puts_and_updates_are_one_join(spark):
    t = _table(spark, [_row("A", "2024-01-01", 1.0)])
    ch = _changes(spark, [_row("A", "2024-01-01", 5.0) + (5,)])
    for out in (K.upsert_latest(t, ch), K.partial_update(t, ch.select("symbol", "date", "pct_change", "seq"), "pct_change")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1 and "Join FullOuter" in plan
