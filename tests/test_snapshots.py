"""Snapshots: pinned reads, changes that leave the base where it lies, a bounded number of files."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog as C
from tidemark.schemas import ENRICHED_BAR, ENRICHED_COLUMNS
from tidemark.session import scratch_path
from tidemark.sources import snapshots as S
from tidemark.sources.fs import child_dirs

from paths import SF_SMOKE

STORED = ["full_scan", "stored_summary", "stored_anomaly_counts", "upsert_latest", "partial_update", "delete_by_key", "delete_by_prefix",
          "symbol_scan", "symbol_date_range", "prefix_scan", "point_lookup", "snapshot_history"]


def _row(symbol, date, close, seq=None):
    row = (symbol, date, close, close, close, close, 10, 0.5, None, False, False)
    return row if seq is None else (*row, seq)


def _rows(spark, rows):
    schema = ENRICHED_BAR.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    return spark.createDataFrame(rows, schema + (", seq bigint" if rows and len(rows[0]) > len(ENRICHED_COLUMNS) else ""))


def _got(df):
    return sorted(((r["symbol"], r["date"], r["close"]) for r in df.collect()), key=repr)


@pytest.fixture
def base(spark):
    rows = [_row("A", "2024-01-01", 1.0), _row("A", "2024-01-02", 2.0), _row("B", "2024-01-01", 3.0), _row(None, "2024-01-01", 4.0), _row("C", None, 5.0)]
    return S.create(_rows(spark, rows), scratch_path(spark, "test-snap"), groups=4, buckets=3)


def test_stored_queries_do_not_depend_on_their_order(spark):
    def run(names):
        C._STORES.clear()
        return {n: sorted(map(repr, C.QUERIES[n](spark, SF_SMOKE).collect())) for n in names}
    forward, backward = run(STORED), run(STORED[::-1])
    for n in STORED:
        assert forward[n] == backward[n], n


def test_reads_see_their_version_alone(spark, base):
    before = _got(base.frame())
    after = S.commit(base, base.put(_rows(spark, [_row("A", "2024-01-01", 9.0, 1), _row("A", "2024-01-01", 8.0, 2), _row("D", "2024-01-05", 7.0, 3)])))
    assert _got(base.frame()) == before and base.symbol("D").count() == 0
    assert _got(after.symbol("A")) == [("A", "2024-01-01", 8.0), ("A", "2024-01-02", 2.0)]
    assert _got(after.between("D", "2024-01-05", "2024-01-05")) == [("D", "2024-01-05", 7.0)]
    assert (None, "2024-01-01", 4.0) in _got(after.frame()) and ("C", None, 5.0) in _got(after.frame())
    assert [tuple(r) for r in S.history(spark, base.root).orderBy("version").collect()] == [(0, 5, 3), (1, 6, 4)]
    assert _got(S.at(spark, base.root, 0).frame()) == before
    with pytest.raises(FileNotFoundError):
        S.at(spark, base.root, 2)


def test_a_change_to_an_outdated_base_is_refused(spark, base):
    S.commit(base, base.delete(_rows(spark, [_row("B", "2024-01-01", 0.0), _row("Z", "2024-01-01", 0.0)])))
    with pytest.raises(S.VersionConflict):
        S.commit(base, base.delete_prefix("2024-01-02"))
    assert _got(S.at(spark, base.root, 1).symbol("B")) == []


def test_a_version_without_its_marker_is_none(spark, base):
    half = S.Snapshot(spark, base.root, 1, base.groups, base.buckets)
    base.stored().withColumn("grp", F.lit(0)).write.partitionBy("grp").parquet(half.path + "/tmp")
    assert sorted(S.versions(spark, base.root)) == [0]
    done = S.commit(base, base.frame())  # overwrites what the dead attempt left
    assert _got(done.frame()) == _got(base.frame())


def test_another_session_registers_the_files(spark, base):
    want, name = _got(base.frame()), S._name(base.path)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    again = S.at(spark, base.root, 0)
    assert _got(again.frame()) == want and _got(again.point("A", "2024-01-02")) == [("A", "2024-01-02", 2.0)]


def test_updates_and_deletes(spark, base):
    up = base.update(_rows(spark, [_row("A", "2024-01-01", 0.0, 1), _row("Q", "2024-01-09", 0.0, 2)]).withColumn("pct_change", F.lit(7.25)), "pct_change")
    got = {(r["symbol"], r["date"]): (r["close"], r["pct_change"]) for r in up.collect()}
    assert got[("A", "2024-01-01")] == (1.0, 7.25) and got[("Q", "2024-01-09")] == (None, 7.25) and got[("A", "2024-01-02")] == (2.0, 0.5)
    assert _got(base.delete_prefix("2024-01", ["A"])) == [x for x in _got(base.frame()) if x[0] != "A"]
    assert base.put(_rows(spark, [_row("A", "2024-01-01", 0.0, 1)]).where("false")).count() == 5


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_changes_do_not_move_the_base(spark, base):
    changes = _rows(spark, [_row("A", "2024-01-01", 9.0, 1)])
    for changed in (base.put(changes), base.update(changes, "pct_change"), base.delete(changes)):
        changed.collect()
        plan = _plan(changed)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 3 out of 3" in plan


def test_reads_prune_folders_and_push_filters(spark, base):
    plan = _plan(base.between("A", "2024-01-01", "2024-01-02"))
    assert "PartitionFilters: [isnotnull(grp" in plan
    pushed = plan.split("PushedFilters: ")[1]
    assert "EqualTo(symbol,A)" in pushed and "GreaterThanOrEqual(date,2024-01-01)" in pushed


def test_files_do_not_grow_with_symbols(spark):
    rows = spark.range(30000).select(F.concat(F.lit("S"), F.col("id") % 10000).alias("symbol"), F.format_string("2024-01-%02d", F.floor(F.col("id") / 10000) + 1).alias("date"),
                                     *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("long").alias("volume"), F.lit(0.0).alias("pct_change"),
                                     F.lit(1.0).alias("moving_avg_7"), F.lit(False).alias("is_anomaly"), F.lit(False).alias("volume_spike"))
    s = S.create(rows, scratch_path(spark, "test-many"), groups=4, buckets=4)
    new = S.commit(s, s.put(s.symbol("S77").withColumn("seq", F.lit(1).cast("long"))))
    for snap in (s, new):
        assert len(child_dirs(spark, snap.path, "grp=")) <= 4
        assert len(spark.read.parquet(snap.path).inputFiles()) <= 16
    assert new.symbol("S77").count() == 3 and new.frame().count() == 30000


def test_prune_removes_old_versions(spark, base):
    S.commit(base, base.frame())
    assert S.prune(spark, base.root, 1) == [0] and sorted(S.versions(spark, base.root)) == [1]
