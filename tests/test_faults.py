"""Rows and values that must survive: each case was once lost or changed without an error."""

import random

from pyspark.sql import functions as F

from tidemark.operators import analysis as A
from tidemark.operators import keyed as K
from tidemark.operators import profile as P
from tidemark.operators import rollups as R
from tidemark.operators.indicators import enrich, enrich_bars, enrich_by_symbol, reject_bars
from tidemark.session import scratch_path
from tidemark.sources import bar_files as BF
from tidemark.sources import keyed_store as KS

BARS = "symbol string, date string, open double, high double, low double, close double, volume long"


def test_text_files_keep_every_magnitude(spark):
    closes = [0.0005, 5.0, 9999999.0, 1e7, 12345678.5, 0.1, 123.456]
    bars = spark.createDataFrame([("A", f"2024-01-{i + 1:02d}", c, c, c, c, 1) for i, c in enumerate(closes)], BARS)
    path = BF.write_bar_files(bars, scratch_path(spark, "t-text"))
    got = BF.clean_bars(BF.scan_bar_files(spark, path)).orderBy("date").collect()
    assert [r.close for r in got] == closes


def test_numeric_symbols_stay_text(spark):
    bars = spark.createDataFrame([(s, "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1) for s in ("0700", "005930")], BARS)
    root = scratch_path(spark, "t-store")
    KS.write_version(enrich_bars(bars), root, 0)
    assert sorted(r.symbol for r in KS.read_version(spark, root).collect()) == ["005930", "0700"]
    assert sorted(r.symbol for r in KS.read_sink(spark, root).collect()) == ["005930", "0700"]


def test_enriched_and_rejects_are_all_bars(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("A", "d1", 1.0, 1.0, 1.0, 1.0, 1), ("A", "d2", 0.0, 1.0, 1.0, 1.0, 1), ("A", "d3", nan, 1.0, 1.0, 1.0, 1), ("A", "d4", 1.0, inf, 1.0, 1.0, 1),
            (None, "d5", 1.0, 1.0, 1.0, 1.0, 1), ("A", None, 1.0, 1.0, 1.0, 1.0, 1), ("A", "d7", 1.0, None, 1.0, 1.0, 1), ("A", "d8", 1.0, 1.0, 1.0, 1.0, None)]
    bars = spark.createDataFrame(rows, BARS)
    rejects = {(r.symbol, r.date): r.reason for r in reject_bars(bars).collect()}
    assert enrich_bars(bars).count() + len(rejects) == len(rows)
    assert rejects == {("A", "d2"): "zero_open", ("A", "d3"): "bad_number", ("A", "d4"): "bad_number", (None, "d5"): "missing_symbol",
                       ("A", None): "missing_date", ("A", "d7"): "missing_field", ("A", "d8"): "missing_field"}


def test_positions_keep_null_keys(spark):
    df = spark.createDataFrame([("A", "2024-01-01", 1.0), (None, "2024-01-01", 2.0), ("A", None, 3.0), (None, None, 4.0)], "symbol string, date string, close double")
    got = A.sort_symbol_date(df).collect()
    assert sorted(r.pos for r in got) == [1, 2, 3, 4]
    assert R.batch_assign(df, ["symbol"], ["date"]).count() == 4


def test_prefix_delete_keeps_null_dates(spark):
    df = spark.createDataFrame([("A", "BENCH-1"), ("A", None), ("B", "x")], "symbol string, date string")
    assert sorted(str(r.date) for r in K.delete_by_prefix(df, "BENCH-").collect()) == ["None", "x"]


def test_latest_change_ignores_null_seq_and_never_mixes_records(spark):
    rows = [("A", "d", i, -i, 7) for i in range(50)] + [("A", "d", 99, 99, None), ("B", "d", None, 1, 3), ("B", "d", 5, 5, 2)]
    got = {r.symbol: r for r in K.latest_per_key(spark.createDataFrame(rows, "symbol string, date string, a long, b long, seq long")).collect()}
    assert got["A"].a == -got["A"].b and got["A"].seq == 7
    assert (got["B"].a, got["B"].b) == (None, 1)


def test_profile_keeps_full_precision(spark):
    df = spark.createDataFrame([("A", 1.0000014, 2e-7, 1e15), ("A", 1.0000004, 3e-7, 2.5)], "symbol string, x double, y double, z double")
    r = P.profile_wide(df, "symbol", "symbol").filter("is_total = 0").first()
    assert abs(r["mean__x"] - 1.0000009) < 1e-15 and abs(r["mean__y"] - 2.5e-7) < 1e-20 and r["stddev__y"] > 0
    assert abs(r["mean__z"] - (1e15 + 2.5) / 2) < 1
    empty = P.profile_wide(df.limit(0), "symbol", "symbol").filter("is_total = 1").first()
    assert (empty.row_count, empty.total_nulls, empty["nulls__x"], empty["count__x"]) == (0, 0, 0, 0)


def test_zero_latency_does_not_stop_the_summary(spark):
    t = spark.createDataFrame([("a", 0.0, 1), ("b", 2.0, 2), (None, 4.0, 3)], "op string, elapsed_ms double, n long")
    got = {r.op: r for r in R.latency_summary(t).collect()}
    assert got["a"].throughput is None and got["b"].throughput == 500.0 and None in got
    out = {r.op: r.records_per_sec for r in R.batch_throughput(t, ["n"]).collect()}
    assert out["a"] is None and out["b"] == 500.0 and None in out
    assert R.floored_mean(R.latency_summary(t), "avg_ms").first()[0] == 2


def test_bucket_width_does_not_change_a_value(spark):
    rng = random.Random(9)
    rows = [(s, f"20{10 + i // 360:02d}-{i // 30 % 12 + 1:02d}-{i % 30 + 1:02d}", *(rng.uniform(0.01, 300) for _ in range(4)), rng.randint(0, 9)) for s in "AB" for i in range(1500)]
    bars = spark.createDataFrame(rows, BARS)
    want = sorted(map(tuple, enrich_by_symbol(bars).collect()))
    for chars in (4, 7, 10):
        assert sorted(map(tuple, enrich(bars, chars).collect())) == want
    short = bars.withColumn("close", F.round("close", 3))
    assert sorted(map(tuple, enrich(short, 7).collect())) == sorted(map(tuple, enrich_by_symbol(short).collect()))
