"""Timing rollups (FIXTURES F6) and batch assignment."""

from pyspark.sql import functions as F

from tidemark.operators.rollups import batch_summary, latency_summary


def test_latency_summary(spark):
    t = spark.createDataFrame([("put", 10.0), ("put", 20.0), ("put", 30.05), ("del", 5.0)],
                              "op string, elapsed_ms double")
    out = {r.op: r for r in latency_summary(t).collect()}
    p = out["put"]
    assert (p.calls, p.avg_ms, p.min_ms, p.max_ms) == (3, 20.0, 10.0, 30.0)  # 30.05 -> 30.0 half-even
    assert p.throughput == round(1000 / (60.05 / 3), 1)
    assert p.floor_mean_ms == 20
    assert out["del"].throughput == 200.0


def test_batches_of_25_in_order(spark):
    items = spark.range(0, 110).select(F.lit("A").alias("symbol"),
                                       F.format_string("2024-%02d-%02d", F.floor(F.col("id") / 28) + 1,
                                                       F.col("id") % 28 + 1).alias("date"))
    out = sorted(tuple(r) for r in batch_summary(items, ["symbol"], ["date"]).collect())
    assert [r[2] for r in out] == [25, 25, 25, 25, 10]
    assert out[0][3] == "2024-01-01" and out[-1][4] == "2024-04-26"
