"""The message log: dense numbers, appends, offsets that depend on no file time, bounded micro-batches, restarts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.indicators import enrich_bars
from tidemark.operators.validate import classify, valid_part
from tidemark.session import scratch_path
from tidemark.sources import message_log as ML
from tidemark.sources import messages as MSG
from tidemark.sources.bars import bars
from tidemark.streaming.enrich_state import stream_enrich

from paths import SF_SMOKE


def _messages(spark, lo, hi):
    return spark.range(lo, hi).select(F.format_string("%05d", "id").alias("at"), F.col("id").cast("string").alias("value"))


def _read(spark, root, out, ckpt, rows=None):
    ML.drain(ML.stream(spark, root, rows, ckpt if rows else None).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt))
    return [(r["seq"], r["value"]) for r in spark.read.schema("seq bigint, value string").parquet(out).orderBy("seq").collect()]


def _ends(ckpt):
    return [json.loads(open(f"{ckpt}/offsets/{n}").read().splitlines()[-1])["seq"]
            for n in sorted(int(f) for f in os.listdir(f"{ckpt}/offsets") if f.isdigit())]


def test_appends_are_numbered_densely_and_in_order(spark):
    root = scratch_path(spark, "log")
    assert ML.end(spark, root) == 0
    assert ML.append(_messages(spark, 0, 1000).repartition(9), root, ["at"], 5) == (0, 1000)
    assert ML.append(_messages(spark, 1000, 1300).repartition(4), root, ["at"], 3) == (1000, 1300)
    assert ML.append(_messages(spark, 0, 0), root, ["at"]) == (1300, 1300)
    out, ckpt = scratch_path(spark, "log-out"), scratch_path(spark, "log-ckpt")
    assert _read(spark, root, out, ckpt) == [(i, str(i)) for i in range(1300)]


def test_order_does_not_depend_on_file_times(spark):
    root = scratch_path(spark, "log")
    ML.append(_messages(spark, 0, 500).repartition(7), root, ["at"], 6)
    for folder, _, files in os.walk(root):
        for f in files:
            os.utime(f"{folder}/{f}", (random.randint(1, 10 ** 9),) * 2)
    out, ckpt = scratch_path(spark, "log-out"), scratch_path(spark, "log-ckpt")
    assert _read(spark, root, out, ckpt, 90) == [(i, str(i)) for i in range(500)]
    assert _ends(ckpt) == [90, 180, 270, 360, 450, 500]


def test_a_restart_goes_on_where_it_stood_in_the_same_steps(spark):
    root, out, ckpt = (scratch_path(spark, n) for n in ("log", "log-out", "log-ckpt"))
    ML.append(_messages(spark, 0, 130), root, ["at"], 2)
    _read(spark, root, out, ckpt, 50)
    ML.append(_messages(spark, 130, 300), root, ["at"], 2)
    assert _read(spark, root, out, ckpt, 50) == [(i, str(i)) for i in range(300)]
    assert _ends(ckpt) == [50, 100, 130, 180, 230, 280, 300]
    with pytest.raises(ValueError):
        ML.stream(spark, root, 50)


def test_an_append_that_died_does_not_count(spark):
    root = scratch_path(spark, "log")
    ML.append(_messages(spark, 0, 10), root, ["at"], 2)
    _messages(spark, 10, 15).select(F.lit(10).cast("long").alias("seq"), "value").write.parquet(f"{root}/rows={10:020d}")  # rows, no index
    out, ckpt = scratch_path(spark, "log-out"), scratch_path(spark, "log-ckpt")
    assert len(_read(spark, root, out, ckpt)) == 10
    ML.append(_messages(spark, 10, 20), root, ["at"], 2)
    assert _read(spark, root, out, ckpt) == [(i, str(i)) for i in range(20)]


def test_enrichment_over_the_log_equals_batch(spark):
    b = bars(spark, SF_SMOKE)
    raw = b.select(F.col("date").alias("Date"), *[F.col(c.lower()).alias(c) for c in ("Open", "High", "Low", "Close", "Volume")], "symbol")
    msgs = MSG.encode(raw).select("value", F.get_json_object("value", "$.Date").alias("at"))
    root, out, ckpt = (scratch_path(spark, n) for n in ("log", "log-out", "log-ckpt"))
    ML.append(msgs, root, ["at"], 4)
    valid = valid_part(classify(ML.stream(spark, root, 300, ckpt)), ["seq"])
    ML.drain(stream_enrich(valid).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).outputMode("append"))
    assert len(_ends(ckpt)) > 2
    assert sorted(map(tuple, spark.read.parquet(out).drop("seq", "late").collect())) == sorted(map(tuple, enrich_bars(b).collect()))
