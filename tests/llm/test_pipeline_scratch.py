"""Stages of the pipeline leave only the scratch folders that their result reads."""

import os
import uuid
from urllib.parse import urlparse

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tidemark.llm import common
from tidemark.llm.common import passing, stored


@pytest.fixture(autouse=True)
def own_folder(tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    return str(tmp_path)


def _folders(top):
    return {f"{top}/{d}" for d in os.listdir(top)}


def _read(df):
    return {os.path.dirname(urlparse(f).path) for f in df.inputFiles()}


def test_passing_keeps_what_it_is_told_to(spark, own_folder):
    before = _folders(own_folder)
    with passing(spark):
        passed = stored(spark.range(5), "t-passed")
        kept = stored(passed.where("id > 2"), "t-kept", keep=True)
    assert _folders(own_folder) - before == _read(kept) and kept.count() == 2
    assert stored(spark.range(3), "t-after").count() == 3


def test_stages_leave_what_their_results_read(spark, own_folder):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("the river walks over the green bread "), F.col("id") % 30).alias("text"),
                                  F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    docs = stored(docs, "t-docs")
    stage = dict(corpus_pipeline.STAGES)
    for name in ("minhash_near_dedup", "source_mixing"):
        before = _folders(own_folder)
        out = stage[name](spark, docs, "")
        assert _folders(own_folder) - before == _read(out) - _read(docs) and len(_read(out)) == 2, name
        assert out.count() > 0 and out.columns == docs.columns


def test_stages_copy_no_texts(spark, own_folder):
    """Rows of stored tables are told by their place in the files; frames that repeat rows, or have no files, still have one number a row."""
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("the stone walks under the bread "), F.col("id") % 10).alias("text"),
                                  F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"))
    docs = stored(rows, "t-docs")
    stage = dict(corpus_pipeline.STAGES)
    kept = {}
    for name in ("minhash_near_dedup", "source_mixing"):
        before = _folders(own_folder)
        out = stage[name](spark, docs, "")
        kept[name] = sorted(map(tuple, out.collect()))
        assert not [f for f in _folders(own_folder) - before if "text" in spark.read.parquet(f).columns], name
        assert sorted(map(tuple, stage[name](spark, rows, "").collect())) == kept[name]
    twice = docs.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    for df in (docs.unionAll(docs).withColumn("n", F.lit(1)), twice):
        numbered, row, _ = corpus_pipeline._numbered(df, "t-rows")
        assert numbered.select(row).distinct().count() == 80
        assert sorted(r[0] for r in stage["minhash_near_dedup"](spark, df, "").collect()) == [r[0] for r in kept["minhash_near_dedup"]]
