"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns the columns of ``documents``; the last returns what the token files
hold. What a stage wrote on its way and its result does not read goes at its end. ``run`` writes each stage's result as Parquet in the shared folder and rereads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, minhash, mixing, token_files
from tidemark.llm.common import fresh, passing, stored, table
from tidemark.session import scratch_path

MIN_SCORE = 0.4  # a clean document of any length scores well above


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; text without letters, or like no language of the labels, goes.

    Rows of a null doc_id, or of one that several rows share, are judged by their text all the same.
    """
    row = fresh(docs, "_row")
    known = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    judged = language.identify(known.select(F.col(row).alias("doc_id"), "text"), language.fit(docs))
    bad = judged.where((F.col("lang_pred") == language.UNKNOWN) | (F.col("score") < MIN_SCORE)).select(F.col("doc_id").alias(row)).distinct()
    return known.join(stored(bad, "rejected"), row, "left_anti").select(*docs.columns)


def _placed(docs: DataFrame, row: str, place: str) -> DataFrame | None:
    """``docs`` with a number of each row, and its place in the order of files and rows, if they come from files that tell these."""
    if "_metadata" in docs.columns:
        return None
    try:
        path, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        placed = docs.withColumns({row: F.xxhash64(path, index), place: F.struct(path, index)})
    except AnalysisException:
        return None
    return None if placed.groupBy(row).count().where("count > 1").head(1) else placed


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str, str]:
    """``docs`` with a number of its own for each row, and a place that settles ties: decisions go by rows, as ids may be null or shared.

    Rows of Parquet files are told by their place in these, so nothing is copied. Others, and numbers that come twice, make a copy with numbers.
    """
    row, place = fresh(docs, "_row"), fresh(docs, "_place")
    rows = _placed(docs, row, place)
    if rows is None:
        rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), name, compression="zstd").withColumn(place, F.col(row))
    return rows, row, place


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id (without an id: last)."""
    rows, row, place = _numbered(docs, "to-dedup")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(place), F.col(row))
    with passing(spark):
        classes = minhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "class_id")
        stays = rows.select(row, "doc_id", place).join(classes, row).groupBy("class_id").agg(F.min(order)[row].alias(row)).select(row)
        stays = stored(stays, "unique", keep=True)
    # the same join at every size: the rows that stay are a share of the corpus, so no broadcast
    return rows.join(stays.hint("merge"), row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none, one or two rows."""
    rows, row, _ = _numbered(docs, "to-mix")
    copies, copy = fresh(docs, "_copies"), fresh(docs, "_copy")
    with passing(spark):
        taken = mixing.mix(rows, keep=(row,)).where("copies > 0").select(row, F.col("copies").alias(copies))
        taken = stored(taken, "copies", keep=True)
    return (rows.join(taken.hint("merge"), row)  # as in near_dedup
            .withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, and what they hold: doc_id, start, n_tokens, ids_crc32."""
    out = scratch_path(spark, "corpus-tokens")
    token_files.write_tokens(docs, out, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, out)


STAGES = [("language_id", language_id), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination),
          ("source_mixing", source_mixing), ("token_output", token_output)]

ORACLE_SQL = None  # the network, the sketches and the tokenizer have no SQL form; tests/llm/test_pipeline.py holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
