"""The registered queries of the corpus operators, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, codes, decontaminate, hnsw, language, licenses, minhash, mixing, token_counts, token_files, toxicity, trie, warc
from tidemark.llm.common import table
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


@query("op1_minhash_near_dedup")
def op1(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_benchmark_decontamination", decontaminate.ORACLE)
def op5(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_token_files")
def op9(spark, sf_dir):
    out = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, out)


@query("op10_token_counts")
def op10(spark, sf_dir):
    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    n = token_counts.total(F.col("counts"))
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > 2048).alias("over_limit"))


@query("op4_source_mixing", mixing.ORACLE)
def op4(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_hnsw_search")
def op8(spark, sf_dir):
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


@query("op6_warc_conversion", warc.ORACLE)
def op6(spark, sf_dir):
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, out)
    return warc.read_warc(spark, out)


@query("op7_language_id")
def op7(spark, sf_dir):
    return language.predictions(table(spark, sf_dir, "documents"))


@query("op2_chat_formatting")
def op2(spark, sf_dir):
    return chat.recovered_turns(table(spark, sf_dir, "conversations"))


@query("op3_license_scan", licenses.ORACLE)
def op3(spark, sf_dir):
    return licenses.scan(licenses.document_paths(table(spark, sf_dir, "documents")))


@query("op12_prefix_trie", trie.ORACLE)
def op12(spark, sf_dir):
    return trie.trie(table(spark, sf_dir, "conversations"))


@query("op11_vector_codes", codes.ORACLE)
def op11(spark, sf_dir):
    return codes.digest(codes.compress(table(spark, sf_dir, "embeddings")))


@query("op13_toxicity")
def op13(spark, sf_dir):
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
