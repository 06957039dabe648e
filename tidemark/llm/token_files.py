"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

One file holds the documents of one range of doc_ids, in ascending order:

    ids      all documents' ids, each followed by the end id, uint16 or uint32, little-endian
    offsets  int64 x (n + 1), in ids from the file's start
    doc_ids  int64 x n (the smallest int64 stands for null)
    n        int64
    magic    8 bytes
    end id   once more (the writer's row separator)

so a reader maps the file, reads n from its end and the ids in place. Spark's
text writer makes the files: a row is a document's ids, and the row separator is
the end id. Its commit protocol therefore covers lost executors, and any store
Spark writes to will do. A partition's base is the prefix sum of the files before.

Null texts count as empty and have only the end id. Equal doc_ids keep all their
rows, side by side. An empty table gives no file and no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored, text_slices, worker_cache
from tidemark.llm.pieces import PieceIds

MAGIC = b"TOKENS01"
NULL_ID = -(1 << 63)
END_ID = 2
FILE_BYTES = 32 << 20  # text bytes a file


def _encoder(path: str, dtype: str):
    def run(batches):
        model = worker_cache(f"ids {path} {dtype}", lambda: PieceIds(path, dtype))
        offsets, ids = [0], []
        for batch in batches:
            texts = batch.column(1)
            ids += batch.column(0).fill_null(NULL_ID).to_pylist()
            for start, end in text_slices(texts):
                rows = model.encode(pc.fill_null(texts.slice(start, end - start), "").to_pylist())
                for row in rows:
                    offsets.append(offsets[-1] + len(row) // np.dtype(dtype).itemsize + 1)
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["data"])
        if ids:
            tail = np.array([*offsets, *ids, len(ids)], dtype="<i8").tobytes() + MAGIC
            yield pa.RecordBatch.from_arrays([pa.array([tail], pa.binary())], names=["data"])
    return run


def write_tokens(docs: DataFrame, out: str, tokenizer: str, dtype: str = "<u2", end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as token files under ``out``. ``dtype`` must hold every id; the end id's bytes are below 128."""
    separator = end_id.to_bytes(np.dtype(dtype).itemsize, "little").decode("ascii")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = docs.repartitionByRange(size // FILE_BYTES + 1, "doc_id").sortWithinPartitions("doc_id")
    (ordered.mapInArrow(_encoder(tokenizer, dtype), "data binary").select(F.col("data").cast("string").alias("value"))
     .write.option("lineSep", separator).text(out))


def parse_file(data, dtype: str = "<u2") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, doc_ids) of a file's bytes, without copying the ids."""
    width = np.dtype(dtype).itemsize
    end = len(data) - width
    if bytes(data[end - 8:end]) != MAGIC:
        raise ValueError("not a token file, or a cut one")
    n = int(np.frombuffer(data, "<i8", 1, end - 16)[0])
    numbers = np.frombuffer(data, "<i8", 2 * n + 1, end - 16 - 8 * (2 * n + 1))
    offsets, doc_ids = numbers[:n + 1], numbers[n + 1:]
    return np.frombuffer(data, dtype, int(offsets[-1])), offsets, doc_ids


def open_mapped(path: str, dtype: str = "<u2") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As parse_file, memory-mapped from a mounted path (for training jobs)."""
    return parse_file(np.memmap(path, dtype="uint8", mode="r"), dtype)


def _reader(dtype: str):
    def run(batches):
        release()
        for batch in batches:
            for i in range(batch.num_rows):
                part = int(re.search(r"part-(\d+)", batch.column(0)[i].as_py().rsplit("/", 1)[-1])[1])
                ids, offsets, doc_ids = parse_file(batch.column(1)[i].as_buffer(), dtype)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(np.full(len(crc), part)), pa.array(offsets[:-1]),
                     pa.array(np.diff(offsets)), pa.array(crc, pa.int64())], names=["doc_id", "part", "at", "n_tokens", "ids_crc32"])
    return run


def read_tokens(spark: SparkSession, path: str, dtype: str = "<u2") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all documents before."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    rows = stored(files.mapInArrow(_reader(dtype), "doc_id long, part long, at long, n_tokens long, ids_crc32 long"), "token-rows")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
