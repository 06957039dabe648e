"""Exact token counts at every prefix of a text, by dynamic programming over its pieces.

tokens(first j pieces) = tokens(first j - 1 pieces) + tokens(piece j): the
vocabulary drops white space, so a blank or line break is always a boundary and
the sum is the library's own count. ``prefix_counts`` stores the sums; counts,
cuts and budgets are then look-ups in them, without encoding again.

``grain="piece"`` stores the prefixes that end at a boundary, ``grain="char"``
those at every character. Null counts as empty: no prefixes and no tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, worker_cache
from tidemark.llm.pieces import PieceCounts


def _char_prefixes(model: PieceCounts, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every character prefix: the tokens of the pieces before, and of the part of the last piece."""
    parts = [p[:i] for p in pieces for i in range(1, len(p) + 1)]
    model.learn(set(parts))
    counts, done = [], 0
    for p in pieces:
        counts += [done + model.kept[p[:i]] for i in range(1, len(p) + 1)]
        done += model.kept[p]
        counts.append(done)  # the blank behind it
    return np.arange(1, len(counts)), np.array(counts[:-1], dtype="int64")


def _counter(path: str, grain: str) -> Callable:
    def run(batches):
        model = worker_cache(f"counts {path}", lambda: PieceCounts(path))
        for batch in batches:
            texts = batch.column(1)
            for start, end in text_slices(texts):
                split = [t.replace("\n", " ").split(" ") for t in pc.fill_null(texts.slice(start, end - start), "").to_pylist()]
                seen: set[str] = set()
                seen.update(*split)
                model.learn(seen)
                sizes, ends, counts = [0], [], []
                for pieces in split:
                    if pieces == [""]:
                        at = n = np.empty(0, dtype="int64")
                    elif grain == "char":
                        at, n = _char_prefixes(model, pieces)
                    else:
                        at = np.cumsum(np.fromiter(map(len, pieces), "int64", len(pieces)) + 1) - 1
                        n = np.cumsum(np.fromiter(map(model.kept.__getitem__, pieces), "int64", len(pieces)))
                    ends.append(at), counts.append(n), sizes.append(sizes[-1] + len(at))
                columns = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(x).astype("int32"))) for x in (ends, counts)]
                n_bytes = pc.fill_null(pc.binary_length(texts.slice(start, end - start)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), n_bytes, *columns],
                                                 names=["doc_id", "n_bytes", "ends", "counts"])
    return run


def prefix_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", grain: str = "piece") -> DataFrame:
    """(doc_id, n_bytes, ends, counts): counts[i] tokens in the first ends[i] characters, a row per input row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_counter(tokenizer, grain), "doc_id long, n_bytes long, ends array<int>, counts array<int>")


def total(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.try_element_at(counts, F.lit(-1)), F.lit(0)).cast("long")


def cut_at(ends: Column, counts: Column, budget: int) -> Column:
    """Characters of the longest stored prefix of at most ``budget`` tokens (0: none)."""
    fitting = F.filter(F.zip_with(ends, counts, lambda e, c: F.when(c <= budget, e)), lambda e: e.isNotNull())
    return F.coalesce(F.array_max(fitting), F.lit(0))
