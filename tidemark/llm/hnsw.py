"""Approximate nearest neighbours: a navigable small-world hierarchy per shard.

Vectors are dealt to shards of about ``SHARD`` by a hash of their id. A shard's
graph is built in one task and stored as flat arrays: the vectors, and for each
layer an n x M table of neighbour numbers (-1: none). Queries, in blocks, are
searched in every shard, and the shards' results are merged by exact distance.

Insertion and search run many points in step: a beam of the best found so far
per point, each step opening its nearest unopened entry. New points are linked in
batches to what the layer holds and to their batch, by the usual rule: of the
nearest candidates keep one that is nearer to the point than to any kept before.

Equal vectors are indexed once, with the K + 1 smallest ids that hold them, which
is all that a result of K can show. Null, empty, all-zero vectors, those of
another length than most, and those with null or non-finite components take no
part. Rows of one vec_id are one query and one candidate, at the least distance
between any of them. Fewer candidates than K give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import group_bounds, map_groups, stored

K = 10
SHARD = 2048
LINKS = 16  # a point's links in upper layers; twice as many in the lowest
WIDTH_BUILD = 64
WIDTH_SEARCH = 128
BATCH = 128
QUERY_BLOCK = 512


def _distances(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of queries (b, d) to points (b, m, d)."""
    gap = points - queries[:, None, :]
    return np.einsum("bmd,bmd->bm", gap, gap)


def beam_search(vectors: np.ndarray, links: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int):
    """Best ``width`` of a layer per query: (numbers, squared distances), nearest first, -1 and inf where fewer."""
    b = len(queries)
    rows = np.arange(b)
    seen = np.zeros((b, len(vectors)), dtype=bool)
    found = np.full((b, width), -1, dtype="int64")
    far = np.full((b, width), np.inf, dtype="float32")
    opened = np.zeros((b, width), dtype=bool)
    found[:, 0] = entries
    far[:, 0] = _distances(vectors[entries][:, None, :], queries)[:, 0]
    seen[rows, entries] = True
    while True:
        waiting = np.where(opened | (found < 0), np.inf, far)
        at = waiting.argmin(axis=1)
        live = np.flatnonzero(np.isfinite(waiting[rows, at]))
        if not len(live):
            return found, far
        at = at[live]
        opened[live, at] = True
        next_ = links[found[live, at]]
        ok = (next_ >= 0) & ~seen[live[:, None], next_]
        new = np.where(ok, next_, 0)
        gap = np.where(ok, _distances(vectors[new], queries[live]), np.inf).astype("float32")
        r, c = np.nonzero(ok)
        seen[live[r], new[r, c]] = True
        numbers = np.concatenate([found[live], np.where(ok, new, -1)], axis=1)
        gaps = np.concatenate([far[live], gap], axis=1)
        done = np.concatenate([opened[live], np.zeros_like(ok)], axis=1)
        best = np.argsort(gaps, axis=1, kind="stable")[:, :width]
        found[live], far[live] = np.take_along_axis(numbers, best, 1), np.take_along_axis(gaps, best, 1)
        opened[live] = np.take_along_axis(done, best, 1)


def choose(vectors: np.ndarray, candidates: np.ndarray, gaps: np.ndarray, most: int) -> np.ndarray:
    """Links of each row: of its candidates, nearest first, those nearer to it than to any chosen; then the nearest others."""
    order = np.argsort(gaps, axis=1, kind="stable")
    candidates, gaps = np.take_along_axis(candidates, order, 1), np.take_along_axis(gaps, order, 1)
    b, m = candidates.shape
    points = vectors[np.maximum(candidates, 0)]
    norms = np.einsum("bmd,bmd->bm", points, points)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
    real = np.isfinite(gaps)
    kept = np.zeros((b, m), dtype=bool)
    for j in range(m):
        near = (np.where(kept, between[:, j, :], np.inf) < gaps[:, j, None]).any(axis=1)
        kept[:, j] = real[:, j] & ~near & (kept.sum(axis=1) < most)
    rank = np.argsort(np.where(kept, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(real, rank, 1), np.take_along_axis(candidates, rank, 1), -1)
    return out if out.shape[1] == most else np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _link(vectors, links, new, candidates, gaps):
    """Give new points their links in one layer, and link back; a full list is chosen anew."""
    most = links.shape[1]
    links[new] = choose(vectors, candidates, gaps, most)
    sources = np.repeat(new, most)
    ends = links[new].ravel()
    sources, ends = sources[ends >= 0], ends[ends >= 0]
    order = np.argsort(ends, kind="stable")
    sources, ends = sources[order], ends[order]
    starts = np.flatnonzero(np.diff(ends, prepend=-1))
    touched = ends[starts]
    counts = np.diff([*starts, len(ends)])
    extra = np.full((len(touched), int(counts.max(initial=0))), -1, dtype="int64")
    extra[np.repeat(np.arange(len(touched)), counts), np.arange(len(ends)) - np.repeat(starts, counts)] = sources
    both = np.concatenate([links[touched], extra], axis=1)
    both[:, most:][(both[:, most:, None] == both[:, None, :most]).any(axis=2)] = -1
    gap = np.where(both >= 0, _distances(vectors[np.maximum(both, 0)], vectors[touched]), np.inf)
    links[touched] = choose(vectors, both, gap, most)


def build(vectors: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Layers of a graph, lowest first: flat neighbour tables (n, links)."""
    n = len(vectors)
    tops = np.minimum(np.floor(-np.log(1 - np.random.Generator(np.random.PCG64(seed)).random(n)) / np.log(LINKS)), 6).astype(int)
    tops[0] = tops.max(initial=0)
    layers = [np.full((n, LINKS * 2 if l == 0 else LINKS), -1, dtype="int32") for l in range(tops[0] + 1)]
    start, size = 1, 1
    while start < n:
        size = min(BATCH, start, n - start)  # a batch is no larger than what is there
        batch = np.arange(start, start + size)
        entries = np.zeros(size, dtype="int64")
        for level in range(tops[0], -1, -1):
            found, far = beam_search(vectors, layers[level], entries, vectors[batch], WIDTH_BUILD if (tops[batch] >= level).any() else 1)
            entries = found[:, 0].copy()
            own = np.flatnonzero(tops[batch] >= level)
            if not len(own):
                continue
            mates = np.broadcast_to(batch[own], (len(own), len(own)))
            gap = _distances(vectors[mates], vectors[batch[own]])
            np.fill_diagonal(gap, np.inf)
            near = np.argsort(gap, axis=1)[:, :LINKS]
            _link(vectors, layers[level], batch[own], np.concatenate([found[own], np.take_along_axis(mates, near, 1)], axis=1),
                  np.concatenate([far[own], np.take_along_axis(gap, near, 1)], axis=1))
        start += size
    return layers


def search(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, k: int, width: int = WIDTH_SEARCH) -> np.ndarray:
    entries = np.zeros(len(queries), dtype="int64")
    for layer in layers[:0:-1]:
        entries = beam_search(vectors, layer, entries, queries, 4)[0][:, 0]
    return beam_search(vectors, layers[0], entries, queries, max(width, k))[0][:, :k]


# --- on Spark ---------------------------------------------------------------

def _build_shards(table: pa.Table):
    shard = table.column("shard").to_numpy()
    bounds = group_bounds([shard])
    for lo, hi in zip(bounds, bounds[1:]):
        part = table.slice(lo, hi - lo)
        vectors = _matrix(part.column("vector"))
        layers = build(vectors.astype("float32"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(shard[lo])]), pa.array([part.column("rep").to_numpy().astype("<i8").tobytes()], pa.binary()),
             pa.array([vectors.astype("<f8").tobytes()], pa.binary()), pa.array([[x.astype("<i4").tobytes() for x in layers]], pa.list_(pa.binary()))],
            names=["shard", "reps", "vectors", "layers"])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype("float64")


def _search_shards(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reps, ids = np.frombuffer(row["reps"], "<i8"), np.frombuffer(row["queries"], "<i8")
                vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(reps), -1)
                queries = np.frombuffer(row["points"], "<f8").reshape(len(ids), -1)
                layers = [np.frombuffer(x, "<i4").reshape(len(reps), -1) for x in row["layers"]]
                found = search(vectors.astype("float32"), layers, queries.astype("float32"), k + 1)
                at, col = np.nonzero(found >= 0)
                hit = found[at, col]
                score = np.sqrt(((vectors[hit] - queries[at]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(reps[hit]), pa.array(score)], names=["query_id", "rep", "score"])
    return run


def _query_blocks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, QUERY_BLOCK):
            part = batch.slice(start, QUERY_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                 pa.array([_matrix(part.column(1)).astype("<f8").tobytes()], pa.binary())], names=["queries", "points"])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector: array<double>) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()  # a row a length
    return rows.where(F.size("vector") == (common[0]["n"] if common else 0))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``."""
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    # distinct vectors with their k + 1 smallest ids; salted, so that no list holds a hot vector's ids
    smallest = lambda ids: F.slice(F.sort_array(ids), 1, k + 1)
    salted = rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(1009)).alias("salt")).agg(smallest(F.collect_set("vec_id")).alias("ids"))
    distinct = stored(salted.groupBy("vector").agg(smallest(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids")).withColumn("rep", F.col("ids")[0]), "distinct")
    count = distinct.count()
    shards = max(1, -(-count // SHARD))
    dealt = distinct.select(F.pmod(F.xxhash64("rep"), F.lit(shards)).alias("shard"), "rep", "vector")
    graphs = stored(map_groups(dealt, ["shard"], _build_shards, "shard long, reps binary, vectors binary, layers array<binary>", ["rep"]), "graphs")
    # every block of queries meets every shard
    blocks = rows.where(F.col("vec_id") % every == 0).mapInArrow(_query_blocks, "queries binary, points binary")
    pairs = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), "queries", "points").join(graphs, "shard")
    hits = pairs.select("reps", "vectors", "layers", "queries", "points").mapInArrow(_search_shards(k), "query_id long, rep long, score double")
    # several rows of one id are one query and one candidate: the nearest of them counts
    found = hits.groupBy("query_id", "rep").agg(F.min("score").alias("score"))
    spread = (found.join(distinct.select("rep", "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
              .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return spread.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
