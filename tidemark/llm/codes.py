"""Vector codes: product quantisation whose assignments keep adaptive distance bounds.

Components become integers, floor(SCALE * x). A vector is cut into ``PARTS``
equal parts; each part position has a codebook of ``ENTRIES`` entries, which
starts as that part of the vectors of smallest ids and is refined by ``ROUNDS``
of k-means on integers. All sums and the distances that decide are exact.

Between rounds each part keeps its b closest entries in order with a lower
bound on the distance to each, and one outer bound for all other entries (Drake
and Hamerly). An entry's bound falls by what the entry moved, the outer one by the
most that an entry outside moved. A part whose assigned entry is nearer than every
bound stays; if it is nearer than all behind place j, only j entries are compared,
by their integer distances; else all are. Bounds are kept rounded down, and a
comparison nearer than ``SLACK`` counts as uncertain and is settled by integers.
After each round b becomes the fewest entries that spare all but ``MISSED`` of the
parts the full comparison, at least ``ENTRIES // 8``; it starts at ``ENTRIES // 4``.
Bounds change the work only, never a code.

The table is read once: rounds rewrite the rows with their codes and bounds, and the
folder of a round is removed once the next is written. The driver sees the codebooks
and their sums: PARTS x ENTRIES rows whatever the table's size.

Defined results: rows whose vector is null, or holds null or non-finite
components, are dropped, as are those whose length is not the most frequent
one among the multiples of PARTS (of equal frequency, the smaller). Zero vectors count. Among
equal ids the smaller vector comes first; a null id comes last and still gets
its code. Repeated rows count as often as they stand there. Fewer rows than
ENTRIES give as many entries. Components too large for 64-bit distances are
computed in unbounded integers; an error that a long can't hold is null. An
empty table gives no rows. Columns besides the three are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored
from tidemark.session import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
SLACK = 1e-9
MISSED = 0.02
SLICE = 1024
SAFE = 1 << 24  # squares of differences of components below it, summed over up to 4,096 of them, fit 62 bits
LIMB = 30
LARGEST = float(np.finfo("float32").max)
HUGE = 1 << 1000


@dataclass
class Codes:
    """``rows``: vec_id, label, code, error; ``codebooks``: parts x entries x components, in integers."""

    rows: DataFrame
    codebooks: list[list[list[int]]]

    def sha256(self) -> str:
        """Digest of all components, decimal and comma-joined, by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for part in self.codebooks for entry in part for x in entry).encode()).hexdigest()


# --- one batch of parts ------------------------------------------------------------

def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): int64, or Python integers where one is not below SAFE."""
    if not values.size or np.abs(values).max() < SAFE / scale - 1 and values.shape[1] <= 4096:
        return np.floor(values * scale).astype("int64")
    whole = lambda x: int(x) * scale if abs(x) >= 2.0 ** 52 else math.floor(x * scale)
    return np.array([whole(float(x)) for x in values.ravel()], dtype=object).reshape(values.shape)


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of points (n, d) to entries (m, d) or (n, m, d)."""
    gap = points[:, None, :] - (entries if entries.ndim == 3 else entries[None])
    return (gap * gap).sum(axis=2)


def _under(squared: np.ndarray) -> np.ndarray:
    """Square roots rounded down."""
    if squared.dtype != object:
        return np.sqrt(squared.astype("float64")) * (1 - SLACK)
    return np.array([min(math.isqrt(int(x)), HUGE) * (1 - SLACK) for x in squared.ravel()], dtype="float64").reshape(squared.shape)


def _over(squared: np.ndarray) -> np.ndarray:
    """Square roots rounded up."""
    if squared.dtype != object:
        return np.sqrt(squared.astype("float64")) * (1 + SLACK) + SLACK
    roots = [math.isqrt(int(x)) + 1 for x in squared.ravel()]
    return np.array([float(r) * (1 + SLACK) if r < HUGE else math.inf for r in roots], dtype="float64").reshape(squared.shape)


def _down(bounds: np.ndarray) -> np.ndarray:
    """As float32, never above the value."""
    return np.nextafter(np.clip(bounds, -LARGEST, LARGEST).astype("float32"), np.float32(-np.inf))


def closest(points: np.ndarray, entries: np.ndarray, keep: int):
    """All distances: the ``keep`` nearest entries in order (ties to the lower index), their bounds and the outer bound."""
    d = squares(points, entries)
    order = np.argsort(d, axis=1, kind="stable")
    far = _under(np.take_along_axis(d, order, 1))
    outer = far[:, keep] if keep < len(entries) else np.full(len(points), LARGEST)
    return order[:, :keep], far[:, :keep], outer


def refresh(points: np.ndarray, entries: np.ndarray, moved: np.ndarray, order: np.ndarray, bounds: np.ndarray, outer: np.ndarray, keep: int):
    """Assignments after the entries moved: (order, bounds, outer, compared); ``compared``: entries looked at per point.

    ``order`` (n, b): entries, the assigned first, -1 where a list is shorter; ``bounds`` (n, b), ``outer`` (n): lower bounds
    before the move.
    """
    n, b = order.shape
    listed = order >= 0
    at = np.where(listed, order, 0)
    inside = np.zeros((n, len(entries)), dtype=bool)
    rows = np.arange(n)[:, None]
    inside[np.broadcast_to(rows, at.shape)[listed], at[listed]] = True
    drift = np.where(inside, 0.0, moved[None]).max(axis=1)
    outer = outer - np.where(inside.all(axis=1), 0.0, drift)
    bounds = np.where(listed, bounds - moved[at], np.inf)
    # the least bound from each place on: everything at or behind place j is at least this far
    behind = np.minimum.accumulate(np.concatenate([bounds, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    own = squares(points, entries[at[:, :1]])[:, 0]
    clear = behind[:, 1:] > _over(own)[:, None]  # place j + 1 on
    sure = clear.any(axis=1)
    need = np.where(sure, clear.argmax(axis=1) + 1, len(entries))
    bounds[:, 0] = _under(own)
    for j in range(2, b + 1):  # the nearest is among the first j: their integer distances settle it
        pick = np.flatnonzero(sure & (need == j))
        if len(pick):
            some = at[pick, :j]
            # an entry's index breaks ties, so the candidates are compared in index order
            by_index = np.sort(np.where(listed[pick, :j], some, len(entries)), axis=1)
            real = by_index < len(entries)
            safe = np.where(real, by_index, 0)
            d = squares(points[pick], entries[safe])
            far = np.where(real, _under(d), np.inf)
            rank = np.argsort(np.where(real, d, d.max() + 1 if len(d) else 0), axis=1, kind="stable")
            order[pick, :j] = np.where(np.take_along_axis(real, rank, 1), np.take_along_axis(safe, rank, 1), -1)
            bounds[pick, :j] = np.take_along_axis(far, rank, 1)
    if keep < b:
        outer = np.minimum(outer, bounds[:, keep:].min(axis=1))
        order, bounds = order[:, :keep], bounds[:, :keep]
    elif keep > b:
        order = np.pad(order, ((0, 0), (0, keep - b)), constant_values=-1)
        bounds = np.pad(bounds, ((0, 0), (0, keep - b)), constant_values=np.inf)
    pick = np.flatnonzero(~sure)
    if len(pick):
        order, bounds, outer = order.copy(), bounds.copy(), outer.copy()
        order[pick], bounds[pick], outer[pick] = closest(points[pick], entries, keep)
    return order, bounds, outer, need


# --- on Spark ------------------------------------------------------------------------

_STATE = "vec_id long, label string, vector binary, wide string, places binary, bounds binary, compared array<int>"


def _packed(points: np.ndarray) -> list[pa.Array]:
    """Integer vectors as 32-bit values; as decimal text in the second column where they may be larger."""
    if points.dtype != object:
        return [pa.array([x.tobytes() for x in points.astype("<i4")], pa.binary()), pa.nulls(len(points), pa.string())]
    return [pa.nulls(len(points), pa.binary()), pa.array([",".join(map(str, x)) for x in points], pa.string())]


def _points(vectors, wide) -> np.ndarray:
    vectors, wide = vectors.to_pylist(), wide.to_pylist()
    if not any(w is not None for w in wide):
        return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), -1).astype("int64")
    return np.array([[int(x) for x in w.split(",")] if w is not None else np.frombuffer(v, "<i4").tolist() for v, w in zip(vectors, wide)], dtype=object)


def _entries(books) -> list[np.ndarray]:
    large = any(abs(x) >= SAFE for part in books for entry in part for x in entry)
    return [np.array(part, dtype=object if large else "int64").reshape(len(part), -1) for part in books]


def _codes(places, n: int, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(places.to_pylist()), "i1").reshape(n, parts, -1)[:, :, 0].astype("int64")


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _first_round(books, keep: int, parts: int, scale: int):
    def run(batches):
        entries = _entries(books.value)
        for part in _slices(batches):
            flat = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("float64")
            points = integers(flat.reshape(part.num_rows, -1), scale)
            found = [closest(p, e, keep) for p, e in zip(np.split(points, parts, axis=1), entries)]
            yield _state(part, points, [(*f, np.full(part.num_rows, len(entries[0]))) for f in found])
    return run


def _next_round(books, moved, keep: int, parts: int):
    def run(batches):
        entries = _entries(books.value)
        for part in _slices(batches):
            n = part.num_rows
            points = _points(part.column(2), part.column(3))
            order = np.frombuffer(b"".join(part.column(4).to_pylist()), "i1").reshape(n, parts, -1).astype("int64")
            bounds = np.frombuffer(b"".join(part.column(5).to_pylist()), "<f4").reshape(n, parts, -1).astype("float64")
            done = [refresh(p, entries[i], moved.value[i], order[:, i].copy(), bounds[:, i, :-1].copy(), bounds[:, i, -1], keep)
                    for i, p in enumerate(np.split(points, parts, axis=1))]
            yield _state(part, points, done)
    return run


def _state(part: pa.RecordBatch, points: np.ndarray, done) -> pa.RecordBatch:
    order = np.stack([d[0] for d in done], axis=1).astype("i1")
    bounds = _down(np.stack([np.concatenate([d[1], d[2][:, None]], axis=1) for d in done], axis=1)).astype("<f4")
    compared = np.stack([d[3] for d in done], axis=1).astype("int32")
    return pa.RecordBatch.from_arrays(
        [part.column(0), part.column(1), *_packed(points), pa.array([x.tobytes() for x in order], pa.binary()), pa.array([x.tobytes() for x in bounds], pa.binary()),
         pa.FixedSizeListArray.from_arrays(pa.array(compared.ravel()), compared.shape[1]).cast(pa.list_(pa.int32()))],
        names=["vec_id", "label", "vector", "wide", "places", "bounds", "compared"])


def _sums(parts: int, entries: int):
    """A task's sums per part, entry and component, as LIMB-bit limbs of signed integers, and its counts (component -1)."""
    def run(batches):
        total, count = None, np.zeros((parts, entries), dtype="int64")
        for part in _slices(batches):
            points = _points(part.column(0), part.column(1))
            codes = _codes(part.column(2), len(points), parts)
            if total is None:
                total = np.zeros((parts, entries, points.shape[1] // parts), dtype=object)
            for i, p in enumerate(np.split(points, parts, axis=1)):
                here = np.zeros(total.shape[1:], dtype=points.dtype)
                np.add.at(here, codes[:, i], p)
                total[i] += here  # Python integers
                count[i] += np.bincount(codes[:, i], minlength=entries)
        if total is None:
            return
        out = []
        for i, e in zip(*np.nonzero(count)):
            out.append((int(i), int(e), -1, 0, int(count[i, e])))
            for c, value in enumerate(total[i, e]):
                out += [(int(i), int(e), c, limb, x) for limb, x in enumerate(limbs(int(value)))]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["part", "entry", "component", "limb", "value"])
    return run


def limbs(value: int) -> list[int]:
    """``value`` as limbs of LIMB bits, lowest first, the last of either sign: sums of limbs are limbs of the sum."""
    out = []
    while not -(1 << LIMB) < value < (1 << LIMB):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _errors(books, parts: int):
    def run(batches):
        entries = _entries(books.value)
        for part in _slices(batches):
            points = _points(part.column(2), part.column(3))
            codes = _codes(part.column(4), len(points), parts)
            error = sum(squares(p, entries[i][codes[:, i]][:, None, :])[:, 0] for i, p in enumerate(np.split(points, parts, axis=1)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([bytes(x.tolist()).hex() for x in codes], pa.string()),
                 pa.array([int(x) if x < 2 ** 63 else None for x in error], pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def _updated(books, sums) -> list:
    """Entries replaced by floor(sum / count) of their parts; one without parts stays."""
    new = [[list(entry) for entry in part] for part in books]
    total: dict[tuple, dict[int, int]] = {}
    for r in sums:
        slot = total.setdefault((r["part"], r["entry"]), {})
        slot[r["component"]] = slot.get(r["component"], 0) + (r["value"] << (LIMB * r["limb"]))
    for (part, entry), slot in total.items():
        new[part][entry] = [slot[c] // slot[-1] for c in range(len(slot) - 1)]
    return new


def _moves(before, after) -> np.ndarray:
    """How far each entry moved, rounded up."""
    return np.array([_over(np.array([sum((x - y) ** 2 for x, y in zip(a, b)) for a, b in zip(p, q)], dtype=object)) if p != q else np.zeros(len(p))
                     for p, q in zip(before, after)])


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int) -> DataFrame:
    """(vec_id, label, vector: array<double>) of the rows that take part; all vectors of one length."""
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (common[0]["n"] if common else 0))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col, parts)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not seeds:
        return Codes(rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), [])
    start = integers(np.array([r["vector"] for r in seeds], dtype="float64"), scale)
    books = [[[int(x) for x in e] for e in part] for part in np.split(start, parts, axis=1)]
    size = len(seeds)
    most, least = max(1, size // 2), max(1, entries // 8)
    keep = min(most, max(1, entries // 4))

    share = spark.sparkContext.broadcast  # of codebooks and moves: parts x entries x components
    state, old, moved = None, None, None
    for n in range(rounds + 1):  # the last assignment is to the final entries
        step = rows.mapInArrow(_first_round(share(books), keep, parts, scale), _STATE) if state is None else \
            state.mapInArrow(_next_round(share(books), share(moved), keep, parts), _STATE)
        path = scratch_path(spark, "llm-codes")
        step.write.parquet(path)
        state = spark.read.schema(_STATE).parquet(path)
        if old:
            discard(spark, old)
        old = path
        if n < rounds:
            sums = (state.select("vector", "wide", "places").mapInArrow(_sums(parts, size), "part int, entry int, component int, limb int, value long")
                    .groupBy("part", "entry", "component", "limb").agg(F.sum("value").alias("value")).collect())
            if n:
                looked = state.select(F.explode("compared").alias("n")).groupBy("n").count().collect()  # a row a number of entries
                keep = adapted({r["n"]: r["count"] for r in looked}, keep, least, most, size)
            new = _updated(books, sums)
            books, moved = new, _moves(books, new)
    final = stored(state.mapInArrow(_errors(share(books), parts), "vec_id long, label string, code string, error long"), "codes")
    discard(spark, old)
    return Codes(final, books)


def adapted(looked: dict[int, int], keep: int, least: int, most: int, size: int) -> int:
    """The fewest kept entries that spare all but MISSED of the parts the full comparison; twice as many where too many had it."""
    total, upto = sum(looked.values()), 0
    for n in sorted(looked):
        upto += looked[n]
        if upto >= (1 - MISSED) * total:
            return min(most, 2 * keep) if n == size > keep else min(most, max(n, least))
    return keep


def digest(codes: Codes) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every coded row; label_error: the errors of a label (nulls are one), summed."""
    rows = codes.rows
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", F.expr("try_cast(total AS BIGINT)").alias("label_error"), F.lit(codes.sha256()).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    sql = f"""
WITH f AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
g AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r FROM f WHERE len(embedding) = (SELECT len(embedding) FROM f GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
q AS MATERIALIZED (SELECT r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM g),
p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS c FROM q, (SELECT unnest(range({parts})) AS part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS e, c FROM p WHERE r <= {entries})"""
    for n in range(rounds + 1):
        sql += f""",
a{n} AS MATERIALIZED (SELECT r, p.part, any_value(p.c) AS c, min({{'d': list_sum(list_transform(list_zip(p.c, b{n}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS best
       FROM p JOIN b{n} ON p.part = b{n}.part GROUP BY r, p.part)"""
        if n < rounds:
            sql += f""",
s{n} AS (SELECT part, e, k, sum(c[k]) AS s, count(*) AS n FROM (SELECT part, best.e AS e, c, unnest(range(1, len(c) + 1)) AS k FROM a{n}) GROUP BY part, e, k),
m{n} AS (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c FROM s{n} GROUP BY part, e),
b{n + 1} AS MATERIALIZED (SELECT b{n}.part, b{n}.e, coalesce(m{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN m{n} ON m{n}.part = b{n}.part AND m{n}.e = b{n}.e)"""
    return sql + f""",
x AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM x JOIN q USING (r), h
"""


ORACLE = _oracle()
