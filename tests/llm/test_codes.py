"""Vector codes against plain k-means on Python integers; bounds never change a code."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import codes


def brute(rows, parts, entries, rounds, scale=4096):
    """rows: (id, label, vector) that take part."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    whole = lambda x: int(x) * scale if abs(x) >= 2.0 ** 52 else math.floor(x * scale)
    points = [[whole(x) for x in v] for _, _, v in rows]
    w = len(points[0]) // parts
    cut = [[tuple(p[i * w:(i + 1) * w]) for i in range(parts)] for p in points]
    books = [[p[i] for p in cut[:entries]] for i in range(parts)]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p, book: min((d(p, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for i, book in enumerate(books):
            groups = {}
            for p in cut:
                groups.setdefault(nearest(p[i], book)[1], []).append(p[i])
            books[i] = [tuple(sum(c) // len(groups[k]) for c in zip(*groups[k])) if k in groups else e for k, e in enumerate(book)]
    final = [[nearest(p[i], books[i]) for i in range(parts)] for p in cut]
    errors = [sum(x for x, _ in f) for f in final]
    labels = {}
    for (_, label, _), e in zip(rows, errors):
        labels[label] = labels.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    fits = lambda x: x if x < 2 ** 63 else None
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), fits(e), fits(labels[r[1]]) if fits(e) is not None else None, digest) for r, f, e in zip(rows, final, errors)), key=repr)


def found(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, code string, error int")
    out = codes.digest(codes.compress(table, **more))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


def _vectors(seed, n, dims):
    rng = np.random.Generator(np.random.PCG64(seed))
    centres = rng.normal(0, 1, (9, dims))
    return [(int(i), int(i) % 4 if i % 9 else None, (centres[i % 9] + rng.normal(0, 0.4, dims)).round(3).tolist()) for i in rng.permutation(n)]


def test_codes_match_brute_force(spark):
    rows = _vectors(1, 400, 16)
    rows += [(900, 1, rows[0][2]), (900, 1, rows[0][2]), (3, 2, rows[5][2]), (None, None, rows[7][2]), (901, 3, [0.0] * 16), (902, 3, [-0.0001] * 16)]
    out = [(903, 1, None), (904, 1, rows[0][2][:15] + [None]), (905, 1, rows[0][2][:15] + [float("nan")]), (906, 1, rows[0][2][:15] + [float("inf")]),
           (907, 1, []), (908, 1, rows[0][2][:8]), (909, 1, rows[0][2][:13])]
    assert found(spark, rows + out) == brute(rows, 8, 16, 6)


def test_ties_go_to_the_lower_entry(spark):
    rng = random.Random(4)
    rows = [(i, 0, [float(rng.randint(0, 2)) for _ in range(8)]) for i in range(300)]  # one whole number a part: many ties, equal entries
    assert found(spark, rows) == brute(rows, 8, 16, 6)


def test_components_of_any_size(spark):
    rows = _vectors(2, 60, 8) + [(500, 1, [1e30, -1e30, 3e18, 5.0, 0.0, 1.0, 2.0, 1e5]), (501, 1, [1e300] * 8), (502, 0, [2.0 ** 23] * 8)]
    got, want = found(spark, rows), brute(rows, 8, 16, 6)
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], r[2], r[4]) for r in want]


def test_few_rows_and_none(spark):
    rows = _vectors(3, 5, 8)
    assert found(spark, rows) == brute(rows, 8, 16, 6)
    assert found(spark, rows[:1]) == brute(rows[:1], 8, 16, 6)
    assert found(spark, []) == [] and found(spark, [(1, 1, None)]) == []


@pytest.mark.parametrize("keep", [1, 2, 4, 7])
def test_bounds_spare_work_and_change_no_assignment(keep):
    rng = np.random.Generator(np.random.PCG64(keep))
    points, entries = rng.integers(-4000, 4000, (3000, 8)), rng.integers(-4000, 4000, (16, 8))
    order, bounds, outer = codes.closest(points, entries, keep)
    spared = 0
    for step, shift in enumerate((400, 150, 60, 20, 5, 0)):
        moved = entries + rng.integers(-shift - 1, shift + 1, entries.shape) * (rng.random(16) < 0.7)[:, None]
        length = np.sqrt(((moved - entries) ** 2).sum(1)) * (1 + 1e-9)
        entries = moved
        keep = max(1, min(7, keep + (step % 3) - 1))  # lists grow and shrink
        order, bounds, outer, compared = codes.refresh(points, entries, length, order.copy(), bounds.copy(), outer, keep)
        d = codes.squares(points, entries)
        assert (order[:, 0] == d.argmin(axis=1)).all()
        far = np.sqrt(d)
        listed = order >= 0
        held = np.take_along_axis(far, np.where(listed, order, 0), 1)
        assert (bounds <= held + 1e-6)[listed].all()  # every bound is one
        outside = far.copy()
        np.put_along_axis(outside, np.where(listed, order, order[:, :1]), np.inf, 1)
        assert (outer <= outside.min(axis=1) + 1e-6).all()
        spared += (compared < 16).sum()
    assert spared > 3000


def test_limbs_add_up():
    values = [0, 5, -5, 2 ** 30, -2 ** 30, 2 ** 64 + 3, -2 ** 100 - 7, 10 ** 300]
    total = {}
    for v in values:
        for i, x in enumerate(codes.limbs(v)):
            assert -2 ** 31 < x < 2 ** 31
            total[i] = total.get(i, 0) + x
    assert sum(x << (codes.LIMB * i) for i, x in total.items()) == sum(values)


def test_adapted_list_length():
    assert codes.adapted({1: 90, 2: 9, 16: 1}, 4, 2, 8, 16) == 2
    assert codes.adapted({1: 50, 3: 49, 16: 1}, 4, 2, 8, 16) == 3
    assert codes.adapted({1: 50, 16: 50}, 4, 2, 8, 16) == 8
