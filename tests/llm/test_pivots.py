import math
import random
from collections import defaultdict

import numpy as np

from topictables.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector int, node string"


def brute(rows, least=0.98):
    usable = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = defaultdict(set)
    for i in usable:
        for j in usable:
            a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                links[i].add(j)
    result = []
    for i, (k, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        result.append((k, len(links[i]), component, k is not None and k == component))
    return sorted(result, key=str)


def rows_of(rng, n=200, size=16):
    centres = rng.normal(size=(12, size))
    rows = []
    for i in range(n):
        c = centres[rng.integers(12)]
        v = c + rng.normal(size=size) * rng.choice([0.01, 0.05, 0.1, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], int(rng.integers(2))))
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(30)] + [(7, rows[7][1], rows[7][2])]
    rows += [(400, rows[0][1], None), (None, rows[0][1], 0), (401, None, 0), (402, [0.0] * size, 0), (403, [float("nan")] * size, 0)]
    rows += [(404, [math.inf] + [1.0] * (size - 1), 0), (405, [None] + [1.0] * (size - 1), 0), (406, [1.0, 2.0], 0), (407, [1.0, 2.0], 0), (408, [], 0)]
    return rows


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in pivots.near_duplicates(df).collect()), key=str)


def recall(got, true):
    return sum(r[1] for r in got) / max(1, sum(r[1] for r in true))


def test_matches_brute_force(spark, monkeypatch):
    rows = rows_of(np.random.default_rng(4))
    true = brute(rows)
    for block in (2048, 7):
        monkeypatch.setattr(pivots, "BLOCK", block)
        got = found(spark, rows)
        assert recall(got, true) >= 0.99
        assert len(got) == len(true)
        counts = {r[0]: r for r in true}
        assert all(r[1] <= counts[r[0]][1] for r in got if r[0] is not None)
        assert [r[:1] + r[2:] for r in got] == [r[:1] + r[2:] for r in true]


def test_recall_in_a_dense_group(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=32)
    rows = [(i, [float(np.float32(x)) for x in centre + rng.normal(size=32) * 0.08], 1) for i in range(150)]
    rows += [(200 + i, [float(np.float32(x)) for x in rng.normal(size=32)], 1) for i in range(150)]
    got, true = found(spark, rows), brute(rows)
    assert recall(got, true) >= 0.9
    assert {r[0]: r[2] for r in got} == {r[0]: r[2] for r in true}


def test_empty_table(spark):
    assert pivots.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_permutations_are_ordered():
    random.seed(1)
    points = pivots.unit(np.random.default_rng(2).normal(size=(40, 5)))
    lists = pivots.permutations(points[:10], points)
    assert (lists[:, 0] == np.arange(10)).all()
    for v, order in zip(points, lists, strict=False):
        similar = points[order] @ v
        assert (np.diff(similar) <= 0).all() and similar[-1] >= np.sort(points @ v)[-pivots.NEAREST] - 1e-12


def test_extreme_numbers(spark):
    """Lengths that under- or overflow when they are squared."""
    small, large = [1e-200, 2e-200], [1e200, 2e200]
    rows = [(0, small, 1), (1, [2 * x for x in small], 1), (2, large, 1), (3, [3 * x for x in large], 1), (4, [1.0, 0.0], 1), (5, [5e-324, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in pivots.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (1, 4), 5: (1, 4)}


def test_pivots_lie_apart():
    points = pivots.unit(np.random.default_rng(3).normal(size=(300, 4)))
    kept = pivots._apart(points, block=40)
    one_by_one = []
    for p in points:
        if not one_by_one or (np.array(one_by_one) @ p).max() <= pivots.APART:
            one_by_one.append(p)
    assert (kept == np.array(one_by_one)).all()


def test_work_grows_with_the_vectors(monkeypatch):
    """Comparisons of vectors that are spread alike, per vector: four times the vectors, about the same."""
    monkeypatch.setattr(pivots, "BLOCK", 64)
    rng = np.random.default_rng(9)
    per_vector = []
    for n in (4000, 16_000):
        points = pivots.unit(rng.normal(size=(n, 8)))
        reference = pivots._apart(points[: n // pivots.VECTORS_A_PIVOT])
        lists = pivots.permutations(points, reference)
        sizes = defaultdict(int)
        for row in lists.tolist():
            for p in row:
                sizes[p] += 1
        parts = defaultdict(int)
        for row in lists.tolist():
            for p in row:
                for q in [x for x in row if x > p] if sizes[p] > pivots.BLOCK else [-1]:
                    parts[p, q] += 1
        per_vector.append(sum(m * m for m in parts.values()) / n)
    assert per_vector[1] < 1.4 * per_vector[0]
