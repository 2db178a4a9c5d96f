import hashlib

import numpy as np
import pytest

from tasteloom.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, cluster string, q string, distance int, key string, d int"


def brute(rows, width, k, rounds, scale=64):
    fine = [(i, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    tag = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(fine, key=tag)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in fine]
        for n in range(len(centroids)):
            members = [v for (_, v), c in zip(fine, own) if c == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    told = [(i, *nearest(v)[::-1]) for i, v in fine]
    total = sum(d for _, _, d in told)
    inertia = {n: sum(d for _, c, d in told if c == n) for n in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], total, digest[c]) for i, c, d in told), key=repr)


def found(spark, rows, width, **how):
    df = spark.createDataFrame([(i, v, "x", "y", 1, "z", 2) for i, v in rows], SCHEMA)
    return sorted(map(tuple, clustering.cluster(df, width=width, **how).collect()), key=repr)


def test_equals_brute_force_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(5, 12)) * 3
    rows = [(i, (middle[i % 5] + rng.normal(size=12)).tolist()) for i in range(200)]
    rows += [(300 + i, [0.25] * 12) for i in range(60)] + [(7, rows[7][1])] * 3 + [(None, [1.0] * 12), (None, [0.5] * 12)]
    rows += [(400, None), (401, []), (402, [1.0] * 11), (403, [float("nan")] * 12), (404, [None] + [1.0] * 11), (405, [float("-inf")] * 12)]
    assert found(spark, rows, 12, k=6) == brute(rows, 12, 6, 3)
    assert found(spark, rows, 12, k=1, rounds=1, pivots=1) == brute(rows, 12, 1, 1)
    assert found(spark, rows, 12, k=9, rounds=0, pivots=9) == brute(rows, 12, 9, 0)


def test_few_equal_and_no_vectors(spark):
    same = [(i, [1.0, -2.0, 0.1]) for i in range(40)]
    assert found(spark, same, 3) == brute(same, 3, 16, 3)
    few = [(1, [1.0, 2.0]), (2, [-1.0, 2.5])]
    assert found(spark, few, 2) == brute(few, 2, 16, 3)
    assert found(spark, [(1, None)], 2) == found(spark, [], 2) == []
    with pytest.raises(Exception, match="63 bits"):
        found(spark, [(1, [1e18, 0.0])], 2)


def test_bounds_hold_and_rule_out_centroids():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-400, 400, size=(16, 64))
    vectors = centroids[rng.integers(0, 16, 500)] + rng.integers(-40, 40, size=(500, 64))
    simplex = clustering.Simplex(np.vstack([centroids[:8], centroids[:2]]))
    assert len(simplex.pivots) == 8
    flat, height = simplex.apexes(simplex.distances(vectors))
    at, above = simplex.apexes(simplex.distances(centroids))
    true = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
    across = ((flat[:, None] - at) ** 2).sum(axis=2)
    assert (across + (height[:, None] - above) ** 2 <= true * (1 + 1e-9) + 1e-3).all()
    assert (across + (height[:, None] + above) ** 2 >= true * (1 - 1e-9) - 1e-3).all()
    best, distance, computed = clustering.nearest(vectors, simplex.distances(vectors), centroids, simplex)
    assert (best == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
    assert computed < len(vectors) * len(centroids) / 2
