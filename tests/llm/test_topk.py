import numpy as np
from pyspark.sql import functions as F

from tasteloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, at string"


def brute(rows, k):
    fine = [(i, np.floor(256 * np.array(v, dtype="float32").astype(float))) for i, v in rows if i is not None
            and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max([len(v) for _, v in fine], default=0)
    fine = [(i, np.pad(v, (0, width - len(v)))) for i, v in fine]
    out = []
    for n, (i, q) in enumerate(fine):
        if i % 5 == 0:
            others = sorted((-int(q @ v), j) for m, (j, v) in enumerate(fine) if m != n)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(others, 1)]
    return sorted(out)


def found(spark, rows, k=3, **how):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, k, **how).collect()))


def test_equals_brute_force_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0] * 6) for i in range(40)] + [(5, rows[5][1]), (300, None), (305, [float("nan")] * 6)]
    rows += [(310, [None] * 6), (315, [float("inf")] * 6), (320, [1.0, 2.0]), (325, []), (None, [9.0] * 6)]
    assert found(spark, rows, block=16, part=4) == brute(rows, 3)
    assert found(spark, rows) == brute(rows, 3)


def test_negative_scores_and_short_lists(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [-2.0, 0.0])]
    assert found(spark, rows, k=5) == brute(rows, 5) == [(0, 1, 1, -65536), (0, 2, 2, -131072)]
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []
