import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.llm import negatives as n

SCHEMA = "vec_id long, label int, embedding array<float>, score string, at string, q int, asks string"


def brute(rows, every=10, first=5, most=10):
    fine = [(i, y, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, y, v) in enumerate(fine):
        if i % every:
            continue
        scores = [(-sum(p * q for p, q in zip(v, w)), j, z, b) for b, (j, z, w) in enumerate(fine) if b != a]
        for s, j, _, _ in sorted(x for x in scores if x[2] == y)[:first]:
            window = sorted(x for x in scores if x[2] != y and -30 * s <= -100 * x[0] <= -90 * s)[:most]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _, _) in enumerate(window, 1)]
    return sorted(out)


def found(spark, rows, **how):
    df = spark.createDataFrame([(i, y, v, "a", "b", 1, "c") for i, y, v in rows], SCHEMA)
    return sorted(map(tuple, n.hard_negatives(df, F.col("vec_id") % 10 == 0, **how).collect()))


def test_equals_brute_force_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(4)), (rng.normal(size=6) + 0.6).tolist()) for i in range(150)]
    rows += [(200 + i, i % 2, [1.0] * 6) for i in range(60)] + [(10, rows[10][1], rows[10][2])] * 3
    rows += [(310, None, [1.0] * 6), (320, 1, None), (330, 1, [None] * 6), (340, 1, [float("nan")]), (350, 2, [float("inf")] * 6)]
    rows += [(360, 1, [2.0, 1.0]), (370, 0, []), (None, 1, [9.0] * 6)]
    want = brute(rows)
    assert want and found(spark, rows) == want
    assert found(spark, rows, part=4, group=32, tile=8, leaf=2) == want
    assert found(spark, rows, positives=2, negatives=3, group=64) == brute(rows, first=2, most=3)


def test_few_rows_and_empty_tables(spark):
    assert found(spark, []) == found(spark, [(1, 0, [1.0])]) == found(spark, [(10, 0, [1.0])]) == []
    rows = [(10, 0, [1.0, 1.0]), (11, 0, [1.0, 1.0]), (12, 1, [0.5, 0.5]), (13, 1, [-1.0, 0.0]), (14, 1, [1.0, 1.0])]
    assert found(spark, rows) == brute(rows) == [(10, 11, 1, 12, 131072, 65536)]
    with pytest.raises(ValueError, match="63 bits"):
        found(spark, [(10, 0, [1e9, 1e8])])


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (37, 64, 101), (128, 20, 33), (0, 4, 3), (3, 0, 2)])
@pytest.mark.parametrize("largest", [300, 1 << 27, 1 << 40])
def test_strassen_is_exact(shape, largest):
    m, d, k = shape
    rng = np.random.default_rng(m + largest % 97)
    a = rng.integers(-largest, largest, size=(m, d))
    b = rng.integers(-min(largest, 1 << 15), min(largest, 1 << 15), size=(d, k))
    want = (a.astype(object) @ b.astype(object)).astype(np.int64) if d else np.zeros((m, k), dtype=np.int64)
    assert (n.strassen(a, b, 4) == want).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(0)
    scores, ids = rng.integers(0, 6, size=(4, 40)), np.arange(40)
    fits = rng.random((4, 40)) < 0.5
    whole, one, two = n.Heaps(4, 5), n.Heaps(4, 5), n.Heaps(4, 5)
    whole.offer(0, scores, ids, fits)
    one.offer(0, scores[:, :17], ids[:17], fits[:, :17])
    two.offer(0, scores[:, 17:], ids[17:], fits[:, 17:])
    two.merge(np.arange(4), one.score, one.id)
    assert (whole.score == two.score).all() and (whole.id == two.id).all()
    for row in range(4):
        want = sorted((-s, i) for s, i, f in zip(scores[row], ids, fits[row]) if f)[:5]
        assert [(-s, i) for s, i in zip(whole.score[row], whole.id[row])][: len(want)] == want
