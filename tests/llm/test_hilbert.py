from collections import Counter

import numpy as np

from tasteloom.llm import hilbert

SCHEMA = "doc_id long, lang string, size long, x string, curve string"


def test_the_curve_visits_every_cell_and_moves_one_step():
    side = np.arange(8)
    x, y, z = (a.ravel() for a in np.meshgrid(side, side, side))
    order = np.argsort(hilbert.curve_index([x, y, z], 3))
    points = np.stack([x, y, z], axis=1)[order]
    assert (np.abs(np.diff(points, axis=0)).sum(axis=1) == 1).all()
    assert sorted(hilbert.curve_index([x, y, z], 3)) == list(range(512))


def shards(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return hilbert.shard_by_curve(df.drop("curve"), ["lang", "size"], ["doc_id"], shards=4, bits=3).collect()


def test_shards_are_even_and_slots_gapless(spark):
    rows = [(i, "hot" if i % 3 else f"l{i % 7}", i % 50, "t", "c") for i in range(101)]
    rows += [(None, None, None, None, None), (5, "hot", 3, "t", "c"), (5, "hot", 3, "t", "c")]
    got = shards(spark, rows)
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 104 and max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 4
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_curve_runs_are_narrow_in_both_dimensions(spark):
    rows = [(i, f"l{i % 8}", i // 8, "t", "c") for i in range(512)]
    for shard in range(4):
        own = [r for r in shards(spark, rows) if r["shard"] == shard]
        assert len({r["lang"] for r in own}) <= 4 and max(r["size"] for r in own) - min(r["size"] for r in own) < 48


def test_empty_table_and_fewer_rows_than_shards(spark):
    assert shards(spark, []) == []
    assert sorted(r["slot"] for r in shards(spark, [(1, "a", 1, "t", "c"), (2, None, None, "", "c")])) == [0, 0]


def test_written_shards_come_back(spark, tmp_path):
    df = spark.createDataFrame([(i, "a", i, "t", "c") for i in range(20)], SCHEMA).drop("curve")
    hilbert.write_shards(hilbert.shard_by_curve(df, ["size"], ["doc_id"], 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("shard = 2").count() == 5


def test_cuts_and_slots_against_a_plain_sort(spark):
    """Cells from counts over all rows, one sort of all rows along the curve, runs of equal length: all in plain Python."""
    rng = np.random.default_rng(3)
    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"l{rng.integers(9)}", int(rng.integers(40)) ** 2, "t", "c") for i in range(333)]
    rows += rows[:5]  # repeated rows
    rng.shuffle(rows)

    def cells(at, n=8):
        values = sorted(r[at] for r in rows if r[at] is not None)
        firsts = {}
        for value in sorted(set(values)):
            upto = values.index(value) + values.count(value)
            firsts.setdefault((upto - 1) * n // len(values), value)
        bounds = sorted(firsts.values())[1:]
        return [0 if r[at] is None else sum(b <= r[at] for b in bounds) for r in rows]

    curve = hilbert.curve_index([np.array(cells(1)), np.array(cells(2))], 3)
    order = sorted((int(c), int(r[0])) for c, r in zip(curve, rows))
    n, want = len(rows), []
    for at, (c, doc) in enumerate(order):
        shard = at * 4 // n
        want.append((doc, c, shard, at - sum(p * 4 // n < shard for p in range(n))))
    assert sorted((r["doc_id"], r["curve"], r["shard"], r["slot"]) for r in shards(spark, rows)) == sorted(want)
