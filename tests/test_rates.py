import datetime as dt
import random

from pyspark.sql import functions as F

from tasteloom.operators import metrics
from tasteloom.operators.ordering import with_neighbour
from tests.test_plans import plan

ZERO = dt.datetime(2024, 1, 1)


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    """(who, ts, v) from (who, seconds, v); seconds None: no time."""
    return spark.createDataFrame(
        [(w, None if s is None else at(s), v, "x", 1) for w, s, v in rows], "who string, ts timestamp_ntz, v double, _part string, _row int")


def brute_rate(rows, seconds, step):
    """Window by window over the sorted samples of each series."""
    out = {}
    fine = [(w, s, v) for w, s, v in rows if s is not None and v is not None]
    base = ZERO.timestamp() if ZERO.tzinfo else (ZERO - dt.datetime(1970, 1, 1)).total_seconds()
    for who in {w for w, _, _ in fine}:
        own = sorted((s, v) for w, s, v in fine if w == who)
        for end in range(0, int(max(s for s, _ in own)) + seconds + step, step):
            assert (base + end) % step == 0
            win = [(s, v) for s, v in own if end - seconds < s <= end]
            if len(win) < 2 or win[0][0] == win[-1][0]:
                continue
            rise = sum(b - a if b >= a else b for (_, a), (_, b) in zip(win, win[1:]))
            span = win[-1][0] - win[0][0]
            every = span / (len(win) - 1)
            ahead, behind = win[0][0] - (end - seconds), end - win[-1][0]
            ahead = ahead if ahead < 1.1 * every else every / 2
            behind = behind if behind < 1.1 * every else every / 2
            if rise > 0 and win[0][1] >= 0:
                ahead = min(ahead, span * win[0][1] / rise)
            out[who, at(end)] = round(rise * (span + ahead + behind) / span, 6)
    return out


def test_rate_with_resets_equals_brute_force(spark):
    rng, rows = random.Random(3), []
    for who in ("a", "b", None):
        value, second = 0.0, rng.randrange(100)
        while second < 4000:
            rows.append((who, second + rng.choice([0, 0.25]), value))
            second += rng.choice([1, 20, 60, 400])
            value = rng.choice([0.0, 3.0]) if rng.random() < 0.15 else value + rng.randrange(9)
    rows += [("hot", i / 4, float(i % 700)) for i in range(6000)] + [("one", 10, 5.0), ("same", 5, 1.0), ("same", 5, 2.0)]
    rows += [("a", None, 4.0), ("a", 50.5, None), ("gap", 0, 10.0), ("gap", 290, 12.0), ("gap", 2000, 3.0), ("gap", 2001, 4.0)]
    got = metrics.counter_rate(frame(spark, rows), "ts", ["who"], "v", 300, 60)
    assert {(r["who"], r["at"]): round(r["increase"], 6) for r in got.collect()} == brute_rate(rows, 300, 60)
    assert metrics.counter_rate(frame(spark, []), "ts", ["who"], "v", 300, 60).collect() == []


def test_known_rates(spark):
    rows = [("up", s, float(s)) for s in range(0, 301, 15)] + [("reset", s, float(s % 150)) for s in range(0, 301, 15)]
    got = metrics.counter_rate(frame(spark, rows), "ts", ["who"], "v", 300, 300)
    told = {(r["who"], r["at"]): r["per_second"] for r in got.collect()}
    assert abs(told["up", at(300)] - 1) < 1e-9 and 0.85 < told["reset", at(300)] <= 1


def test_gauge_at_steps_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randrange(3000), 60 * rng.randrange(50)]) + rng.choice([0, 0.5]), float(i)) for i in range(300)]
    rows += [("a", 60, 7.0), ("a", 60, 9.0), ("lone", 0, 1.0), ("a", None, 1.0), ("a", 120, None)]
    got = metrics.gauge_at_steps(frame(spark, rows), "ts", ["who"], "v", ["v"], 60, 300)
    fine, want = [r for r in rows if r[1] is not None and r[2] is not None], {}
    for who in {r[0] for r in fine}:
        for end in range(0, 3600, 60):
            held = [(s, v) for w, s, v in fine if w == who and end - 300 < s <= end]
            if held:
                want[who, at(end)] = max(held)[1]
    rows_got = got.collect()
    assert {(r["who"], r["at"]): r["value"] for r in rows_got} == want and len(rows_got) == len(want)


def test_gauge_sum_plan_has_no_nested_loop(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    for df in (
        metrics.gauge_sum_range(events, "event_type", "ts", ["user_id"], "value", ["event_id"], "c.*", 60, 300),
        metrics.counter_rate(events, "ts", ["event_type"], "value", 300, 60),
    ):
        assert not any(word in plan(df) for word in ("Cartesian", "NestedLoop", "Python"))


def test_neighbours_across_partitions(spark):
    rows = [(f"s{i % 3}", i // 3, i) for i in range(900)]
    df = spark.createDataFrame(rows, "who string, k int, v int").repartition(7)
    near = with_neighbour(with_neighbour(df, ["who"], [F.col("k")], ["v"], "b"), ["who"], [F.col("k")], ["v"], "a", after=True)
    for r in near.collect():
        assert (r["b"]["v"] if r["b"] else None) == (r["v"] - 3 if r["k"] else None)
        assert (r["a"]["v"] if r["a"] else None) == (r["v"] + 3 if r["k"] < 299 else None)


def test_sliding_quantiles_on_a_stream(spark, tmp_path):
    rng = random.Random(1)
    rows = [("a", rng.randrange(7200), rng.gauss(50, 20)) for _ in range(30_000)] + [("a", 100, None), ("a", 100, float("nan")), ("b", 60, 3.0), ("b", 20_000, 1.0)]
    frame(spark, rows).drop("_part", "_row").write.parquet(str(tmp_path / "in"))
    events = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    told = metrics.stream_quantile(stream, "ts", "who", "v", 0.99, "1 hour", "10 minutes", "1 minute")
    path = str(tmp_path / "out")
    writer = told.writeStream.format("parquet").option("path", path).option("checkpointLocation", str(tmp_path / "offsets"))
    writer.trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.parquet(path)
    checked = metrics.rank_within(closed, events, "ts", "who", "v", 0.99, 3600, 600).collect()
    assert len(checked) == closed.count() and all(r["within"] for r in checked)
    counts = {(r["who"], r["window_start"]): r["n"] for r in checked}
    want = {}
    for who, s, v in rows:
        if v is not None and v == v:
            for start in range(s // 600 * 600 - 3000, s // 600 * 600 + 1, 600):
                if start + 3600 <= 20_000 - 60:
                    want[who, at(start)] = want.get((who, at(start)), 0) + 1
    assert counts == want
