import pytest
from pyspark.sql import functions as F

from tasteloom.operators import serve
from tasteloom.sources import recstore, registry
from tasteloom.sources.schemas import RECOMMENDATIONS
from tasteloom.sources.scratch import scratch_dir

RUN = "name string, version long, stage string, rank int, regParam double, rmse double, coverage double, path string"


def lists(spark, **products):
    rows = [(user, [(product, 1.0)]) for user, product in products.items()]
    return spark.createDataFrame(rows, RECOMMENDATIONS)


def latest(spark, path):
    rows = recstore.latest(recstore.history(spark, path)).collect()
    return {r["UserId"]: r["recommendations"][0]["ProductId"] for r in rows}


def test_newest_batch_wins_and_replay_changes_nothing(spark):
    path = scratch_dir(spark, "store")
    recstore.create_if_missing(spark, path)
    assert latest(spark, path) == {}
    recstore.write_batch(lists(spark, u="a", v="a"), path, 0, 9)
    recstore.write_batch(lists(spark, u="b"), path, 0, 10)
    want = {"u": "b", "v": "a"}
    assert latest(spark, path) == want
    for _ in range(2):
        recstore.write_batch(lists(spark, u="b"), path, 0, 10)
        assert latest(spark, path) == want
    recstore.create_if_missing(spark, path)
    assert latest(spark, path) == want
    # The checkpoint was lost: numbers start again, the next run still wins.
    recstore.write_batch(lists(spark, v="c"), path, 1, 0)
    assert latest(spark, path) == {"u": "b", "v": "c"}


def test_lookups(spark):
    path, snap = scratch_dir(spark, "store"), scratch_dir(spark, "snapshot")
    recstore.write_batch(lists(spark, **{f"u{i}": f"p{i}" for i in range(50)}), path, 0, 0)
    recs = recstore.latest(recstore.history(spark, path))
    recstore.write_snapshot(recs, snap, 8)
    for user, want in (("u7", ["p7"]), ("nobody", [])):
        for row in (serve.point_lookup(recs, user), recstore.snapshot_lookup(spark, snap, user)):
            assert [r["recommendations"][0]["ProductId"] for r in row.collect()] == want
    assert serve.count_recommendations(recs).first()[0] == 50


def test_a_snapshot_knows_its_buckets_and_is_replaced_at_once(spark):
    snap = scratch_dir(spark, "snapshot")
    assert recstore.snapshot_lookup(spark, snap, "u1").collect() == []
    for buckets, product in ((8, "a"), (3, "b")):
        recstore.write_snapshot(lists(spark, **{f"u{i}": product for i in range(12)}), snap, buckets)
        got = [recstore.snapshot_lookup(spark, snap, f"u{i}").first() for i in range(12)]
        assert [r["recommendations"][0]["ProductId"] for r in got] == [product] * 12


def test_compaction_changes_nothing_at_any_step(spark, monkeypatch):
    path = scratch_dir(spark, "store")
    recstore.create_if_missing(spark, path)
    recstore.compact(spark, path)

    def now():
        rows = recstore.current(spark, path).collect()
        return {r["UserId"]: r["recommendations"][0]["ProductId"] for r in rows}

    assert now() == {}
    recstore.write_batch(lists(spark, u="a", v="a"), path, 0, 0)
    recstore.write_batch(lists(spark, u="b"), path, 0, 1)
    recstore.compact(spark, path)
    assert now() == {"u": "b", "v": "a"}
    recstore.write_batch(lists(spark, w="c"), path, 0, 2)
    want = {"u": "b", "v": "a", "w": "c"}
    assert now() == want
    # A compaction that dies after the base is written, before it is named.
    half = recstore._since(spark, path, recstore._pointer(spark, f"{path}/_current", recstore.BASE_POINTER))
    recstore._newest(half.limit(1)).write.parquet(f"{path}/_base/v=2")
    assert now() == want
    recstore.compact(spark, path)
    assert now() == want
    recstore.drop_compacted(spark, path)
    assert now() == want and recstore.history(spark, path).count() == 0
    recstore.write_batch(lists(spark, v="d"), path, 1, 0)
    assert now() == want | {"v": "d"}


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        ("m", 1, "Production", 10, 0.1, 0.95, 1.0, "p1"), ("m", 2, "None", 20, 0.05, 0.9, 1.0, "p2"),
        ("m", 3, "Staging", 10, 0.05, 0.92, 1.0, "p3"), ("x", 9, "None", 10, 0.1, 0.5, 1.0, "p9"),
    ]
    path = scratch_dir(spark, "runs")
    registry.create_if_missing(spark, path)
    assert registry.read(spark, path).isEmpty()
    for row in rows:
        registry.append(spark.createDataFrame([row], RUN), path)
    return registry.read(spark, path)


def test_latest_is_the_highest_version_of_the_stages_asked_for(runs):
    mine = runs.where(F.col("name") == "m")
    assert registry.latest(mine).first()["version"] == 3
    assert registry.latest(mine, ["None", "Production"]).first()["version"] == 2
    assert registry.latest(mine, ["Archived"]).collect() == []


def test_versions(runs):
    got = {tuple(r) for r in registry.versions(runs).collect()}
    assert got == {("m", "Production", 1), ("m", "None", 2), ("m", "Staging", 3), ("x", "None", 9)}


def test_metrics_or_a_reason(runs):
    assert tuple(registry.latest_metrics(runs, "m").first()) == ("0.9", "20", "0.05", None)
    assert tuple(registry.latest_metrics(runs, "unknown").first()) == ("N/A", "N/A", "N/A", "no version found")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster, "x")
