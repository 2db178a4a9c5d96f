import threading
from pathlib import Path

import pytest

from tasteloom.sources import bucketstore, commits

ROW = bucketstore.ROW


def recs(spark, users, item):
    return spark.createDataFrame([(u, [(item, 1.0)]) for u in users], ROW)


def told(df):
    return {r["UserId"]: r["recommendations"][0]["ProductId"] for r in df.collect()}


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet") if "data" in p.parts}


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "store")
    users = [f"u{i}" for i in range(200)]
    assert bucketstore.current(spark, path).collect() == [] and bucketstore.lookup(spark, path, "u1").collect() == []
    assert bucketstore.upsert(recs(spark, users, "a"), path, 8) == 1
    before, held = files(path), bucketstore.manifest(spark, path)[0]
    assert bucketstore.upsert(recs(spark, ["u1", "new", None], "b"), path, 99) == 2
    after = bucketstore.manifest(spark, path)[0]
    changed = {b for b in after if after[b] != held.get(b)}
    assert before <= files(path) and 1 <= len(changed) <= 2 and len(after) == 8
    want = {u: "a" for u in users} | {"u1": "b", "new": "b"}
    assert told(bucketstore.current(spark, path)) == want
    assert told(bucketstore.current(spark, path, 1)) == {u: "a" for u in users}
    assert told(bucketstore.lookup(spark, path, "new")) == {"new": "b"} and not told(bucketstore.lookup(spark, path, "nobody"))
    bucketstore.vacuum(spark, path)
    left = files(path)
    assert told(bucketstore.current(spark, path)) == want
    # Untouched buckets keep their very files; of the first write the replaced ones are gone.
    assert {f for f in before if not any(f"bucket={b}/" in f for b in changed)} == {f for f in left if f in before}
    assert bucketstore.versions(spark, path) == [2] and bucketstore.upsert(recs(spark, [], "c"), path) == 2


def test_repeated_users_and_replays(spark, tmp_path):
    path = str(tmp_path / "store")
    twice = recs(spark, ["x", "y"], "a").unionByName(recs(spark, ["x"], "b"))
    for _ in range(2):
        bucketstore.upsert(twice, path, 4)
        assert told(bucketstore.current(spark, path)) == {"x": "b", "y": "a"}


def test_the_slower_of_two_writers_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    bucketstore.upsert(recs(spark, ["x"], "a"), path, 4)
    claim, raced = commits.claim, []

    def late(*args):
        if not raced:
            raced.append(1)
            bucketstore.upsert(recs(spark, ["x", "z"], "first"), path)
        return claim(*args)

    monkeypatch.setattr(commits, "claim", late)
    with pytest.raises(bucketstore.Conflict):
        bucketstore.upsert(recs(spark, ["x", "y"], "second"), path)
    assert told(bucketstore.current(spark, path)) == {"x": "first", "z": "first"}
    bucketstore.upsert(recs(spark, ["x", "y"], "second"), path)
    assert told(bucketstore.current(spark, path)) == {"x": "second", "y": "second", "z": "first"}


def test_what_dead_writers_leave_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    bucketstore.upsert(recs(spark, ["x"], "a"), path, 4)

    def die(*args):
        raise KeyError("dead")

    with monkeypatch.context() as m, pytest.raises(KeyError):
        m.setattr(commits, "claim", die)
        bucketstore.upsert(recs(spark, ["x"], "b"), path)
    commits.claim(spark, path, 2, "")  # a marker of a writer that died before its first word
    assert told(bucketstore.current(spark, path)) == {"x": "a"}
    bucketstore.vacuum(spark, path)
    assert len(files(path)) == 1 and bucketstore.upsert(recs(spark, ["x"], "c"), path) == 2
    assert told(bucketstore.current(spark, path)) == {"x": "c"}


def test_writers_at_once_take_different_versions(spark, tmp_path):
    path, taken = str(tmp_path / "models"), []
    threads = [threading.Thread(target=lambda: taken.append(commits.claim_next(spark, path, "job", 3))) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(taken) == list(range(3, 11)) and commits.claimed(spark, path) == list(range(10, 2, -1))
