import threading

import pytest

from tasteloom.sources import bucketstore, commits, labelstore


def names(spark, *found):
    return spark.createDataFrame([(n,) for n in found], "x string")


def held(df):
    return {r["label"]: r["idx"] for r in df.collect()}


def test_old_ids_stay_and_new_names_follow(spark, tmp_path):
    path = str(tmp_path / "names")
    assert held(labelstore.current(spark, path)) == {} and labelstore.newest(spark, path) == 0 and labelstore.size(spark, path) == 0
    assert labelstore.grow(names(spark, "b", "a", "b", None, ""), "x", path) == 1
    first = {"b": 0, "": 1, "a": 2}
    assert held(labelstore.current(spark, path)) == first
    assert labelstore.grow(names(spark, "z", "a", "a", "a", "c", "z"), "x", path) == 2
    both = first | {"z": 3, "c": 4}
    assert held(labelstore.current(spark, path)) == both and held(labelstore.current(spark, path, 1)) == first
    assert labelstore.size(spark, path) == 5 and labelstore.size(spark, path, 1) == 3
    # Nothing new, nothing at all, or only rows without a name: the version stays.
    for again in (names(spark, "z", "a"), names(spark), names(spark, None)):
        assert labelstore.grow(again, "x", path) == 2
    assert len(list((tmp_path / "names" / "names").iterdir())) == 2
    assert labelstore.fold(spark, path) == 3 and labelstore.fold(spark, path) == 3
    assert held(labelstore.current(spark, path)) == both and held(labelstore.current(spark, path, 2)) == both
    labelstore.vacuum(spark, path)
    assert held(labelstore.current(spark, path)) == both and commits.claimed(spark, path) == [3]
    assert labelstore.grow(names(spark, "new"), "x", path) == 4 and held(labelstore.current(spark, path)) == both | {"new": 5}


def test_index_of_rows(spark, tmp_path):
    path = str(tmp_path / "names")
    labelstore.grow(names(spark, "a", "b", "b"), "x", path)
    asked = names(spark, "a", "new", None, "b", "a")
    keep = sorted(map(str, (tuple(r) for r in labelstore.with_index(asked, "x", path, "i").collect())))
    assert keep == sorted(map(str, [("a", 1.0), ("new", 2.0), (None, 2.0), ("b", 0.0), ("a", 1.0)]))
    assert labelstore.with_index(asked, "x", path, "i", "skip").count() == 3
    with pytest.raises(Exception, match="no index for"):
        labelstore.with_index(asked, "x", path, "i", "error").collect()


def test_two_writers_give_different_ids(spark, tmp_path):
    path, told = str(tmp_path / "names"), []
    labelstore.grow(names(spark, "a"), "x", path)
    threads = [
        threading.Thread(target=lambda own=own: told.append(labelstore.grow(names(spark, "both", *own), "x", path)))
        for own in (("p", "q"), ("r",), ("s", "t"))
    ]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = held(labelstore.current(spark, path))
    assert sorted(told) == [2, 3, 4] and set(found) == {"a", "both", "p", "q", "r", "s", "t"}
    assert sorted(found.values()) == list(range(7)) and found["a"] == 0


def test_a_writer_that_died_is_passed_after_vacuum(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "names")
    labelstore.grow(names(spark, "a"), "x", path)
    commits.claim(spark, path, 2, "")
    monkeypatch.setattr(labelstore, "WAIT", 1)
    with pytest.raises(bucketstore.Conflict):
        labelstore.grow(names(spark, "b"), "x", path)
    assert held(labelstore.current(spark, path)) == {"a": 0}
    labelstore.vacuum(spark, path)
    assert labelstore.grow(names(spark, "b"), "x", path) == 2 and held(labelstore.current(spark, path)) == {"a": 0, "b": 1}


def test_a_lookup_writes_frequent_names_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "names")
    df = spark.createDataFrame([(x,) for x in "aaabbcd"], "x string")
    labelstore.grow(df, "x", path)
    written, cut = [], labelstore.cut
    monkeypatch.setattr(labelstore, "cut", lambda *a: written.append(cut(*a)) or written[-1])
    for at_least, frequent in ((2_000_000, 0), (2, 1)):
        monkeypatch.setattr(labelstore, "ROWS_PER_TASK", at_least, raising=False)
        got = {tuple(r) for r in labelstore.with_index(df, "x", path, "i").collect()}
        assert got == {("a", 0.0), ("b", 1.0), ("c", 2.0), ("d", 3.0)}
        assert written[-1].count() == frequent
