import os

import numpy as np
import pytest
from pyspark.sql import DataFrame, functions as F

from tasteloom.operators.activity import filter_users_then_items
from tasteloom.operators.clean import clean_nulls, dedup_pairs
from tasteloom.operators.labels import fit_labels
from tasteloom.operators.topn import topn_by_factors
from tasteloom.plans import training
from tasteloom.plans.bundle import Bundle
from tasteloom.sources import registry
from tasteloom.sources.scratch import cut, scratch_dir
from workload.queries import als_predict, list_checks


def explode_recommendations(recommendations: DataFrame) -> DataFrame:
    """Rows (user_index, rank, item_index, score) from the array form ``recommendForUserSubset`` gives."""
    rec = F.posexplode("recommendations").alias("pos", "rec")
    return recommendations.select("user_index", rec).select(
        F.col("user_index").cast("long").alias("user_index"),
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.item_index").cast("long").alias("item_index"),
        F.col("rec.rating").cast("double").alias("score"),
    )


@pytest.fixture(scope="module")
def reviews(spark):
    """200 users, 100 items, rank 3 (the mean and two factors) plus a little noise, 30 % observed."""
    rng = np.random.default_rng(11)
    truth = 3 + rng.normal(size=(200, 2)) @ rng.normal(size=(2, 100)) * 0.7
    seen = rng.random(truth.shape) < 0.3
    rows = [
        (n, f"u{u}", f"p{i}", float(truth[u, i] + rng.normal() * 0.05), 1000 + n)
        for n, (u, i) in enumerate(zip(*np.nonzero(seen)))
    ]
    return cut(spark.createDataFrame(rows, "Id long, UserId string, ProductId string, Score float, Time long"))


@pytest.fixture(scope="module")
def indexed(reviews):
    return cut(training.train_frame(reviews).ratings)


@pytest.fixture(scope="module")
def model(indexed):
    return training.fit(indexed, rank=3, regParam=0.02)


def test_beats_the_mean_on_planted_factors(indexed, model):
    train, test = training.hash_split(indexed)
    fitted = training.fit(train, rank=3, regParam=0.02)
    quality = training.evaluate(fitted, test).first()
    spread = test.agg(F.stddev_pop("Score")).first()[0]
    assert quality["rmse"] < 0.3 * spread
    assert quality["coverage"] == 1.0


def test_cold_rows_count_against_coverage(spark, model, indexed):
    cold = indexed.limit(3).withColumn("item_index", F.lit(99_999.0))
    quality = training.evaluate(model, indexed.limit(7).unionAll(cold)).first()
    assert (quality["n_scored"], quality["n_total"], quality["coverage"]) == (7, 10, 0.7)


def test_top_n_equals_exact_search(model):
    builtin = explode_recommendations(model.recommendForAllUsers(5)).collect()
    exact = topn_by_factors(model.userFactors, model.itemFactors, 5).collect()
    by_place = {(r["user_index"], r["rank"]): r for r in exact}
    assert len(builtin) == len(exact) == 200 * 5
    for r in builtin:
        mine = by_place[r["user_index"], r["rank"]]
        assert r["score"] == pytest.approx(mine["score"], abs=1e-4)


def test_same_seed_same_model(indexed, model):
    again = training.fit(indexed.repartition(5), rank=3, regParam=0.02)
    one, two = (training.evaluate(m, indexed).first()["rmse"] for m in (model, again))
    assert one == pytest.approx(two, abs=1e-3)


@pytest.mark.parametrize("ratings, users, items, want", [
    (10**6, 10**4, 10**3, (10, 10)),
    (10**9, 10**8, 10**6, (200, 10)),
    (10**12, 10**9, 10**7, (512, 20)),
])
def test_blocks_follow_each_side_and_stay_bounded(ratings, users, items, want):
    got = training.blocks_for(ratings, users, items)
    assert (got["numUserBlocks"], got["numItemBlocks"]) == want


def test_sizes_come_from_one_pass(indexed):
    assert training.sizes_of(indexed) == (indexed.count(), 200, 100)


def test_tuning_reports_the_winner(indexed):
    tuned = training.tune(indexed, ranks=[2, 3], reg_params=[0.02, 5.0], maxIter=5)
    best = min(tuned.grid, key=lambda g: g[2])
    assert (tuned.rank, tuned.reg_param) == best[:2]
    assert tuned.reg_param == 0.02 and tuned.model.rank == tuned.rank
    assert len(tuned.grid) == 4


def test_saved_bundle_recommends_the_same(spark, reviews, indexed, model):
    users, items = fit_labels(indexed, "UserId"), fit_labels(indexed, "ProductId")
    path = scratch_dir(spark, "model")
    Bundle.of_als(model, users, items).save(path)
    loaded = Bundle.load(spark, path)
    asked = spark.createDataFrame([("u1",), ("u7",), ("nobody",)], "UserId string")
    few, many = loaded.known_users(asked, 3), loaded.known_users(asked)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    rows = loaded.ranked(few, 5).collect()
    assert sorted({r["UserId"] for r in rows}) == ["u1", "u7"] and len(rows) == 10
    before = Bundle.of_als(model, users, items).ranked(few, 5).collect()
    assert {tuple(r) for r in before} == {tuple(r) for r in rows}
    for r in loaded.recommend(few, 5).collect():
        scores = [x["score"] for x in r["recommendations"]]
        assert scores == sorted(scores, reverse=True) and len(scores) == 5


def test_train_and_register(spark, reviews):
    models, runs = scratch_dir(spark, "models"), scratch_dir(spark, "runs")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    for want in (1, 2):
        got = training.train_and_register(reviews, models, runs, ranks=[2], reg_params=[0.05], maxIter=3)
        assert got == want
    row = registry.latest(registry.read(spark, runs)).first()
    assert (row["version"], row["rank"], row["regParam"], row["coverage"]) == (2, 2, 0.05, 1.0)
    assert Bundle.load(spark, row["path"]).item_labels.count() == 100
    left = {name.split("-")[0] for name in set(os.listdir(shared)) - before}
    assert left <= {"models", "runs"}


def test_train_frame_keeps_what_the_filters_keep(spark, reviews):
    pairs = dedup_pairs(clean_nulls(reviews))
    want = filter_users_then_items(pairs, 30, 30)
    frame = training.train_frame(reviews, 30, 30)
    got = frame.ratings
    assert 0 < want.count() < pairs.count()
    assert got.select(*want.columns).exceptAll(want).isEmpty() and got.count() == want.count()
    for labels, column in ((frame.user_labels, "UserId"), (frame.item_labels, "ProductId")):
        assert {tuple(r) for r in labels.collect()} == {tuple(r) for r in fit_labels(want, column).collect()}


def test_preprocess_fails_on_a_missing_name(spark):
    rows = [(i, "u", None if i == 2 else f"p{i}", 1.0, i) for i in range(4)]
    df = spark.createDataFrame(rows, "Id long, UserId string, ProductId string, Score float, Time long")
    with pytest.raises(Exception, match="no index for ProductId"):
        training.preprocess(df).ratings.collect()


def test_list_checks_turn_false_on_broken_lists(spark):
    rows = [
        ("good", 1, "a", 3.0), ("good", 2, "b", 3.0), ("good", 3, "c", 1.0),
        ("rising", 1, "a", 1.0), ("rising", 2, "b", 2.0), ("gap", 1, "a", 2.0), ("gap", 3, "b", 1.0),
        ("twice", 1, "a", 2.0), ("twice", 2, "a", 1.0),
    ]
    lists = list_checks(spark.createDataFrame(rows, "UserId string, rank int, ProductId string, score double"))
    got = {r["UserId"]: (r["n_items"], r["in_order"], r["distinct_items"]) for r in lists.collect()}
    assert got == {"good": (3, True, True), "rising": (2, False, True), "gap": (2, False, True), "twice": (2, True, False)}


def test_a_broken_model_does_not_beat_the_mean(spark, monkeypatch):
    fit = training.fit
    monkeypatch.setattr(training, "fit", lambda train, **how: fit(train, rank=1, regParam=50.0, maxIter=1))
    assert als_predict(spark, "/root/testdata/sf0.001").first()["beats_mean"] is False


def test_what_a_search_keeps_on_disk_is_bounded(indexed, monkeypatch):
    """Factors sent between blocks are deleted at checkpoints; the parts kept for the candidates hold no names."""
    given, search = [], training.TrainValidationSplit.fit
    monkeypatch.setattr(training.TrainValidationSplit, "fit", lambda self, df: given.append((self.getEstimator(), df)) or search(self, df))
    training.tune(indexed, ranks=[2], reg_params=[0.1], maxIter=1)
    estimator, table = given[0]
    assert estimator.getCheckpointInterval() <= 2
    assert table.columns == ["user_index", "item_index", "Score"]


def test_blocks_fill_whole_waves_of_cores():
    got = training.in_waves({"numUserBlocks": 14, "numItemBlocks": 10}, 12)
    assert got == {"numUserBlocks": 24, "numItemBlocks": 12}
    assert training.in_waves({"numUserBlocks": 510, "numItemBlocks": 10}, 50) == {"numUserBlocks": 510, "numItemBlocks": 10}


def test_blocks_hold_no_more_ratings_than_a_task_can(indexed, monkeypatch):
    """173 million ratings of 5 million users and 7 million items: by vectors alone 12 blocks of 14 million ratings."""
    given, make = [], training.als
    few = {"rank": 2, "maxIter": 1, "numUserBlocks": 2, "numItemBlocks": 2}
    monkeypatch.setattr(training, "als", lambda **how: given.append(how) or make(**(how | few)))
    sizes = (173_000_000, 5_400_000, 7_200_000)
    training.fit(indexed, sizes, rank=20)
    training.tune(indexed, ranks=[2, 20], reg_params=[0.1], sizes=sizes)
    for how in given:
        for side in ("numUserBlocks", "numItemBlocks"):
            assert sizes[0] / how[side] * (60 + 24 + 4 * 20) <= 256 << 20 and how[side] <= 512
    assert training.within_memory({"numUserBlocks": 200, "numItemBlocks": 10}, 10**12, 10) == {"numUserBlocks": 512, "numItemBlocks": 512}
    assert training.within_memory({"numUserBlocks": 14, "numItemBlocks": 10}, 10**7, 20) == {"numUserBlocks": 14, "numItemBlocks": 10}


def test_a_fit_uses_whole_waves(indexed, monkeypatch):
    given, make = [], training.als
    monkeypatch.setattr(training, "als", lambda **how: given.append(how) or make(**how))
    training.fit(indexed, rank=2, maxIter=1)
    training.tune(indexed, ranks=[2], reg_params=[0.1], maxIter=1)
    cores = indexed.sparkSession.sparkContext.defaultParallelism
    assert len(given) == 2 and all(how[side] % cores == 0 for how in given for side in ("numUserBlocks", "numItemBlocks"))


def test_frame_without_names_holds_the_same_ratings_and_split(reviews):
    named, bare = training.train_frame(reviews, 30, 30), training.train_frame(reviews, 30, 30, named=False)
    assert bare.ratings.columns == ["user_index", "item_index", "Score", "bucket"]
    assert dict(bare.ratings.dtypes)["user_index"] == dict(bare.ratings.dtypes)["item_index"] == "int"
    splits = zip(training.hash_split(named.ratings), training.hash_split(bare.ratings, bucket=F.col("bucket")))
    for want, got in splits:
        rows = [sorted((r["user_index"], r["item_index"], r["Score"]) for r in part.collect()) for part in (want, got)]
        assert rows[0] == rows[1] and rows[0]


def test_users_are_counted_and_filtered_once(reviews, monkeypatch):
    """What both the item labels and the ratings are made from is written, and the names leave with it."""
    written, write = {}, training.cut
    monkeypatch.setattr(training, "cut", lambda df, purpose="cut": written.setdefault(purpose, write(df, purpose)))
    training.train_frame(reviews, 30, 30, named=False)
    assert {"counts", "active"} <= set(written)
    assert written["kept"].columns == ["UserId", "item_index", "Score", "bucket"]
