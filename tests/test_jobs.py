"""The jobs one after the other, on files: replay, train, recommend, snapshot, preprocess."""

import jobs
from tasteloom.plans import training
from tasteloom.sources import recstore
from tasteloom.sources.reviews import read_csv, write_csv
from workload import tables


def test_stream_limits_are_arguments():
    base = ["recommend", "--servers", "h:9092", "--runs", "r", "--store", "s", "--checkpoint", "c"]
    a = jobs.arguments(base)
    assert (a.max_offsets, a.allow_data_loss, a.trigger) == (None, False, 120)
    a = jobs.arguments([*base, "--max-offsets", "50", "--allow-data-loss", "--trigger", "5"])
    assert (a.max_offsets, a.allow_data_loss, a.trigger) == (50, True, 5)


def test_from_reviews_to_lookup(spark, tmp_path):
    path = {name: str(tmp_path / name) for name in (
        "reviews", "feed", "models", "runs", "store", "offsets", "snapshot", "csv")}
    reviews = tables.reviews(spark, "/root/testdata/sf0.001")
    write_csv(reviews, path["reviews"])

    jobs.main(["replay", "--reviews", path["reviews"], "--feed", path["feed"]])
    jobs.main(["train", "--reviews", path["reviews"], "--models", path["models"], "--runs", path["runs"],
               "--ranks", "4", "--reg-params", "0.1"])
    jobs.main(["recommend", "--feed", path["feed"], "--runs", path["runs"], "--store", path["store"],
               "--checkpoint", path["offsets"], "--once", "--top-n", "3"])
    jobs.main(["compact", "--store", path["store"], "--drop"])
    jobs.main(["snapshot", "--store", path["store"], "--out", path["snapshot"], "--buckets", "4"])

    replayed = {r["UserId"] for r in reviews.where("pmod(Id, 10) >= 6").select("UserId").collect()}
    stored = {r["UserId"]: len(r["recommendations"]) for r in recstore.current(spark, path["store"]).collect()}
    assert set(stored) <= replayed and len(stored) > 0.9 * len(replayed)
    assert set(stored.values()) == {3}
    user = sorted(stored)[0]
    assert recstore.snapshot_lookup(spark, path["snapshot"], user).count() == 1

    jobs.main(["preprocess", "--reviews", path["reviews"], "--out", path["csv"]])
    frame = training.preprocess(reviews).ratings
    again = read_csv(spark, path["csv"], frame.schema)
    assert again.exceptAll(frame).isEmpty() and again.count() == frame.count()
