import json
import os

import pytest
from pyspark.sql import functions as F

from tasteloom.sources import recstore
from tasteloom.sources.replay import read_feed
from tasteloom.sources.scratch import scratch_dir
from tasteloom.streaming import recommender
from tasteloom.streaming.presence import due_users
from tests.test_streaming import ONCE, Site

SCHEMA = "UserId string, Time long"


def fed(spark, batches, period, lateness):
    """The due (user, tick) after each batch, the query being started again for each."""
    feed, path, offsets = (scratch_dir(spark, p) for p in ("feed", "due", "offsets"))
    told, before = [], set()
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(feed)
        due = due_users(spark.readStream.schema(SCHEMA).parquet(feed), period, lateness)
        writer = due.writeStream.format("parquet").option("path", path).option("checkpointLocation", offsets)
        writer.trigger(**ONCE).start().awaitTermination()
        now = sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
        assert len(now) == len(set(now))
        told.append(set(now) - before)
        before = set(now)
    return told


def test_once_a_period_over_batches_and_restarts(spark):
    told = fed(spark, [
        [("a", 100), ("a", 130), ("b", 159), ("a", 165), ("a", 100), (None, 100)],
        [("a", 219), ("b", 170), ("b", 218), ("c", 300)],
        [("b", 219), ("a", 290), ("c", 250)],  # b and c are late, but not too late
        [("d", 5000)],
        [("a", 5001), ("b", 5060), ("d", 5059)],
    ], period=60, lateness=200)
    assert told == [
        {("a", 100), ("b", 159), ("a", 165)},
        {("c", 300)},
        {("b", 219), ("a", 290)},
        {("d", 5000)},
        {("a", 5001), ("b", 5060)},
    ]


def test_ticks_and_missing_times(spark):
    told = fed(spark, [[("a", 3599), ("a", None), (None, None)], [("a", 7199), ("a", 7200)], []], period=3600, lateness=10_000)
    assert told == [{("a", 3540), ("a", None)}, {("a", 7140)}, set()]


def test_events_behind_the_watermark_are_left_out(spark):
    told = fed(spark, [[("a", 1000)], [("b", 100)], [("c", 995)]], period=60, lateness=10)
    assert told == [{("a", 1000)}, set(), {("c", 995)}]


def test_bounds(spark):
    with pytest.raises(ValueError):
        due_users(spark.createDataFrame([], SCHEMA), 0)


def test_the_recommender_scores_a_user_once_a_period(spark, tmp_path):
    site = Site(spark, tmp_path)
    site.publish(1, "p", "q")
    models = site.models()

    def run(*events):
        site.files += 1
        file = site.feed / f"{site.files:03d}.txt"
        file.write_text("\n".join(json.dumps({"UserId": u, "ProductId": "p", "Score": 1.0, "Time": at}) for u, at in events))
        os.utime(file, (1_700_000_000 + site.files,) * 2)
        source = read_feed(spark, str(site.feed), files_per_trigger=1)
        recommender.start_recommender(source, models, site.store, site.offsets, 2, trigger=ONCE, once_per=60, lateness=600).awaitTermination()
        rows = recstore.history(spark, site.store).groupBy("UserId").agg(F.count(F.lit(1)).alias("n")).collect()
        return {r["UserId"]: r["n"] for r in rows}

    assert run(("a", 100), ("b", 110)) == {"a": 1, "b": 1}
    assert run(("a", 120), ("b", 175), ("nobody", 175)) == {"a": 1, "b": 2}
    assert run(("a", 161), ("b", 176)) == {"a": 2, "b": 2}
