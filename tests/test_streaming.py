import json
import os

import pytest
from pyspark.sql import functions as F

from tasteloom.plans.bundle import Bundle
from tasteloom.sources import recstore, registry
from tasteloom.sources.replay import read_feed
from tasteloom.sources.scratch import scratch_dir
from tasteloom.streaming import recommender
from tasteloom.streaming.models import ModelCache, NoModel

ONCE = {"availableNow": True}


class Site:
    """A feed, a store and a table of runs, all empty."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.runs, self.store, self.offsets = (scratch_dir(spark, p) for p in ("runs", "store", "offsets"))
        self.feed = folder / "feed"
        self.feed.mkdir()
        self.files = 0

    def send(self, *users):
        lines = [json.dumps({"UserId": u, "ProductId": "p", "Score": 1.0, "Time": 1}) if u else "garbage" for u in users]
        self.files += 1
        file = self.feed / f"{self.files:03d}.txt"
        file.write_text("\n".join(lines))
        # The source takes files by age; files of one millisecond would come in any order.
        os.utime(file, (1_700_000_000 + self.files,) * 2)

    def publish(self, version, *products):
        """A model of users a, b, c that ranks ``products`` in this order for everyone."""
        def table(rows, schema):
            return self.spark.createDataFrame(rows, schema)

        path = scratch_dir(self.spark, "model")
        Bundle(
            table([(u, i, 1) for i, u in enumerate("abc")], "label string, idx int, n long"),
            table([(p, i, 1) for i, p in enumerate(products)], "label string, idx int, n long"),
            table([(i, [1.0]) for i in range(3)], "id int, features array<float>"),
            table([(i, [float(len(products) - i)]) for i in range(len(products))], "id int, features array<float>"),
        ).save(path)
        registry.create_if_missing(self.spark, self.runs)
        row = (registry.MODEL_NAME, version, "None", 1, 0.1, 1.0, 1.0, path)
        registry.append(self.spark.createDataFrame([row], registry.RUNS), self.runs)

    def models(self, **options):
        options = {"load": lambda s, p: Bundle.load(s, p, is_als=False), "check_every": 0} | options
        return ModelCache(self.spark, self.runs, **options)

    def run(self, models):
        source = read_feed(self.spark, str(self.feed), files_per_trigger=1)
        query = recommender.start_recommender(source, models, self.store, self.offsets, top_n=2, trigger=ONCE)
        query.awaitTermination()

    def stored(self):
        rows = recstore.latest(recstore.history(self.spark, self.store)).collect()
        return {r["UserId"]: "".join(x["ProductId"] for x in r["recommendations"]) for r in rows}

    def batches(self):
        rows = recstore.history(self.spark, self.store).groupBy("batch_id").agg(F.count(F.lit(1))).collect()
        return {r[0]: r[1] for r in rows}


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def test_known_users_of_each_batch(site):
    site.publish(1, "x", "y", "z")
    site.send("a", "a", "stranger", None)
    site.send("stranger")
    site.send("b", "a")
    site.send(None)
    site.run(site.models())
    assert site.stored() == {"a": "xy", "b": "xy"}
    assert site.batches() == {0: 1, 2: 2}


def test_restart_continues_and_a_new_model_is_used(site):
    site.publish(1, "x", "y", "z")
    site.send("a", "b")
    models = site.models()
    site.run(models)
    site.publish(2, "q", "r")
    site.send("b", "c")
    site.run(models)
    assert models.version == 2
    assert site.stored() == {"a": "xy", "b": "qr", "c": "qr"}
    assert site.batches() == {0: 2, 1: 2}


def test_a_failed_batch_is_run_again(site, monkeypatch):
    site.publish(1, "x", "y", "z")
    site.send("a")
    site.send("b")
    write = recstore.write_batch

    def fail_on_second(recs, path, run_seq, batch_id):
        write(recs, path, run_seq, batch_id)
        if batch_id == 1:
            raise OSError("disk gone")

    monkeypatch.setattr(recstore, "write_batch", fail_on_second)
    with pytest.raises(Exception, match="disk gone"):
        site.run(site.models())
    monkeypatch.setattr(recstore, "write_batch", write)
    site.send("c")
    site.run(site.models())
    assert site.stored() == {"a": "xy", "b": "xy", "c": "xy"}
    assert site.batches() == {0: 1, 1: 1, 2: 1}


def test_model_checks_are_rare_and_survive_failures(site):
    now, broken = [0.0], [False]

    def load(spark, path):
        if broken[0]:
            raise OSError("no such folder")
        return Bundle.load(spark, path, is_als=False)

    site.publish(1, "x")
    models = site.models(check_every=3600, clock=lambda: now[0], load=load)
    first = models.current()
    site.publish(2, "y")
    now[0] = 3599.0
    assert models.current() is first and models.version == 1
    broken[0], now[0] = True, 3600.0
    assert models.current() is first and models.version == 1
    broken[0], now[0] = False, 7000.0
    assert models.current() is first
    now[0] = 7200.0
    assert models.current() is not first and models.version == 2


def test_start_without_a_model_fails(site):
    registry.create_if_missing(site.spark, site.runs)
    with pytest.raises(NoModel):
        site.models()
    assert recommender.TRIGGER == {"processingTime": "120 seconds"}
