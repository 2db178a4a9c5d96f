from collections import Counter

from pyspark.sql import functions as F

from tasteloom.operators.activity import activity, filter_users_then_items, min_activity, popular_products
from tasteloom.operators.joins import hot_keys, join_unique
from tasteloom.operators.labels import apply_labels, fit_labels

SCHEMA = "UserId string, ProductId string, Score float"


def test_two_passes_not_a_fixpoint(spark):
    # u1 has two ratings, one of an item nobody else rates: it stays with one rating.
    rows = [("u1", "a", 1.0), ("u1", "rare", 1.0), ("u2", "a", 1.0), ("u2", "b", 1.0), ("u3", "a", 1.0), ("u3", "b", 1.0)]
    kept = filter_users_then_items(spark.createDataFrame(rows, SCHEMA), 2, 2)
    assert sorted((r[0], r[1]) for r in kept.collect()) == [
        ("u1", "a"), ("u2", "a"), ("u2", "b"), ("u3", "a"), ("u3", "b")]
    assert kept.columns == ["UserId", "ProductId", "Score"]


def skewed(spark):
    """A third of the rows on one user, all of them equal; some rows without a user."""
    ids = spark.range(900, numPartitions=6)
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("u"), F.col("id") % 40))
    item = F.when(F.col("id") % 3 == 0, F.lit("p")).otherwise((F.col("id") % 7).cast("string"))
    return ids.select(user.alias("UserId"), item.alias("ProductId"), F.lit(1.0).cast("float").alias("Score"))


def test_hot_keys_are_spread_and_keep_every_row(spark):
    df = skewed(spark)
    counts = Counter(r[0] for r in df.collect())
    want = sorted(((r[0], r[1]) for r in df.collect() if r[0] and counts[r[0]] >= 20))
    for per_task in (10, 100, 10**6):
        got = min_activity(df, "UserId", 20, per_task=per_task)
        assert sorted((r[0], r[1]) for r in got.collect()) == want
    parts = hot_keys(activity(df, "UserId"), "UserId", per_task=100).collect()
    assert [tuple(r) for r in parts] == [("hot", 3)]


def test_spread_rows_reach_several_tasks(spark):
    df = skewed(spark).repartition(6)
    hot = hot_keys(activity(df, "UserId"), "UserId", per_task=10)
    dim = activity(df, "UserId")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = join_unique(df, dim, "UserId", "left", hot)
        where = joined.where("UserId = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(where) > 1 and sum(r[1] for r in where) == 300


def test_labels_of_a_hot_name(spark, monkeypatch):
    df = skewed(spark)
    labels = fit_labels(df, "UserId").withColumn("n", F.col("n") * 10**6)
    got = apply_labels(df, "UserId", labels, "i").groupBy("UserId", "i").count().collect()
    counts = Counter(r[0] for r in df.collect())
    order = sorted((u for u in counts if u), key=lambda u: (-counts[u], u))
    want = {(u, float(i), counts[u]) for i, u in enumerate(order)} | {(None, float(len(order)), counts[None])}
    assert {tuple(r) for r in got} == want


def test_popular_ties_by_name(spark):
    rows = [("u", p, 1.0) for p in "bbaac"]
    assert [tuple(r) for r in popular_products(spark.createDataFrame(rows, SCHEMA), 2).collect()] == [("a", 2), ("b", 2)]
