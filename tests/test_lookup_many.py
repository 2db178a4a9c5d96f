import pytest
from pyspark.sql import functions as F

from tasteloom.sources import bucketstore

USERS = 60_000


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Names u00000 and on in 8 buckets of files of 500; every seventh was written again."""
    path = str(tmp_path_factory.mktemp("store") / "recs")
    rows = spark.range(USERS).select("id", F.format_string("u%05d", "id").alias("UserId"))
    lists = rows.withColumn("recommendations", F.array(F.struct(F.lit("a").alias("ProductId"), F.col("id").cast("double").alias("score"))))
    bucketstore.upsert(lists, path, 8, 500)
    again = lists.where("id % 7 = 0 AND id < 700").withColumn("recommendations", F.expr("transform(recommendations, r -> struct('b' AS ProductId, r.score AS score))"))
    bucketstore.upsert(again, path, rows_per_file=500)
    return path


def scanned(df):
    """Rows that left the file scans of a plan that has run."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    text, found = [], [df.collect()]
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            text.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return text, found[0]


def test_files_are_listed_and_do_not_overlap(spark, store):
    rows = bucketstore.files(spark, store).orderBy("bucket", "low").collect()
    assert sum(r["n"] for r in rows) == USERS and max(r["n"] for r in rows) <= 500 and len(rows) >= USERS / 500
    for a, b in zip(rows, rows[1:]):
        assert a["bucket"] < b["bucket"] or a["high"] < b["low"]


def test_thousands_of_users_read_few_rows(spark, store):
    asked = spark.range(20_000, 22_000).select(F.format_string("u%05d", "id").alias("UserId"))
    # 2,000 of 60,000: their files hold little more, two half-used ones a bucket.
    found = bucketstore.lookup_many(asked, store)
    read, rows = scanned(found)
    assert sorted(r["UserId"] for r in rows) == [f"u{i:05d}" for i in range(20_000, 22_000)]
    assert 2_000 <= max(read) <= 2_000 + 8 * 2 * 500


def test_unknown_missing_and_repeated_users(spark, store):
    asked = [("u00007",), ("u00007",), ("u00008",), (None,), ("",), ("a",), ("u00008x",), ("zz",)]
    found = bucketstore.lookup_many(spark.createDataFrame(asked, "UserId string"), store).collect()
    assert {r["UserId"]: r["recommendations"][0]["ProductId"] for r in found} == {"u00007": "b", "u00008": "a"} and len(found) == 2
    nobody = spark.createDataFrame([("",), ("zz",), (None,)], "UserId string")
    assert bucketstore.lookup_many(nobody, store).collect() == []
    assert bucketstore.lookup_many(nobody, store + "-none").collect() == [] and bucketstore.files(spark, store + "-none").count() == 0


def test_one_user_is_found_by_the_filters_of_the_file(spark, store):
    read, rows = scanned(bucketstore.lookup(spark, store, "u30001"))
    assert len(rows) == 1 and sum(read) <= 500
    # Lies within the range of a row group, but the filter of that row group knows it is not there.
    read, rows = scanned(bucketstore.lookup(spark, store, "u30001x"))
    assert rows == [] and sum(read) == 0


def test_the_list_survives_vacuum(spark, store):
    bucketstore.vacuum(spark, store)
    assert bucketstore.lookup_many(spark.createDataFrame([("u00007",), ("u59999",)], "UserId string"), store).count() == 2
