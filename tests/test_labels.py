import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tasteloom.operators.labels import apply_labels, fit_labels, known_only
from tasteloom.operators.ordering import with_position
from workload import tables

NAMES = [("u1",), ("u1",), ("u2",), ("u2",), ("u3",), ("u0",)]
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def labels(spark):
    return fit_labels(spark.createDataFrame(NAMES, "UserId string"), "UserId")


def test_order(labels):
    assert {r["label"]: r["idx"] for r in labels.collect()} == {"u1": 0, "u2": 1, "u0": 2, "u3": 3}


def test_unseen_names(spark, labels):
    asked = spark.createDataFrame([("u3",), ("new",), (None,)], "UserId string")
    keep = {tuple(r) for r in apply_labels(asked, "UserId", labels, "i", "keep").collect()}
    assert keep == {("u3", 3.0), ("new", 4.0), (None, 4.0)}
    skip = [tuple(r) for r in apply_labels(asked, "UserId", labels, "i", "skip").collect()]
    assert skip == [("u3", 3.0)]
    with pytest.raises(Exception, match="no index for"):
        apply_labels(asked, "UserId", labels, "i", "error").collect()
    with pytest.raises(ValueError):
        apply_labels(asked, "UserId", labels, "i", "other")


def test_same_numbers_as_string_indexer(spark, sf):
    reviews = tables.reviews(spark, sf)
    model = StringIndexer(inputCol="ProductId", outputCol="i").fit(reviews)
    ours = fit_labels(reviews, "ProductId").orderBy("idx").select("label").collect()
    assert [r[0] for r in ours] == list(model.labels)


def test_known_only(spark, labels):
    asked = spark.createDataFrame([("u1",), ("u2",), ("u0",), ("new",)], "UserId string")
    factors = spark.createDataFrame([(0,), (2,)], "id int")
    known = known_only(apply_labels(asked, "UserId", labels, "user_index"), "user_index", factors)
    assert sorted(map(tuple, known.collect())) == [("u0", 2.0), ("u1", 0.0)]


def test_positions_over_many_sort_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("v"))
        table = with_position(df, [F.col("v").desc()])
        rows = table.orderBy("position").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["position"] for r in rows] == list(range(5000))
    values = [r["v"] for r in rows]
    assert values == sorted(values, reverse=True)


@FEW
@given(st.lists(st.sampled_from(["a", "b", "c", "é", "", "zz"]), min_size=1, max_size=30))
def test_index_is_a_bijection(spark, names):
    rows = fit_labels(spark.createDataFrame([(n,) for n in names], "x string"), "x").collect()
    assert sorted(r["idx"] for r in rows) == list(range(len(set(names))))
    assert {r["label"]: r["n"] for r in rows} == {n: names.count(n) for n in names}
