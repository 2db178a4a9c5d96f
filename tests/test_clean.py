import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tasteloom.operators.clean import clean_nulls, dedup_latest, dedup_pairs
from tasteloom.sources.schemas import as_ratings

SCHEMA = "UserId string, ProductId string, Score float, Time long, Id long"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

ROWS = [("u1", "a", 5.0, 10, 1), ("u1", "a", 3.0, 20, 2), ("u1", "a", 4.0, 20, 3), ("u2", "a", 1.0, None, 4)]
reviews = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3"]), st.sampled_from("ab"), st.sampled_from([1.0, 2.0, 5.0]),
        st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5),
    ),
    min_size=1, max_size=25,
)


def test_latest_wins_with_ties(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = {("u1", "a", 4.0, 20, 3), ("u2", "a", 1.0, None, 4)}
    assert {tuple(r) for r in dedup_latest(df).collect()} == want
    assert {tuple(r) for r in dedup_pairs(df).collect()} == {("u1", "a", 4.0), ("u2", "a", 1.0)}


def test_pairs_without_time_take_the_best_score(spark):
    df = spark.createDataFrame([("u", "a", 2.0), ("u", "a", 4.0)], "UserId string, ProductId string, Score float")
    assert [tuple(r) for r in dedup_pairs(df).collect()] == [("u", "a", 4.0)]


def test_bad_values_are_dropped_without_an_error(spark):
    rows = [
        (None, "a", "1"), ("u", None, "1"), ("u", "a", None), ("u", "a", "NaN"), ("u", "a", "abc"), ("u", "a", "4.5"),
    ]
    df = spark.createDataFrame(rows, "UserId string, ProductId string, Score string")
    assert [tuple(r) for r in clean_nulls(as_ratings(df)).collect()] == [("u", "a", 4.5)]


@FEW
@given(reviews)
def test_dedup_is_idempotent_and_ignores_row_order(spark, rows):
    def latest(some):
        return sorted(map(tuple, dedup_latest(spark.createDataFrame(some, SCHEMA)).collect()), key=repr)

    def newest(row):
        return (-math.inf if row[3] is None else row[3], row[2], row[4])

    once = latest(rows)
    want = {}
    for row in rows:
        pair = row[:2]
        if pair not in want or newest(row) > newest(want[pair]):
            want[pair] = row
    assert once == sorted(want.values(), key=repr)
    assert latest(list(reversed(rows))) == once
    assert latest(once) == once


def test_pairs_neither_read_nor_compare_ids(spark):
    rows = [("u", "a", 1.0, 5, 9), ("u", "a", 3.0, 5, 1), ("u", "a", 9.0, 4, 99), ("u", "b", 2.0, None, 7), ("u", "b", 1.0, 0, 1)]
    df = spark.createDataFrame(rows, "UserId string, ProductId string, Score float, Time long, Id long")
    pairs = dedup_pairs(df)
    assert sorted(map(tuple, pairs.collect())) == [("u", "a", 3.0), ("u", "b", 1.0)]
    boom = df.withColumn("Id", F.raise_error(F.lit("read")).cast("long"))
    assert sorted(map(tuple, dedup_pairs(boom).collect())) == [("u", "a", 3.0), ("u", "b", 1.0)]
