import datetime as dt
import math

import numpy as np
import pytest

from tasteloom.operators import metrics


def test_rates_of_overlapping_windows(spark):
    times = ["2024-01-01 00:00:30", "2024-01-01 00:01:10", "2024-01-01 00:01:50"]
    df = spark.sql(" UNION ALL ".join(f"SELECT TIMESTAMP_NTZ'{t}' AS ts, 'h' AS handler" for t in times))
    got = {r["window_start"].strftime("%H:%M"): (r["n"], r["per_second"])
           for r in metrics.rate_by(df, "ts", "handler", 120, 60).collect()}
    assert got == {"23:59": (1, 1 / 120), "00:00": (3, 3 / 120), "00:01": (2, 2 / 120)}
    with pytest.raises(ValueError):
        metrics.rate_by(df, "ts", "handler", 100, 60)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris"])
def test_windows_do_not_move_with_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 05:30:00' AS ts, 'h' AS handler")
        both = [df, df.selectExpr("CAST(ts AS TIMESTAMP) AS ts", "handler")]
        starts = [metrics.rate_by(d, "ts", "handler", 3600).first()["window_start"] for d in both]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert starts == [dt.datetime(2024, 1, 1, 5)] * 2


def quantile(spark, values, q, bounds=(1.0, 2.0, 4.0)):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = metrics.histogram_quantile(metrics.histogram(df, "v", [], bounds), q, [], bounds).collect()
    return rows[0]["quantile"]


def test_histogram_quantile(spark):
    assert quantile(spark, [1.5] * 10, 0.5) == pytest.approx(1.5)
    assert quantile(spark, [0.5] * 4 + [3.0] * 4, 0.75) == pytest.approx(3.0)
    assert quantile(spark, [0.5] * 4, 0.5) == pytest.approx(0.5)
    assert quantile(spark, [9.0] * 4, 0.5) == 4.0
    assert quantile(spark, [1.0, 2.0, 4.0], 1.0) == 4.0
    assert quantile(spark, [-3.0] * 4, 0.5, (-1.0, 2.0)) == -1.0


@pytest.mark.parametrize("q", [0.0, 0.37, 0.99, 1.0])
def test_exact_quantile_of_skewed_groups(spark, q):
    rng = np.random.default_rng(5)
    data = {"hot": np.concatenate([np.full(400, 7.0), rng.exponential(5, 300)]), "one": [3.0], "two": [1.0, 2.0]}
    rows = [(g, float(v)) for g, values in data.items() for v in values] + [("hot", None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, v double").repartition(4)
        got = {r["g"]: r["quantile"] for r in metrics.exact_quantile(df, "v", q, "g").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == pytest.approx({g: np.quantile(values, q) for g, values in data.items()})


def test_gauge_sum_matches_whole_names(spark):
    rows = [("spark-1", "c1", 1, 5.0), ("spark-1", "c1", 2, 7.0), ("spark-1", "c2", 1, 1.0), ("my-spark", "c1", 1, 9.0)]
    df = spark.createDataFrame(rows, "pod string, container string, t int, v double")
    got = metrics.gauge_sum(df, "pod", ["container"], "v", ["t"], "airflow.*|kafka.*|spark.*")
    assert [tuple(r) for r in got.collect()] == [("spark-1", 8.0)]
    assert not math.isnan(got.first()["total"])


def test_stream_windows_ignore_the_session_zone(spark, tmp_path):
    """02:30 does not exist in New York on that day; it must not share a window with 03:30."""
    rows = spark.sql("""SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00', 'a'),
        (TIMESTAMP_NTZ'2024-03-10 03:30:00', 'a'), (TIMESTAMP_NTZ'2024-03-10 06:30:00', 'a') AS t(ts, who)""")
    rows.write.parquet(str(tmp_path / "in"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        counts = metrics.stream_rate_by(stream, "ts", "who", "1 hour", "0 seconds")
        query = counts.writeStream.format("memory").queryName("zones").outputMode("complete").start()
        query.processAllAvailable()
        query.stop()
        got = {(str(r["window_start"]), r["n"]) for r in spark.table("zones").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {("2024-03-10 02:00:00", 1), ("2024-03-10 03:00:00", 1), ("2024-03-10 06:00:00", 1)}
