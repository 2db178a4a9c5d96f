"""The physical plans are the ones meant."""

from pyspark.sql import functions as F

from tasteloom.operators import activity, clean, serve, topn
from tasteloom.sources import recstore
from tasteloom.sources.replay import parse_messages
from tasteloom.sources.scratch import scratch_dir
from workload import tables


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_dedup_cuts_each_task_to_one_row_per_pair(spark, sf):
    text = plan(clean.dedup_latest(tables.reviews(spark, sf)))
    assert "partial_max(struct(Time" in text and "Window" not in text


def test_top_n_cuts_each_task_to_n_rows_per_user(spark, sf):
    scored = tables.reviews(spark, sf).selectExpr("UserId AS user_index", "ProductId AS item_index", "Score AS score")
    text = plan(topn.keep_topn(scored, 5))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_activity_filter_is_a_semi_join(spark, sf):
    text = plan(activity.min_activity(tables.reviews(spark, sf), "UserId", 5))
    assert "LeftSemi" in text and "BatchEvalPython" not in text and "CartesianProduct" not in text


def test_small_sides_are_not_shuffled_at_run_time(spark, sf):
    df = activity.min_activity(tables.reviews(spark, sf), "UserId", 5)
    df.count()
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "isFinalPlan=true" in final and "SortMergeJoin" not in final
    assert "TakeOrderedAndProject" not in final.split("BroadcastHashJoin")[0]


def test_only_needed_columns_are_read(spark, sf):
    text = plan(activity.popular_products(tables.reviews(spark, sf)))
    assert "TakeOrderedAndProject" in text
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in text and "struct<o_orderkey:bigint>" in text


def test_messages_are_parsed_once(spark, sf):
    assert plan(parse_messages(tables.dirty_messages(spark, sf))).count("from_json(") == 1


def test_point_lookup_filter_reaches_the_files(spark):
    path, snap = scratch_dir(spark, "store"), scratch_dir(spark, "snapshot")
    rows = spark.range(20).select(F.col("id").cast("string").alias("UserId"), F.expr("array(struct('p' AS ProductId, 1D AS score))").alias("recommendations"))
    recstore.write_batch(rows, path, 0, 0)
    recs = recstore.latest(recstore.history(spark, path))
    assert "EqualTo(UserId,7)" in plan(serve.point_lookup(recs, "7"))
    recstore.write_snapshot(recs, snap, 8)
    text = plan(recstore.snapshot_lookup(spark, snap, "7", 8))
    assert "EqualTo(UserId,7)" in text and "PartitionFilters: [isnotnull(bucket" in text
