"""Counts per user or item, and minimum-activity filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.joins import ROWS_PER_TASK, hot_keys, join_unique


def activity(df: DataFrame, key: str) -> DataFrame:
    """(key, n): rows per key, pre-aggregated before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def min_activity(
    df: DataFrame, key: str, at_least: int, per_task: int = ROWS_PER_TASK, counts: DataFrame | None = None
) -> DataFrame:
    """Rows whose key occurs ``at_least`` times in ``df``.

    ``counts`` is ``activity(df, key)`` as a written table: it is then not counted anew for each use, and the planner
    knows its size.
    """
    counts = activity(df, key) if counts is None else counts
    active = counts.where(F.col("n") >= at_least)
    hot = hot_keys(counts, key, per_task=per_task)
    return join_unique(df, active, key, "left_semi", hot, "n").select(*df.columns)


def filter_users_then_items(df: DataFrame, users: int = 5, items: int = 5) -> DataFrame:
    """Drop rare users, then items rare among the rows that are left.

    Two passes, not a fixpoint: a user may end up below the threshold again when rare items go.
    """
    return min_activity(min_activity(df, "UserId", users), "ProductId", items)


def popular_products(ratings: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most rated products (ProductId, n), ties by name."""
    return activity(ratings, "ProductId").orderBy(F.col("n").desc(), "ProductId").limit(k)


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select("UserId").distinct()
