"""Batch lookup of stored recommendations, with a fallback for users who have none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.activity import activity
from tasteloom.operators.joins import hot_keys, join_unique

# The list served to unknown users when the caller gives none.
DEFAULT_FALLBACK = ["B007JFMCB6", "B000HDOPZG", "B002QWP8H0", "B000KV61FC", "B000N9912G"]


def point_lookup(recs: DataFrame, user_id: str) -> DataFrame:
    """The stored row of one user, or none. The key reaches the file scan as a pushed filter."""
    return recs.where(F.col("UserId") == user_id).limit(1)


def lookup(requests: DataFrame, recs: DataFrame, items: Column, fallback: Sequence[str] = DEFAULT_FALLBACK) -> DataFrame:
    """Add ``recommendations`` (array of product names) to each row of ``requests``.

    ``items`` is the expression on ``recs`` that gives the names. The fallback is for users
    without a row only: a stored list that is empty or unreadable is served as an empty list.
    A user may send any share of the requests; such users are spread over tasks.
    """
    hot = hot_keys(activity(requests, "UserId"), "UserId")
    stored = recs.select("UserId", F.coalesce(items, _names([])).alias("recommendations"))
    found = join_unique(requests, stored, "UserId", "left", hot)
    served = F.coalesce("recommendations", _names(fallback))
    return found.select(*requests.columns, served.alias("recommendations"))


def item_names(recommendations: str = "recommendations") -> Column:
    """Product names of the nested form of a stored list."""
    return F.transform(F.col(recommendations), lambda r: r["ProductId"])


def count_recommendations(recs: DataFrame) -> DataFrame:
    """One row (total_recommendations): users with a stored list."""
    return recs.agg(F.count(F.lit(1)).alias("total_recommendations"))


def _names(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")
