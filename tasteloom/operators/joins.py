"""Joins against a side that is unique on the key, safe when few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 2_000_000
# No more than this many keys can hold a share of all rows that is large enough to be spread.
SHARES = 10_000


def hot_keys(counts: DataFrame, key: str, rows: str = "n", per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, _parts) of the keys in ``counts`` too large for one task.

    A key is too large with more than ``per_task`` rows and more than one in SHARES of all rows. So
    the list is shorter than SHARES by construction, and what it leaves out is a ten-thousandth at most.
    """
    share = F.ceil(F.sum(rows) / SHARES)
    bound = F.greatest(F.lit(per_task), counts.agg(share.alias("share")).scalar())
    return counts.where((F.col(rows) > bound) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col(rows) / bound).cast("int").alias("_parts")
    )


def join_unique(
    df: DataFrame, dim: DataFrame, key: str, how: str, hot: DataFrame,
    drop: str | None = None,
) -> DataFrame:
    """``df.join(dim, key, how)`` for ``dim`` unique on ``key``; inner, left or left_semi.

    Rows of a hot key get one of ``_parts`` part numbers, and the one matching ``dim`` row is
    repeated once per part. Rows without a key match nothing and are spread the same way.
    ``hot`` is shorter than SHARES and is broadcast; where it is empty at run time the
    plan is an ordinary equi-join. A small ``dim`` is broadcast by the planner, from its true size.
    ``drop`` names a column of ``dim`` that is not in the result.
    """
    hot = F.broadcast(hot)
    # From the row and its partition only, so that a task run again gives each row the same
    # part; the partition number spreads equal rows. Rows of ordinary keys need no hash.
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    parts = F.when(F.col(key).isNull(), F.lit(SHARES)).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.when(parts > 1, F.pmod(row_hash, parts)).otherwise(0).cast("int")
    left = df.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    right = dim.join(hot, key, "left").withColumn("_part", _each_part(F.coalesce("_parts", F.lit(1))))
    right = right.drop("_parts", *([drop] if drop else []))
    return left.join(right, [key, "_part"], how).drop("_part")


def _each_part(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))
