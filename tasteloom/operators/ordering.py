"""Positions in a total order, computed by range partitions instead of one sorted task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.sources.scratch import cut

# monotonically_increasing_id() holds the partition number above these 33 bits.
ROW_BITS = 33


def sorted_table(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted, plus (_part, _row): its place in that layout.

    The result is written out, because the range boundaries are sampled: a second evaluation
    could cut the ranges elsewhere and give a row another place.
    """
    placed = df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id())
    return cut(placed, "sorted").select(
        *df.columns,
        F.shiftright("__place", ROW_BITS).alias("_part"),
        F.col("__place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``."""
    table = sorted_table(df, order)
    # One row per partition of the sort: the window below and the broadcast are that small.
    sizes = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return table.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias(name)
    )


def with_neighbour(df: DataFrame, series: Sequence[str], order: Sequence[Column], take: Sequence[str], name: str, after: bool = False) -> DataFrame:
    """Add the struct ``name`` of the columns ``take`` of the row before in the same series, or ``after`` it.

    The first row of a series, or the last, has null. Rows are range-partitioned by series and order, so a series of any
    length is spread over tasks; one row per partition tells the neighbours on either side of a cut.
    """
    table = sorted_table(df, [*[F.col(c) for c in series], *order]).withColumn(
        "_own", F.struct(F.struct(*series).alias("series"), F.struct(*take).alias("taken"))
    )
    step, pick = (F.lead, F.min_by) if after else (F.lag, F.max_by)
    # At most one row per partition of the sort.
    edges = table.groupBy("_part").agg(pick("_own", "_row").alias("_edge"))
    edges = edges.select("_part", step("_edge").over(Window.orderBy("_part")).alias("_edge"))
    within = Window.partitionBy("_part").orderBy("_row")
    near = table.withColumn("_near", step("_own").over(within)).join(F.broadcast(edges), "_part")
    found = F.coalesce("_near", "_edge")
    same = found["series"].eqNullSafe(F.col("_own")["series"])
    return near.select(*df.columns, F.when(same, found["taken"]).alias(name))
