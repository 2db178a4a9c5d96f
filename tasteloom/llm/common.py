"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasteloom.operators.ordering import sorted_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_bytes(text: str) -> Column:
    """Length of a text in UTF-8 bytes, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def id_hash(column: str) -> Column:
    """crc32 of a number written as text, 0 to 2**32 - 1; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def with_running_sum(df: DataFrame, order: list[Column], weight: str, name: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to and including this one in the order.

    The rows are sorted by ranges; a window runs within each range, and one row per range gives
    what lies before it.
    """
    ranged = sorted_table(df, order)
    sums = ranged.groupBy("_part").agg(F.sum(weight).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.sum(weight).over(within)).alias(name)
    )
