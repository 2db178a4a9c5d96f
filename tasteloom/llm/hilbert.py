"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is cut into cells of about equal row counts, the cells of a row give its place on the
curve, and equal runs of the curve are the shards. Neighbours on the curve are near in every
dimension, so a shard covers a narrow range of each and filters on any of them skip files.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import with_running_sum
from tasteloom.operators.ordering import with_position
from tasteloom.sources.scratch import cut

SHARDS = 16
BITS = 5


def cell_bounds(df: DataFrame, column: str, cells: int) -> list:
    """At most ``cells - 1`` ascending values that cut the non-null rows into even parts.

    Counts are taken over all rows, per distinct value. A value that holds more rows than a part
    is one cell of its own.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    upto = with_running_sum(counts, [F.col(column)], "_n", "_upto")
    total = upto.agg(F.max("_upto")).first()[0]
    if total is None:
        return []
    part = F.floor((F.col("_upto") - 1) * cells / total)
    # The first value of each part: at most one row per cell comes to the driver.
    firsts = upto.groupBy(part.alias("_cell")).agg(F.min(column).alias("_first"))
    return sorted(row["_first"] for row in firsts.collect())[1:]


def cell(column: str, bounds: list) -> Column:
    """Number of bounds at or below the value; nulls go to cell 0."""
    if not bounds:
        return F.lit(0)
    passed = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(passed)


def curve_index(axes: list[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points given by one array of ``bits``-bit numbers per axis.

    Goes from the highest bit down. At each level the point's cell in the current cube is found
    through the reflected Gray code, then the axes are turned into the cube of the next level.
    """
    x = [np.asarray(a, dtype=np.int64).copy() for a in axes]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        mask = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & mask)
            x[0] = np.where(high, x[0] ^ mask, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ turn) >> bit) & 1)
    return index


def hilbert(cells: list[Column], bits: int) -> Column:
    @F.pandas_udf("long")
    def place(*axes: pd.Series) -> pd.Series:
        return pd.Series(curve_index([a.to_numpy() for a in axes], bits))

    return place(*[c.cast("int") for c in cells])


def shard_by_curve(
    df: DataFrame, dimensions: list[str], ties: list[str], shards: int = SHARDS, bits: int = BITS,
) -> DataFrame:
    """``df`` with (curve, shard, slot): shards of equal row counts along the curve.

    ``dimensions``: metadata columns, of any type that can be compared. ``ties``: columns that order
    rows of one cell; rows equal in them are interchangeable. Row counts of shards differ by one at
    most; ``slot`` counts from 0 within a shard. Nulls count as the lowest cell of their dimension,
    an empty table gives no rows. ``df`` is sorted as it is: give it without wide columns, and join
    the result to the texts by key or write it with them.
    """
    df = cut(df, "to-shard")
    axes = [cell(d, cell_bounds(df, d, 1 << bits)) for d in dimensions]
    total = df.count()
    placed = with_position(
        df.withColumn("curve", hilbert(axes, bits)), [F.col("curve"), *[F.col(t) for t in ties]], "_at"
    )
    # Whole-number division keeps the cuts exact at any size.
    shard = F.expr(f"int(_at * {shards}L div {max(total, 1)}L)")
    first = F.expr(f"({max(total, 1)}L * shard + {shards - 1}) div {shards}L")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("_at") - first).drop("_at")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order, so that file statistics are narrow."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
