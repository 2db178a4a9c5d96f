"""Row cleaning and duplicate removal on a ratings log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.sources.schemas import RATING_COLUMNS, require_columns

PAIR = ["UserId", "ProductId"]
NEWEST = ["Time", "Score", "Id"]


def clean_nulls(df: DataFrame, columns: Sequence[str] = RATING_COLUMNS) -> DataFrame:
    """Drop rows with a NULL, or a NaN score, in one of ``columns``."""
    return require_columns(df, columns).dropna(subset=list(columns))


def dedup_latest(df: DataFrame, keys: Sequence[str] = PAIR, newest: Sequence[str] = NEWEST) -> DataFrame:
    """Keep one row per key: the greatest in ``newest``, by default the latest review of a pair,
    then the best score, then the highest id. NULL counts as the smallest.

    The rank-1 row of a window, written as the greatest struct per key: tasks reduce their rows
    before the shuffle, so a pair repeated any number of times sends one row per task, and
    rows are sorted by the key alone. Remaining columns break remaining ties.
    """
    first = [c for c in newest if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in first]
    row = df.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("_row"))
    return row.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def dedup_pairs(df: DataFrame) -> DataFrame:
    """One (UserId, ProductId, Score) per pair: the score of the latest review.

    Without a ``Time`` the survivor is the best score, so that the result does not depend
    on the order in which rows arrive. Rows that tie in both differ in their ``Id`` alone, which
    is not in the result: it is neither read nor shuffled.
    """
    return dedup_latest(df.select(*[c for c in df.columns if c in (*PAIR, "Time", "Score")])).select(*PAIR, "Score")
