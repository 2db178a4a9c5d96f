"""Dense integer indices for user and item names, kept as a table (label, idx, n)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.activity import activity
from tasteloom.operators.joins import hot_keys, join_unique
from tasteloom.operators.ordering import with_position
from tasteloom.sources.scratch import cut

MAX_INDEX = 2**31 - 1


def fit_labels(df: DataFrame, column: str, at_least: int = 1) -> DataFrame:
    """Index of each name in ``column``: the most frequent is 0, ties in name order.

    The same numbers as a fitted StringIndexer, but the names stay in a distributed table;
    nothing is collected. NULL, and a name with fewer than ``at_least`` rows, gets no index.
    """
    counts = activity(df.where(F.col(column).isNotNull()), column).withColumnRenamed(column, "label")
    ranked = with_position(counts.where(F.col("n") >= at_least), [F.col("n").desc(), F.col("label").asc()], "idx")
    # A table of its own, so that the planner knows its size when it is joined.
    return cut(ranked.select("label", _as_factor_id(F.col("idx")).alias("idx"), "n"), "labels")


def apply_labels(
    df: DataFrame, column: str, labels: DataFrame, index: str, unseen: str = "keep", hot: DataFrame | None = None
) -> DataFrame:
    """Add ``index``, the double-valued index of ``column``.

    A name that is not in ``labels``, or NULL, gets the next free index (``keep``), loses its row
    (``skip``) or fails the job (``error``). ``hot``: the names to spread over tasks (see ``hot_keys``), by default
    those frequent by the counts ``n`` of ``labels``.
    """
    if hot is None:
        hot = hot_keys(labels.withColumnRenamed("label", column), column)
    lookup = labels.select(F.col("label").alias(column), F.col("idx").alias("_idx"))
    found = join_unique(df, lookup, column, "inner" if unseen == "skip" else "left", hot)
    if unseen == "keep":
        idx = F.coalesce("_idx", labels.agg(F.count(F.lit(1))).scalar())
    elif unseen == "error":
        idx = F.coalesce("_idx", F.raise_error(F.format_string(f"no index for {column} %s", column)).cast("int"))
    elif unseen == "skip":
        idx = F.col("_idx")
    else:
        raise ValueError(f"unseen must be keep, skip or error, not {unseen}")
    return found.select(*df.columns, idx.cast("double").alias(index))


def known_only(indexed: DataFrame, index: str, factors: DataFrame) -> DataFrame:
    """Rows whose index has a factor vector (``factors.id``).

    The bound on the largest id is a scalar subquery: it drops the index of unseen names,
    which may be a large share of the rows, before the join.
    """
    largest = factors.agg(F.max("id")).scalar()
    ids = factors.select(F.col("id").cast("double").alias(index))
    within = indexed.where(F.col(index) <= largest)
    return within.join(ids, index, "left_semi").select(*indexed.columns)


def _as_factor_id(position: Column) -> Column:
    too_many = F.raise_error(F.lit("more labels than 32-bit factor ids")).cast("int")
    return F.when(position <= MAX_INDEX, position.cast("int")).otherwise(too_many)
