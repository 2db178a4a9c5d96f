"""Column layouts of the tables the library reads and writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the reviews log, the event message and the
# serving table. Jobs exchanging data with an existing deployment depend on them. ``Id`` is
# wider than the 32 bits such logs use, as a larger log would lose rows otherwise.
REVIEWS = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("UserId", T.StringType()),
    T.StructField("ProductId", T.StringType()),
    T.StructField("Score", T.FloatType()),
    T.StructField("Time", T.LongType()),
])
MESSAGE = T.StructType([
    T.StructField("UserId", T.StringType()),
    T.StructField("ProductId", T.StringType()),
    T.StructField("Score", T.FloatType()),
    T.StructField("Time", T.LongType()),
])
RECOMMENDATIONS = T.StructType([
    T.StructField("UserId", T.StringType()),
    T.StructField("recommendations", T.ArrayType(T.StructType([
        T.StructField("ProductId", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]))),
])

RATING_COLUMNS = ["UserId", "ProductId", "Score"]
REVIEW_COLUMNS = ["Id", "UserId", "ProductId", "Score", "Time"]


class MissingColumns(ValueError):
    """The input lacks columns an operator needs."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail on the driver, before any job runs, if ``df`` lacks one of ``columns``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing {missing}, found {df.columns}")
    return df


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``. A value that does not parse becomes NULL, whether or
    not the session runs in ANSI mode, so that a later null filter can remove the row."""
    require_columns(df, schema.fieldNames())

    def convert(field: T.StructField) -> Column:
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[convert(f) for f in schema.fields])


def as_ratings(df: DataFrame) -> DataFrame:
    """(UserId string, ProductId string, Score float)."""
    return typed(df, T.StructType([REVIEWS[c] for c in RATING_COLUMNS]))
