"""Reviews log in CSV files: scan and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tasteloom.sources.schemas import REVIEWS, require_columns, typed

# A quote inside a quoted field is written twice. Reader and writer must agree on it:
# Spark's default escape is a backslash, which shifts the columns of such a record.
QUOTING = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Scan CSV files with a header and a known schema, so no inference job runs.

    ``path`` is any URI the session's Hadoop file systems resolve, a folder or a glob.
    Set ``multiline`` when quoted fields hold line breaks. A file is then one unit of work,
    so such data should come as many files; without it Spark splits large files.
    """
    options = QUOTING | {"multiLine": str(multiline).lower(), "enforceSchema": "false"}
    return spark.read.schema(schema).options(**options).csv(path)


def read_reviews(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Scan a reviews log and keep (Id, UserId, ProductId, Score, Time).

    The file may hold further columns in any order. Only its header is read to learn the
    names; all columns are read as text and then converted, so that a malformed number
    gives NULL in that one field.
    """
    header = spark.read.options(**QUOTING).csv(path).limit(0)
    require_columns(header, REVIEWS.fieldNames())
    text = T.StructType([T.StructField(c, T.StringType()) for c in header.columns])
    return typed(read_csv(spark, path, text, multiline), REVIEWS)


def write_csv(df: DataFrame, path: str) -> None:
    """Export with a header, replacing what is there. One file per partition: merging into
    a single file would push the whole result through one task."""
    whole = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(**QUOTING, **whole).csv(path)
