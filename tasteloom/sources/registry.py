"""Model runs: an append-only table, one row per trained version.

The row is written after the model's folder is complete, so a listed version can be loaded.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.sources.scratch import file_system, remove

MODEL_NAME = "recommender"
# The stages a version can be in.
STAGES = ["None", "Staging", "Production"]

RUNS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("stage", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("regParam", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("coverage", T.DoubleType()),
    T.StructField("path", T.StringType()),
])


def create_if_missing(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], RUNS).write.mode("ignore").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def append(runs: DataFrame, path: str) -> None:
    """Add rows. They are written apart and their files moved in whole, so jobs that append at once keep theirs."""
    spark, own = runs.sparkSession, f"{path}/_new-{uuid.uuid4().hex}"
    runs.select(*RUNS.fieldNames()).write.parquet(own)
    fs, at = file_system(spark, path)
    for file in fs.listStatus(at(own)):
        name = file.getPath().getName()
        if name.endswith(".parquet") and not fs.rename(file.getPath(), at(f"{path}/{name}")):
            raise OSError(f"{name} could not be moved into {path}")
    remove(spark, own)


def latest(runs: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """The row with the highest version of each name over all of ``stages``."""
    asked = runs.where(F.col("stage").isin(list(stages)))
    newest = asked.groupBy("name").agg(F.max_by(F.struct(*runs.columns), "version").alias("r"))
    return newest.select("r.*")


def versions(runs: DataFrame) -> DataFrame:
    """(name, stage, version): the highest version in each stage."""
    return runs.groupBy("name", "stage").agg(F.max("version").alias("version"))


def latest_metrics(runs: DataFrame, name: str = MODEL_NAME, stages: Sequence[str] = ("None",)) -> DataFrame:
    """One row (rmse, rank, regParam, error) as text; ``N/A`` and a reason without a version."""
    # Of at most one row: the aggregate without a grouping key always gives one.
    row = latest(runs.where(F.col("name") == name), stages).agg(
        F.first("rmse").alias("rmse"), F.first("rank").alias("rank"), F.first("regParam").alias("regParam"),
        F.count(F.lit(1)).alias("found"),
    )
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) for c in ("rmse", "rank", "regParam")]
    return row.select(*shown, F.when(F.col("found") == 0, F.lit("no version found")).alias("error"))
