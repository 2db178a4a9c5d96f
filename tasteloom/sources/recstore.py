"""Stored recommendations: one folder per micro-batch, the newest row per user wins.

``compact`` folds the batches into a base table, so that readers meet the base and the few batches after it.
What a reader may use is named by a pointer row that is written last: a job that dies halfway leaves
the store as it was.

A batch that is run again after a failure replaces its own folder, so a replay changes
nothing. ``run_seq`` is given by the operator of the job and is raised when the streaming
checkpoint is discarded, because batch numbers then start from 0 again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.sources.scratch import exists, file_system
from tasteloom.sources.schemas import RECOMMENDATIONS

HISTORY = T.StructType([
    *RECOMMENDATIONS.fields,
    T.StructField("run_seq", T.IntegerType()),
    T.StructField("batch_id", T.LongType()),
])


# Folders with a leading underscore are no partitions of the history.
BASE, POINTER = "_base", "_current"
BASE_POINTER = "version long, run_seq int, batch_id long"
SNAPSHOT_POINTER = "version long, buckets int"


def create_if_missing(spark: SparkSession, path: str) -> None:
    """An empty store, so that readers work before the first batch."""
    empty = spark.createDataFrame([], HISTORY)
    empty.write.mode("ignore").partitionBy("run_seq", "batch_id").parquet(path)


def _pointer(spark: SparkSession, path: str, schema: str):
    """The newest pointer row, or None; a reader writes nothing."""
    if not exists(spark, path):
        return None
    rows = spark.read.schema(schema).parquet(path)
    return rows.orderBy(F.col("version").desc()).first()


def compact(spark: SparkSession, path: str) -> None:
    """Write the newest row of each user as a base table, then name it as the one to read.

    One compaction runs at a time. Batches keep their folders until ``drop_compacted``.
    """
    rows = _since(spark, path, before := _pointer(spark, f"{path}/{POINTER}", BASE_POINTER))
    last = rows.agg(F.max(F.struct("run_seq", "batch_id")).alias("last")).first()["last"]
    if last is None:
        return
    version = (before["version"] if before else 0) + 1
    _newest(rows).write.mode("overwrite").parquet(f"{path}/{BASE}/v={version}")
    pointer = spark.createDataFrame([(version, last["run_seq"], last["batch_id"])], BASE_POINTER)
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/{POINTER}")


def _since(spark: SparkSession, path: str, pointer) -> DataFrame:
    """Rows of the base, if there is one, and of the batches after it."""
    rows = history(spark, path)
    if pointer is None:
        return rows
    run, batch = F.col("run_seq"), F.col("batch_id")
    newer = (run > pointer["run_seq"]) | ((run == pointer["run_seq"]) & (batch > pointer["batch_id"]))
    base = spark.read.schema(HISTORY).parquet(f"{path}/{BASE}/v={pointer['version']}")
    return base.unionByName(rows.where(newer))


def _newest(rows: DataFrame) -> DataFrame:
    at = F.struct("run_seq", "batch_id")
    last = rows.groupBy("UserId").agg(F.max_by("recommendations", at).alias("recommendations"), F.max(at).alias("at"))
    return last.select("UserId", "recommendations", "at.run_seq", "at.batch_id")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest row per user: the base and the batches after it."""
    return latest(_since(spark, path, _pointer(spark, f"{path}/{POINTER}", BASE_POINTER)))


def drop_compacted(spark: SparkSession, path: str) -> None:
    """Delete the folders of batches that the base holds, and bases before it.

    To be run when no reader is older than the newest base.
    """
    pointer = _pointer(spark, f"{path}/{POINTER}", BASE_POINTER)
    if pointer is None:
        return
    fs, at = file_system(spark, path)
    done = (pointer["run_seq"], pointer["batch_id"])
    held = history(spark, path).select("run_seq", "batch_id").distinct()
    for row in held.toLocalIterator():
        if tuple(row) <= done:
            fs.delete(at(f"{path}/run_seq={row[0]}/batch_id={row[1]}"), True)
    for version in range(1, pointer["version"]):
        fs.delete(at(f"{path}/{BASE}/v={version}"), True)


def write_batch(recs: DataFrame, path: str, run_seq: int, batch_id: int) -> None:
    """Store the rows (UserId, recommendations) of one micro-batch."""
    rows = recs.select(*RECOMMENDATIONS.fieldNames())
    rows.write.mode("overwrite").parquet(f"{path}/run_seq={run_seq}/batch_id={batch_id}")


def history(spark: SparkSession, path: str) -> DataFrame:
    """Every row ever stored, with its (run_seq, batch_id)."""
    return spark.read.schema(HISTORY).option("basePath", path).parquet(path)


def latest(rows: DataFrame) -> DataFrame:
    """The newest row per user of a history frame."""
    newest = F.max_by("recommendations", F.struct("run_seq", "batch_id"))
    return rows.groupBy("UserId").agg(newest.alias("recommendations"))


def write_snapshot(recs: DataFrame, path: str, buckets: int = 64) -> None:
    """The latest rows as a table for lookups: a folder per hash bucket, sorted by user, so a
    lookup opens one folder and skips most of its row groups.

    Each call writes a new version; readers find the old one until its pointer row is there.
    The number of buckets is kept with the version.
    """
    spark = recs.sparkSession
    before = _pointer(spark, f"{path}/{POINTER}", SNAPSHOT_POINTER)
    version = (before["version"] if before else 0) + 1
    keyed = recs.withColumn("bucket", _bucket(F.col("UserId"), buckets))
    placed = keyed.repartition("bucket").sortWithinPartitions("bucket", "UserId")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v={version}")
    spark.createDataFrame([(version, buckets)], SNAPSHOT_POINTER).coalesce(1).write.mode("append").parquet(f"{path}/{POINTER}")


def _bucket(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def snapshot_lookup(spark: SparkSession, path: str, user_id: str, buckets: int | None = None) -> DataFrame:
    """The row of one user in the newest snapshot.

    The number of buckets is read with the version; one given here must be the same.
    """
    pointer = _pointer(spark, f"{path}/{POINTER}", SNAPSHOT_POINTER)
    if pointer is None:
        return spark.createDataFrame([], RECOMMENDATIONS)
    if buckets is not None and buckets != pointer["buckets"]:
        raise ValueError(f"the snapshot has {pointer['buckets']} buckets, not {buckets}")
    table = spark.read.parquet(f"{path}/v={pointer['version']}")
    key = F.lit(user_id)
    found = table.where((F.col("bucket") == _bucket(key, pointer["buckets"])) & (F.col("UserId") == key))
    return found.drop("bucket").limit(1)
