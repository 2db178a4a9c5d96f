"""A growing index of names: ids once given stay, new names get the ids above them.

A version is a folder with the names it added. Its marker says which folder, the first free id after it, and whether the
folder holds all names (``all``) or those new since the version before (``new``). Two writers that started from
one version cannot both take the next one: the slower one numbers its names again, above those of the other.

    <path>/names/w=<write>/..   (label, idx)
    <path>/_versions/<n>        <write>:<first free id>:<all or new>
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.operators.activity import activity
from tasteloom.operators.joins import ROWS_PER_TASK, hot_keys
from tasteloom.operators.labels import apply_labels
from tasteloom.operators.ordering import with_position
from tasteloom.sources import bucketstore, commits
from tasteloom.sources.scratch import cut, exists, file_system, remove

NAMES = "label string, idx long"
ALL, NEW = "all", "new"
# Seconds for a writer between creating its marker and its words.
WAIT = 30


def _told(spark: SparkSession, path: str, upto: int | None = None) -> list[tuple[int, str, int, str]]:
    """(version, write, first free id, kind) of finished versions, the newest first, down to one that holds all names."""
    found = []
    for version in commits.claimed(spark, path):
        if (upto is None or version <= upto) and (words := commits.content(spark, path, version)):
            write, free, kind = words.split(":")
            found.append((version, write, int(free), kind))
            if kind == ALL:
                break
    return found


def newest(spark: SparkSession, path: str) -> int:
    """The newest version, 0 without one."""
    return next((version for version, *_ in _told(spark, path)), 0)


def size(spark: SparkSession, path: str, version: int | None = None) -> int:
    """Number of names, which is the first free id, of the newest or a given version."""
    return next((free for _, _, free, _ in _told(spark, path, version)), 0)


def current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(label, idx) of the newest, or a given, version; empty without one."""
    return _names(spark, path, _told(spark, path, version))


def _names(spark: SparkSession, path: str, told: list[tuple[int, str, int, str]]) -> DataFrame:
    if not told:
        return spark.createDataFrame([], NAMES)
    return spark.read.schema(NAMES).parquet(*[f"{path}/names/w={write}" for _, write, _, _ in told])


def grow(df: DataFrame, column: str, path: str) -> int:
    """Give ids to the names in ``column`` that have none; returns the version that holds them all.

    New names follow the highest id in the order of ``fit_labels``: the most frequent in ``df`` first, ties by name.
    They are numbered over range partitions, and old names are read but not written. NULL gets no id. Without a new name
    there is no new version, so a job that is run again changes nothing.
    """
    spark = df.sparkSession
    counts = activity(df.where(F.col(column).isNotNull()), column).select(F.col(column).cast("string").alias("label"), "n")
    while True:
        told = _told(spark, path)
        base, free = (told[0][0], told[0][2]) if told else (0, 0)
        new = counts.join(_names(spark, path, told).select("label"), "label", "left_anti")
        placed = with_position(new, [F.col("n").desc(), F.col("label").asc()], "idx")
        write = uuid.uuid4().hex
        folder = f"{path}/names/w={write}"
        placed.select("label", (F.col("idx") + free).alias("idx")).write.parquet(folder)
        added = spark.read.schema(NAMES).parquet(folder).count()
        if added and commits.claim(spark, path, base + 1, f"{write}:{free + added}:{NEW}"):
            return base + 1
        remove(spark, folder)
        if not added:
            return base
        _await(spark, path, base + 1)


def _await(spark: SparkSession, path: str, version: int) -> None:
    """Until the writer that took ``version`` has said what it is."""
    for _ in range(WAIT):
        if commits.content(spark, path, version):
            return
        time.sleep(1)
    raise bucketstore.Conflict(f"version {version} was taken by a writer that says nothing; vacuum frees it")


def fold(spark: SparkSession, path: str) -> int:
    """Write all names as one folder, so that readers open one and not one per version; ids stay. Returns the version."""
    told = _told(spark, path)
    if not told or told[0][3] == ALL:
        return told[0][0] if told else 0
    base, write = told[0][0], uuid.uuid4().hex
    folder = f"{path}/names/w={write}"
    _names(spark, path, told).write.parquet(folder)
    if not commits.claim(spark, path, base + 1, f"{write}:{told[0][2]}:{ALL}"):
        remove(spark, folder)
        raise bucketstore.Conflict(f"version {base + 1} was taken meanwhile")
    return base + 1


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete folders and markers that the newest version does not use, also those of dead writers.

    To be run when no reader is on an older version and no writer is at work.
    """
    told = _told(spark, path)
    versions, writes = {version for version, *_ in told}, {write for _, write, _, _ in told}
    for version in set(commits.claimed(spark, path)) - versions:
        commits.release(spark, path, version)
    if not exists(spark, f"{path}/names"):
        return
    fs, at = file_system(spark, path)
    for status in fs.listStatus(at(f"{path}/names")):
        name = status.getPath().getName()
        if name.startswith("w=") and name.removeprefix("w=") not in writes:
            remove(spark, f"{path}/names/{name}")


def with_index(df: DataFrame, column: str, path: str, index: str, unseen: str = "keep", version: int | None = None) -> DataFrame:
    """Add ``index``, the double-valued id of ``column``, as ``apply_labels`` does.

    An unknown or missing name gets the first free id (``keep``), loses its row (``skip``) or fails the job (``error``). Names that are
    hot in ``df`` are spread over tasks, however rare they were when they got their id.
    """
    # Only the few frequent names are kept of the counts, so that the index is read once and not written again.
    counts = activity(df, column).select(F.col(column).cast("string").alias(column), "n")
    hot = hot_keys(cut(counts.where(F.col("n") > ROWS_PER_TASK), "frequent"), column)
    return apply_labels(df, column, current(df.sparkSession, path, version), index, unseen, hot)
