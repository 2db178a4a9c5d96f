"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system of ``path``, function from a name to its path there)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at(path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, if it is there."""
    fs, at = file_system(spark, path)
    fs.delete(at(path), True)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def removed_at_end(spark: SparkSession) -> Iterator[None]:
    """Delete every folder that ``scratch_dir`` names within the block once it ends, also on an error.

    For jobs whose results live elsewhere: frames built on the folders cannot be read afterwards.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for name in made:
            remove(spark, name)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it then gets a temporary folder.
    On a cluster a machine-local folder would be invisible to the other executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tasteloom-")
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def cut(df: DataFrame, purpose: str = "cut") -> DataFrame:
    """Write ``df`` to a table and read it back.

    Used where a result is read several times, or must not change between reads. Unlike a
    cached frame the table survives the loss of executors, and being columnar it still
    prunes columns for each reader.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
