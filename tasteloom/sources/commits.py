"""Versions that only one writer can take: a marker file created if it is absent.

Rests on the file system creating a file only where none is, as HDFS does and object stores do with conditional writes.
Hadoop's local file system looks first and creates then, so there the system call is used that does both at once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tasteloom.sources.scratch import file_system

MARKERS = "_versions"


def claim(spark: SparkSession, path: str, version: int, content: str) -> bool:
    """Take ``version`` below ``path`` with a word that says what it is; False if another writer has it."""
    fs, at = file_system(spark, path)
    marker = at(f"{path}/{MARKERS}/{version}")
    fs.mkdirs(marker.getParent())
    if fs.getScheme() == "file":
        try:
            with open(marker.toUri().getPath(), "x") as file:
                file.write(content)
            return True
        except FileExistsError:
            return False
    try:
        stream = fs.create(marker, False)
    except Exception:  # each file system has its own kind
        if fs.exists(marker):
            return False
        raise
    stream.write(bytearray(content.encode()))
    stream.close()
    return True


def claim_next(spark: SparkSession, path: str, content: str, least: int = 1) -> int:
    """Take the first free version after all that are taken, at least ``least``; writers at the same time get different ones."""
    version = max([least, *(v + 1 for v in claimed(spark, path))])
    while not claim(spark, path, version, content):
        version += 1
    return version


def claimed(spark: SparkSession, path: str) -> list[int]:
    """Versions taken so far, the newest first."""
    fs, at = file_system(spark, path)
    folder = at(f"{path}/{MARKERS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def content(spark: SparkSession, path: str, version: int) -> str | None:
    """What the writer of ``version`` said; None while, or if, it has said nothing."""
    fs, at = file_system(spark, path)
    words = spark.sparkContext._jvm.java.util.Scanner(fs.open(at(f"{path}/{MARKERS}/{version}")))
    try:
        return words.next() if words.hasNext() else None
    finally:
        words.close()


def release(spark: SparkSession, path: str, version: int) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at(f"{path}/{MARKERS}/{version}"), False)
