"""One row per user, kept in hash buckets; an upsert writes only the buckets that got rows.

A version of the store is a manifest: for each bucket the write that last replaced it. A write puts the touched
buckets in a folder of its own, then its manifest, and then takes the version after the one it started from with a
marker that names it. Of two writers that started from one version one gets the marker, the other has changed nothing.
Readers of older versions keep their files. The driver sees a row per bucket, and nothing else.

    <path>/data/w=<write>/bucket=<b>/..   rows of a bucket, sorted by user, in files of at most ROWS_PER_FILE
    <path>/files/w=<write>/..             (bucket, file, low, high, n): the users each file can hold
    <path>/manifest/w=<write>/..          (bucket, w, buckets)
    <path>/_versions/<n>                  the write that is version n
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasteloom.sources import commits
from tasteloom.sources.schemas import RECOMMENDATIONS
from tasteloom.sources.scratch import exists, file_system, remove

BUCKETS = 64
# Users in one file, and so about what is read to find one of them.
ROWS_PER_FILE = 100_000
FILES = "bucket int, file string, low string, high string, n long"
ROW = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RECOMMENDATIONS.fields)
MANIFEST = "bucket int, w string, buckets int"


class Conflict(RuntimeError):
    """Another writer took the version; the upsert has changed nothing and can be run again."""


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, the newest first."""
    return [v for v in commits.claimed(spark, path) if commits.content(spark, path, v)]


def newest(spark: SparkSession, path: str) -> int:
    """The newest finished version, 0 without one."""
    return next((v for v in commits.claimed(spark, path) if commits.content(spark, path, v)), 0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[dict[int, str], int]:
    """({bucket: write}, number of buckets) of the newest or a given version; empty without one."""
    version = newest(spark, path) if version is None else version
    if not version:
        return {}, 0
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/w={commits.content(spark, path, version)}").collect()
    return {r["bucket"]: r["w"] for r in rows}, rows[0]["buckets"]


def _bucket(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, path: str, held: dict[int, str]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], ROW)
    return spark.read.schema(ROW).parquet(*[f"{path}/data/w={w}/bucket={b}" for b, w in sorted(held.items())])


def upsert(recs: DataFrame, path: str, buckets: int = BUCKETS, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Replace or add the rows (UserId, recommendations); returns the new version, or the old one if there are no rows.

    Of rows that repeat a user the one with the greater list stays, so the result does not depend on their order. Rows
    without a user are left out. The first write fixes the number of buckets. Raises Conflict where another writer was
    faster; what a writer leaves that dies before its marker is seen by nobody, and ``vacuum`` removes it.
    """
    spark, write = recs.sparkSession, uuid.uuid4().hex
    base = newest(spark, path)
    held, count = manifest(spark, path, base)
    count = count or buckets
    own = recs.where(F.col("UserId").isNotNull()).select(*RECOMMENDATIONS.fieldNames())
    own = own.groupBy("UserId").agg(F.max("recommendations").alias("recommendations"))
    folder = f"{path}/data/w={write}"
    own.withColumn("bucket", _bucket(F.col("UserId"), count)).write.parquet(f"{folder}/_new")
    new = spark.read.schema(f"{ROW}, bucket int").parquet(f"{folder}/_new")
    # At most one row per bucket.
    touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
    if not touched:
        remove(spark, folder)
        return base
    old = _rows(spark, path, {b: w for b, w in held.items() if b in touched})
    kept = old.join(new.select("UserId"), "UserId", "left_anti").withColumn("bucket", _bucket(F.col("UserId"), count))
    placed = kept.unionByName(new).repartition("bucket").sortWithinPartitions("bucket", "UserId")
    # A filter per row group tells most users it does not hold, also those between its first and last.
    filters = {"parquet.bloom.filter.enabled#UserId": "true", "parquet.bloom.filter.expected.ndv#UserId": str(rows_per_file)}
    placed.write.mode("append").options(**filters, maxRecordsPerFile=rows_per_file).partitionBy("bucket").parquet(folder)
    remove(spark, f"{folder}/_new")
    _list_files(spark, path, write, sorted(touched))
    rows = [(b, w, count) for b, w in (held | {b: write for b in touched}).items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/w={write}")
    if not commits.claim(spark, path, base + 1, write):
        for part in ("data", "files", "manifest"):
            remove(spark, f"{path}/{part}/w={write}")
        raise Conflict(f"version {base + 1} was taken meanwhile")
    return base + 1


def _list_files(spark: SparkSession, path: str, write: str, buckets: list[int]) -> None:
    """Write which users the files of a write can hold; a column of each file is read, and a row per file kept."""
    folder = f"{path}/data/w={write}"
    rows = spark.read.schema("UserId string, bucket int").option("basePath", folder).parquet(*[f"{folder}/bucket={b}" for b in buckets])
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    found = rows.groupBy("bucket", name.alias("file")).agg(F.min("UserId").alias("low"), F.max("UserId").alias("high"), F.count(F.lit(1)).alias("n"))
    found.coalesce(1).write.parquet(f"{path}/files/w={write}")


def files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(bucket, file, low, high, n) of the newest, or a given, version; ``file`` is a path and ranges of a bucket do not overlap."""
    held = manifest(spark, path, version)[0]
    if not held:
        return spark.createDataFrame([], FILES)
    writes = {w: [b for b in held if held[b] == w] for w in set(held.values())}
    parts = [
        spark.read.schema(FILES).parquet(f"{path}/files/w={w}").where(F.col("bucket").isin(own))
        .withColumn("file", F.concat(F.lit(f"{path}/data/w={w}/bucket="), F.col("bucket").cast("string"), F.lit("/"), F.col("file")))
        for w, own in sorted(writes.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def lookup_many(users: DataFrame, path: str) -> DataFrame:
    """The rows (UserId, recommendations) of the users in ``users`` that the store holds, each once.

    Only files that can hold one of them are opened: a user meets the last file of its bucket that begins at or before it, by
    one ordered pass over the users and the list of files, and no join over ranges. The driver sees the names of
    files to open, at most as many as the store has. What they hold meets the users in a plain join, whose smaller
    side the planner broadcasts by its size. Users that are null or repeated give nothing more.
    """
    spark = users.sparkSession
    held, count = manifest(spark, path)
    if not held:
        return spark.createDataFrame([], ROW)
    asked = users.where(F.col("UserId").isNotNull()).select("UserId").distinct()
    begins = files(spark, path).select("bucket", F.col("low").alias("UserId"), F.struct("file", "high").alias("_file"))
    keys = asked.select(_bucket(F.col("UserId"), count).alias("bucket"), "UserId", F.lit(None).cast("struct<file:string,high:string>").alias("_file"))
    # A file comes before the user it begins with.
    before = Window.partitionBy("bucket").orderBy("UserId", F.col("_file").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = begins.unionByName(keys).withColumn("_in", F.last("_file", ignorenulls=True).over(before))
    hit = found.where(F.col("_file").isNull() & (F.col("UserId") <= F.col("_in")["high"]))
    names = [r[0] for r in hit.select(F.col("_in")["file"]).distinct().collect()]
    if not names:
        return spark.createDataFrame([], ROW)
    return spark.read.schema(ROW).parquet(*sorted(names)).join(asked, "UserId", "left_semi")


def current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row per user of the newest, or a given, version; empty without one."""
    return _rows(spark, path, manifest(spark, path, version)[0])


def lookup(spark: SparkSession, path: str, user_id: str) -> DataFrame:
    """The row of one user: one bucket is opened, and of it the row groups that can hold the user."""
    held, count = manifest(spark, path)
    if not held:
        return spark.createDataFrame([], ROW)
    bucket = spark.range(1).select(_bucket(F.lit(user_id), count)).first()[0]
    return _rows(spark, path, {b: w for b, w in held.items() if b == bucket}).where(F.col("UserId") == F.lit(user_id))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete what the newest ``keep`` versions do not use, also what dead writers left.

    To be run when no reader is on an older version and no writer is at work. A marker that says nothing is
    of a writer that died while taking the version; it is freed.
    """
    for version in set(commits.claimed(spark, path)) - set(versions(spark, path)):
        commits.release(spark, path, version)
    known = versions(spark, path)
    kept, used = {commits.content(spark, path, v) for v in known[:keep]}, set()
    for version in known[:keep]:
        used |= set(manifest(spark, path, version)[0].items())
    for version in known[keep:]:
        commits.release(spark, path, version)
    fs, at = file_system(spark, path)

    def names(folder: str, prefix: str) -> list[str]:
        if not exists(spark, folder):
            return []
        found = [f.getPath().getName() for f in fs.listStatus(at(folder))]
        return [n.removeprefix(prefix) for n in found if n.startswith(prefix)]

    for write in names(f"{path}/manifest", "w="):
        if write not in kept:
            remove(spark, f"{path}/manifest/w={write}")
    for write in names(f"{path}/data", "w="):
        buckets = names(f"{path}/data/w={write}", "bucket=")
        stale = [b for b in buckets if (int(b), write) not in used]
        if len(stale) == len(buckets):
            remove(spark, f"{path}/data/w={write}")
            remove(spark, f"{path}/files/w={write}")
        else:
            for b in stale:
                remove(spark, f"{path}/data/w={write}/bucket={b}")
