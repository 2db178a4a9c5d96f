"""Messages into a table of events, bad ones into a table of their own, each micro-batch exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tasteloom.functions.messages import decode_message
from tasteloom.streaming.recommender import TRIGGER

EVENT = "UserId string, ProductId string, Score float, Time long"
GOOD, BAD, COUNTS = "events", "rejected", "counts"


def reason(value: Column, message: Column) -> Column:
    """Why a message is no event, or null: ``empty``, ``not an object`` or ``no user``."""
    read = F.get_json_object(value, "$").isNotNull() & F.ltrim(value).startswith("{")
    return (
        F.when(F.coalesce(F.trim(value), F.lit("")) == "", "empty")
        .when(~read, "not an object")
        .when(message["UserId"].isNull(), "no user")
    )


def start_ingest(
    feed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    after_write: Callable[[str, int], None] | None = None,
) -> StreamingQuery:
    """Split a stream with a ``value`` and, if it has one, an ``offset`` into three tables below ``path``.

    ``events``: the parsed messages. ``rejected``: (offset, value, reason) of those that are none. ``counts``: (n, bad) per
    micro-batch, observed while the batch was written. Every table has a folder per micro-batch, which a batch that is run
    again replaces: after an error, or a death between writing and committing, nothing is twice and nothing lost.
    ``after_write`` (table, batch number) is called once a table of the batch is written, before it is committed.
    """
    if "offset" not in feed.columns:
        feed = feed.withColumn("offset", F.lit(None).cast("long"))
    writer = feed.select("offset", "value").writeStream.foreachBatch(_store(path, after_write or (lambda table, batch: None)))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)).start()


def _store(path: str, after_write: Callable[[str, int], None]) -> Callable[[DataFrame, int], None]:
    def store(batch: DataFrame, number: int) -> None:
        def write(rows: DataFrame, table: str) -> None:
            rows.write.mode("overwrite").parquet(f"{path}/{table}/batch={number}")
            after_write(table, number)

        spark = batch.sparkSession
        parsed = batch.select("offset", "value", F.array(decode_message(F.col("value"))).alias("m"))
        told = parsed.select("offset", "value", F.col("m")[0].alias("m")).withColumn("reason", reason(F.col("value"), F.col("m")))
        staged = f"{path}/_staged/batch={number}"
        told.write.mode("overwrite").parquet(staged)  # the source is read once, whatever the tables read
        rows = spark.read.parquet(staged)
        write(rows.where("reason IS NULL").select("m.*"), GOOD)
        write(rows.where("reason IS NOT NULL").select("offset", "value", "reason"), BAD)
        write(rows.agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")), COUNTS)

    return store


def events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).parquet(f"{path}/{GOOD}")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("offset long, value string, reason string").parquet(f"{path}/{BAD}")


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, n, bad) per micro-batch."""
    return spark.read.schema("n long, bad long, batch long").parquet(f"{path}/{COUNTS}")
