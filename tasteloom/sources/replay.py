"""Reviews as an event feed, and the feed back as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tasteloom.functions.messages import decode_message, encode_message, in_replay_part
from tasteloom.sources.schemas import REVIEW_COLUMNS, require_columns


def replay_messages(reviews: DataFrame, skipped: Observation | None = None) -> DataFrame:
    """(value): JSON messages of the replayed 40 % of ``reviews``.

    A row without a user, an id or a time gives no message. ``skipped`` collects their number
    (``no_user``, ``no_id``, ``no_time``) while the messages are written.
    """
    require_columns(reviews, REVIEW_COLUMNS)
    if skipped is not None:
        reviews = reviews.observe(
            skipped,
            F.count_if(F.col("UserId").isNull()).alias("no_user"),
            F.count_if(F.col("Id").isNull()).alias("no_id"),
            F.count_if(F.col("Time").isNull()).alias("no_time"),
        )
    usable = reviews.where(in_replay_part() & F.col("UserId").isNotNull() & F.col("Time").isNotNull())
    return usable.select(encode_message().alias("value"))


def parse_messages(feed: DataFrame) -> DataFrame:
    """(UserId, ProductId, Score, Time) from a frame with a ``value``; batch or stream.

    Messages that are not JSON objects, or name no user, are dropped.
    """
    # A filter on the parsed column would be moved below the parsing and parse a second time.
    kept = F.filter(F.array(decode_message(F.col("value"))), lambda m: m["UserId"].isNotNull())
    return feed.select(F.inline(kept))


def read_feed(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files, one message per line, as a stream with a ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
