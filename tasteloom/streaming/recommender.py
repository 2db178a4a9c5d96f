"""Rating events in, stored recommendations of the users in them out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tasteloom.operators.activity import distinct_users
from tasteloom.sources import recstore
from tasteloom.sources.replay import parse_messages
from tasteloom.streaming.models import ModelCache
from tasteloom.streaming.presence import LATENESS, due_users

# Seconds between micro-batches, unless the job says otherwise, and length of a stored list.
TRIGGER_SECONDS = 120
TRIGGER = {"processingTime": f"{TRIGGER_SECONDS} seconds"}
TOP_N = 5


def start_recommender(
    feed: DataFrame, models: ModelCache, store: str, checkpoint: str,
    top_n: int = TOP_N, run_seq: int = 0, trigger: dict | None = None,
    once_per: int | None = None, lateness: int = LATENESS,
) -> StreamingQuery:
    """Score the users of each micro-batch of ``feed`` (a stream with a ``value`` column).

    An error in a batch ends the query. Its offsets stay uncommitted, so the batch is run
    again after a restart and replaces whatever it had stored. With ``once_per`` a user seen again
    within that many seconds of event time is not scored again (see ``due_users``).
    """
    recstore.create_if_missing(feed.sparkSession, store)
    events = parse_messages(feed)
    if once_per:
        events = due_users(events, once_per, lateness)
    writer = events.writeStream.foreachBatch(score_batch(models, store, top_n, run_seq))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)).start()


def score_batch(models: ModelCache, store: str, top_n: int, run_seq: int) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback: distinct users, known ones, top N, store."""

    def score(events: DataFrame, batch_id: int) -> None:
        bundle = models.current()
        # Kept, so that the batch is read from its source once.
        users = distinct_users(events).persist(StorageLevel.MEMORY_AND_DISK)
        known = None
        try:
            n_users = users.count()
            if not n_users:
                return
            known = bundle.known_users(users, n_users).persist(StorageLevel.MEMORY_AND_DISK)
            if known.isEmpty():
                return
            recstore.write_batch(bundle.recommend(known, top_n), store, run_seq, batch_id)
        finally:
            users.unpersist()
            if known is not None:
                known.unpersist()

    return score
