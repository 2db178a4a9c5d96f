"""Users of a stream, each at most once a period, across micro-batches and restarts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# A period has this many ticks: times count to the tick, which bounds what is held of a user within a batch.
TICKS = 60
LATENESS = 600
DUE = "UserId string, tick long"


def due_users(events: DataFrame, period: int, lateness: int = LATENESS) -> DataFrame:
    """(UserId, tick): the users of ``events`` (UserId, Time in seconds) that are due, and the start of the tick in which they were seen.

    A user is due when seen for the first time, and again once ``period`` seconds have passed since it was due last. The
    state is the last due tick of a user; it is dropped when the watermark, ``lateness`` seconds and a tick
    behind the newest event, is a period further, as any later event is due anyway. An event up to ``lateness`` late counts
    as covered if its user was due later or within the period before it; older events are left out. An event
    without a time is due always (tick null), one without a user never. Repeated events are reduced within the
    task that reads them, and a user's ticks of a batch are all a task holds of it.
    """
    if period < 1 or lateness < 0:
        raise ValueError("a period of at least a second and no negative lateness")
    step = max(1, period // TICKS)
    seen = events.where(F.col("UserId").isNotNull()).select("UserId", (F.floor(F.col("Time") / step) * step).cast("long").alias("tick"))
    timed = seen.where(F.col("tick").isNotNull()).mapInPandas(_distinct, DUE)
    timed = timed.withColumn("at", F.timestamp_seconds("tick")).withWatermark("at", f"{lateness + step} seconds")
    due = timed.groupBy("UserId").applyInPandasWithState(_once(period), DUE, "last long", "append", GroupStateTimeout.EventTimeTimeout)
    return due.union(seen.where(F.col("tick").isNull()))


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.drop_duplicates()


def _once(period: int) -> Callable:
    def once(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ticks: set[int] = set()
        for rows in frames:
            ticks.update(rows["tick"].tolist())
        last, due = (state.get[0] if state.exists else None), []
        for tick in sorted(ticks):
            if last is None or tick >= last + period:
                due.append(tick)
                last = tick
        state.update((last,))
        state.setTimeoutTimestamp(max((last + period) * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"UserId": [key[0]] * len(due), "tick": due})

    return once
