"""Rates, latency quantiles and gauge sums over a request or metric log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.operators.ordering import sorted_table, with_neighbour

# Upper bounds used when none are given, in the unit of the measured value.
LATENCY_BOUNDS = (1.0, 2.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)


def rate_by(df: DataFrame, ts: str, by: str, seconds: int, step: int | None = None) -> DataFrame:
    """(window_start, by, n, per_second): events in each window of ``seconds``, one per ``step``.

    Windows start at multiples of ``step``, which divides ``seconds``. Rows are counted once per
    step; only those counts are repeated for the windows that overlap. ``ts`` may be a TIMESTAMP
    or a TIMESTAMP_NTZ; its wall-clock value is used, so no session time zone shifts the windows.
    """
    step = step or seconds
    if seconds % step:
        raise ValueError("step must divide the window length")
    slot = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp_ntz")) / step)
    counts = df.groupBy(slot.alias("slot"), by).agg(F.count(F.lit(1)).alias("n"))
    first = F.explode(F.sequence(F.col("slot") - (seconds // step - 1), F.col("slot"))).alias("first")
    windows = counts.select(first, by, "n").groupBy("first", by).agg(F.sum("n").alias("n"))
    start = F.timestamp_add("SECOND", F.col("first") * step, F.lit("1970-01-01").cast("timestamp_ntz"))
    return windows.select(
        start.alias("window_start"), by, "n", (F.col("n") / F.lit(float(seconds))).alias("per_second")
    )


def stream_rate_by(df: DataFrame, ts: str, by: str, window: str, late: str) -> DataFrame:
    """(window_start, by, n) on a stream: tumbling windows closed once ``late`` has passed.

    A watermark needs a TIMESTAMP. It is made from the seconds of the wall clock, and the start of the
    window is turned back the same way, so that no change of the session's zone joins two windows.
    """
    seconds = F.timestamp_seconds(F.unix_timestamp(F.col(ts).cast("timestamp_ntz")))
    timed = df.withColumn(ts, seconds).withWatermark(ts, late)
    counts = timed.groupBy(F.window(ts, window).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    start = F.timestamp_add("SECOND", F.unix_seconds("w.start"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return counts.select(start.alias("window_start"), by, "n")


def histogram(df: DataFrame, value: str, by: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """(by.., le, n): rows per bucket, a row counted in the first bucket it fits under.

    ``le`` is the bucket's upper bound; the last bucket has infinity.
    """
    le = F.lit(float("inf"))
    for bound in reversed(sorted(bounds)):
        le = F.when(F.col(value) <= bound, F.lit(float(bound))).otherwise(le)
    return df.where(F.col(value).isNotNull()).groupBy(*by, le.alias("le")).agg(F.count(F.lit(1)).alias("n"))


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS
) -> DataFrame:
    """(by.., quantile) from counts per bucket, by linear interpolation inside a bucket.

    The first bucket starts at 0 (or at its own bound, if that is not positive). A quantile in
    the last, unbounded bucket gives the largest finite bound. Each group has at most one row
    per bucket, so the windows below stay as small as ``bounds``.
    """
    below = Window.partitionBy(*by).orderBy("le").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    ranked = buckets.select(
        *by, "le", "n",
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("before"),
        (F.sum("n").over(whole) * F.lit(q)).alias("target"),
    )
    hit = ranked.where((F.col("before") + F.col("n") >= F.col("target")))
    first = hit.groupBy(*by).agg(F.min(F.struct("le", "n", "before", "target")).alias("b"))
    b = F.col("b")
    lower, largest = _lower_bound(b["le"], bounds), max(bounds)
    inside = lower + (b["le"] - lower) * (b["target"] - b["before"]) / b["n"]
    quantile = F.when(b["le"] > largest, F.lit(float(largest))).otherwise(inside)
    return first.select(*by, quantile.alias("quantile"))


def exact_quantile(df: DataFrame, value: str, q: float, by: str) -> DataFrame:
    """(by, quantile) with linear interpolation between the two nearest values.

    Equal values are counted first and the counts are summed along a distributed sort, so
    neither a large group nor a frequent value has to fit in one task.
    """
    values = df.where(F.col(value).isNotNull()).groupBy(by, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    table = sorted_table(values, [F.col(by), F.col("v")])
    # At most one row per group and sort partition.
    per_part = table.groupBy(by, "_part").agg(F.sum("n").alias("_n"))
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        by, "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(by)).alias("_total"),
    )
    along = Window.partitionBy(by, "_part").orderBy("_row")
    running = table.withColumn("_in_part", F.sum("n").over(along)).join(starts, [by, "_part"])
    upto = F.col("_start") + F.col("_in_part")
    at = F.lit(q) * (F.col("_total") - 1)
    picked = running.groupBy(by).agg(
        F.min(F.when(upto > F.floor(at), F.col("v"))).alias("low"),
        F.min(F.when(upto > F.ceil(at), F.col("v"))).alias("high"),
        F.max(at - F.floor(at)).alias("share"),
    )
    return picked.select(by, (F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias("quantile"))


def gauge_sum(
    df: DataFrame, group: str, series: Sequence[str], value: str, newest: Sequence[str], pattern: str
) -> DataFrame:
    """(group, total): the last sample of each series, summed over the groups whose whole name
    matches ``pattern``."""
    chosen = df.where(F.col(group).rlike(f"^(?:{pattern})$"))
    last = chosen.groupBy(group, *series).agg(F.max_by(value, F.struct(*newest)).alias("last"))
    return last.groupBy(group).agg(F.sum("last").alias("total"))


SECOND = 1_000_000
# A window is extended over a gap at its edge of up to so many mean intervals, else by half of one.
NEAR, FAR = 1.1, 0.5


def _micros(ts: str) -> Column:
    """Wall-clock microseconds since 1970 of a TIMESTAMP or TIMESTAMP_NTZ, whatever the session's time zone."""
    local = F.col(ts).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), local)


def _wall_clock(micros: Column) -> Column:
    return F.timestamp_add("SECOND", (micros / SECOND).cast("long"), F.lit("1970-01-01").cast("timestamp_ntz"))


def counter_rate(df: DataFrame, ts: str, series: Sequence[str], value: str, seconds: int, step: int) -> DataFrame:
    """(series.., at, increase, per_second) of counters that may start again from 0.

    At each multiple ``at`` of ``step`` seconds the window is the ``seconds`` up to it, its start left out. The
    increase is the last sample less the first plus what falls took away: a sample lower than the one
    before it has counted from 0. It is extended to the edges of the window: to an edge less than NEAR mean
    intervals away whole, else by FAR of an interval, and never to where the counter would have been below 0.
    A window with samples at fewer than two times has no row; samples without time or value are left out.

    Each sample meets the one before it across range partitions, and a step of a series is summed up as its ends and
    its rises, inside and from the step before. Windows add such summaries, so no task holds a series.
    """
    if seconds % step:
        raise ValueError("step must divide the window length")
    own = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        *series, _micros(ts).alias("_at"), F.col(value).cast("double").alias("_v"))
    samples = with_neighbour(own, series, [F.col("_at"), F.col("_v")], ["_at", "_v"], "_before")
    slot = ((F.col("_at") + F.pmod(-F.col("_at"), F.lit(step * SECOND))) / (step * SECOND)).cast("long")
    fell = F.col("_v") < F.col("_before._v")
    rise = F.when(fell, F.col("_v")).otherwise(F.col("_v") - F.col("_before._v"))
    before_slot = ((F.col("_before._at") + F.pmod(-F.col("_before._at"), F.lit(step * SECOND))) / (step * SECOND)).cast("long")
    inside = before_slot.eqNullSafe(slot)
    first = F.min(F.struct(F.col("_at").alias("at"), F.col("_v").alias("v"))).alias("first")
    summaries = samples.groupBy(*series, slot.alias("_slot")).agg(
        F.count(F.lit(1)).alias("n"), first, F.max("_at").alias("last"),
        F.sum(F.when(inside, rise)).alias("inner"),
        F.max(F.when(~inside, F.struct(F.col("_before._at").alias("at"), rise.alias("rise")))).alias("link"),
    )
    ends = F.explode(F.sequence(F.col("_slot"), F.col("_slot") + (seconds // step - 1))).alias("_end")
    spread = summaries.select(*series, ends, "n", "first", "last", "inner", "link")
    start = (F.col("_end") * step - seconds) * SECOND
    linked = F.when(F.col("link.at") > start, F.col("link.rise"))
    windows = spread.groupBy(*series, "_end").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        (F.coalesce(F.sum("inner"), F.lit(0.0)) + F.coalesce(F.sum(linked), F.lit(0.0))).alias("rise"),
    )
    span = (F.col("last") - F.col("first.at")) / SECOND
    each = span / (F.col("n") - 1)
    ahead = (F.col("first.at") - start) / SECOND
    behind = (F.col("_end") * step * SECOND - F.col("last")) / SECOND
    reach = lambda gap: F.when(gap < NEAR * each, gap).otherwise(each * FAR)
    to_zero = F.when((F.col("rise") > 0) & (F.col("first.v") >= 0), span * F.col("first.v") / F.col("rise"))
    whole = span + F.least(reach(ahead), to_zero) + reach(behind)
    increase = F.col("rise") * whole / span
    told = windows.where((F.col("n") > 1) & (F.col("last") > F.col("first.at")))
    return told.select(
        *series, _wall_clock(F.col("_end") * step * SECOND).alias("at"), increase.alias("increase"),
        (increase / F.lit(float(seconds))).alias("per_second"),
    )


def gauge_at_steps(df: DataFrame, ts: str, series: Sequence[str], value: str, newest: Sequence[str], step: int, look_back: int) -> DataFrame:
    """(series.., at, value): at each multiple of ``step`` seconds the last sample of the ``look_back`` seconds up to it.

    The start of the look-back is left out. Of samples at one time the greatest in ``newest`` counts; those without
    time or value do not. A sample holds from its time until the next one or the end of its look-back, so it is
    repeated for the steps in between, at most one more than fit in the look-back, and nothing is joined by range.
    """
    own = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        *series, _micros(ts).alias("_at"), F.col(value).alias("_v"), *[F.col(c).alias(f"_n{i}") for i, c in enumerate(newest)])
    order = [F.col("_at"), *[F.col(f"_n{i}") for i in range(len(newest))]]
    samples = with_neighbour(own, series, order, ["_at"], "_after", after=True)
    end = F.least(F.col("_at") + look_back * SECOND, F.col("_after._at")) - 1
    first = F.col("_at") + F.pmod(-F.col("_at"), F.lit(step * SECOND))
    last = end - F.pmod(end, F.lit(step * SECOND))
    held = samples.select(*series, F.col("_v").alias("value"), first.alias("_first"), last.alias("_last")).where("_first <= _last")
    steps = F.explode(F.sequence("_first", "_last", F.lit(step * SECOND))).alias("_step")
    return held.select(*series, "value", steps).select(*series, _wall_clock(F.col("_step")).alias("at"), "value")


def gauge_sum_range(
    df: DataFrame, group: str, ts: str, series: Sequence[str], value: str, newest: Sequence[str], pattern: str, step: int, look_back: int
) -> DataFrame:
    """(group, at, total): at each step the sum over a group's series, for groups whose whole name matches ``pattern``."""
    chosen = df.where(F.col(group).rlike(f"^(?:{pattern})$"))
    told = gauge_at_steps(chosen, ts, [group, *series], value, newest, step, look_back)
    return told.groupBy(group, "at").agg(F.sum("value").alias("total"))


# Size of a quantile sketch, and the share of all values by which a rank read from it may be off.
SKETCH, RANK_ERROR = 800, 0.01


def stream_quantile(
    df: DataFrame, ts: str, by: str, value: str, q: float, window: str, slide: str, late: str, size: int = SKETCH
) -> DataFrame:
    """(window_start, by, n, quantile) on a stream: sliding windows closed once ``late`` has passed.

    Values go into one sketch per slide; a window merges the sketches of its slides, so a value is read once
    however many windows hold it, and the state is one sketch per slide, window and group. The rank of the
    answer is off by RANK_ERROR of the window's values at most, for the size given here. Values that are null or NaN are left out.
    """
    seconds = F.timestamp_seconds(F.unix_timestamp(F.col(ts).cast("timestamp_ntz")))
    fine = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    timed = fine.withColumn(ts, seconds).withWatermark(ts, late)
    slides = timed.groupBy(F.window(ts, slide).alias("s"), by).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch"))
    merged = slides.groupBy(F.window(F.window_time("s"), window, slide).alias("w"), by).agg(
        F.kll_merge_agg_double("sketch", size).alias("sketch"))
    start = F.timestamp_add("SECOND", F.unix_seconds("w.start"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return merged.select(
        start.alias("window_start"), by, F.kll_sketch_get_n_double("sketch").alias("n"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("quantile"),
    )


def rank_within(
    quantiles: DataFrame, df: DataFrame, ts: str, by: str, value: str, q: float, window: int, slide: int, error: float = RANK_ERROR
) -> DataFrame:
    """(window_start, by, n, within): whether each quantile's exact rank in the window's values is within ``error`` of ``q``."""
    slot = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp_ntz")) / slide)
    starts = F.explode(F.sequence(slot - (window // slide - 1), slot)).alias("_slot")
    fine = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    values = fine.select(F.col(by).alias("_by"), F.col(value).alias("_v"), starts)
    values = values.select("_by", "_v", _wall_clock(F.col("_slot") * slide * SECOND).alias("_start"))
    met = quantiles.join(values, (F.col("window_start") == F.col("_start")) & F.col(by).eqNullSafe(F.col("_by")))
    ranks = met.groupBy("window_start", by, "n", "quantile").agg(
        F.avg((F.col("_v") < F.col("quantile")).cast("int")).alias("low"), F.avg((F.col("_v") <= F.col("quantile")).cast("int")).alias("high"))
    return ranks.select("window_start", by, "n", ((F.col("low") <= q + error) & (F.col("high") >= q - error)).alias("within"))


def _lower_bound(le: Column, bounds: Sequence[float]) -> Column:
    """Upper bound of the bucket before ``le``."""
    ordered = sorted(bounds)
    lower = F.lit(min(0.0, float(ordered[0])))
    for previous, bound in zip(ordered, ordered[1:]):
        lower = F.when(le == bound, F.lit(float(previous))).otherwise(lower)
    return lower
