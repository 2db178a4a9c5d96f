"""A mix of sources by weight, cut to exact word budgets.

Each source gets a budget: its weight's share of all words asked for, but no more than a number of repeats
of itself; what a source cannot give goes to the others by weight. Rows lie in a random order fixed by
a hash of their key. They are sorted by ranges over all sources at once, so a source with most of the
rows is spread like any other, and a prefix sum over the ranges says where each source's budget ends.
Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.llm.common import with_running_sum
from tasteloom.operators.joins import hot_keys, join_unique
from tasteloom.operators.ordering import with_position
from tasteloom.sources.scratch import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
# Words asked for over all words there are, and most repeats of a source.
SHARE = Fraction(3, 2)
REPEATS = 2


def n_words(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def budgets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size, target, before) from (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn. With a level of words per weight a
    source's target is its weight times the level, or ``repeats`` times its size if that is less. Sources of
    the smallest ratio of size to weight are full first, so in the order of that ratio the full ones are
    a beginning, and running sums over the order give the level that follows from each beginning.
    ``before`` is the size of all sources ahead in code point order.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = cut(with_position(sizes, order, "_turn"), "sources")
    turn = F.array(*[F.lit(w) for w in weights])
    rows = placed.withColumn("_weight", F.element_at(turn, (F.col("_turn") % len(weights) + 1).cast("int")))
    sums = with_running_sum(rows, [F.col("_turn")], "source_size", "_upto")
    sums = cut(sums.withColumn("before", F.col("_upto") - F.col("source_size")).drop("_upto"), "sums")
    # Exact order of size / weight: both multiplied by the same number, which every weight divides.
    common = 1
    for w in weights:
        common *= w
    by_ratio = [(F.col("source_size") * (F.lit(common) / F.col("_weight")).cast("long")), F.col("_turn")]
    filled = cut(with_running_sum(sums, by_ratio, "source_size", "_full"), "filled")
    weighed = cut(with_running_sum(filled, by_ratio, "_weight", "_heavy"), "weighed")
    # What the sources up to this one leave over, and the weight left to share it.
    total = weighed.agg(F.sum("source_size").alias("words"), F.sum("_weight").alias("weight")).first()
    words, heavy = total["words"] or 0, total["weight"] or 0
    asked, per = share.numerator * words, share.denominator
    ahead_full = F.col("_full") - F.col("source_size")
    ahead_heavy = F.col("_heavy") - F.col("_weight")
    left = F.lit(asked) - F.lit(per * repeats) * ahead_full
    rest = F.lit(per) * (F.lit(heavy) - ahead_heavy)
    # The first source that the level of those not yet full does not fill.
    fits = left * F.col("_weight") <= F.lit(repeats) * F.col("source_size") * rest
    level_at = F.struct("_full", "_heavy", left.alias("left"), rest.alias("rest"))
    first = weighed.where(fits).agg(F.min(level_at).alias("first")).first()["first"]
    most = (F.lit(repeats) * F.col("source_size")).cast("double")
    if first is None:
        target = most
    else:
        # A literal below 2**31 would be 32 bit, as are the weights, and their product overflow.
        shared = F.lit(first["left"]).cast("long") * F.col("_weight")
        level = shared.cast("double") / F.lit(float(first["rest"]))
        full = shared > F.lit(repeats) * F.col("source_size") * F.lit(first["rest"])
        target = F.when(full, most).otherwise(level)
    return weighed.select("source", "source_size", target.alias("target"), "before")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
    weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS,
) -> DataFrame:
    """(key, source, size, source_size, target, copies, part, taken): what the mix takes of each document.

    ``taken`` words are ``copies`` whole repeats and the first ``part`` words of one more. A source takes
    whole repeats of all its rows as often as they fit in its target, then rows in the order of the md5 of seed
    and key while the rest lasts; the last of them gives the words that fill it up. So a source's taken words are
    its target, rounded down.

    Rows with null text have no words and are not taken; without any words all targets are 0. Rows without a key
    come after all others of their source. A null source is one source, the last. Repeated rows are rows of their
    own; which of several equal ones is cut does not show. An empty table gives no rows. Other columns are
    dropped, whatever their names.
    """
    name = F.col(source).cast("string")
    order_key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    rows = docs.select(
        F.col(key).alias("_key"), name.alias("source"), n_words(F.col(text)).alias("size"), order_key.alias("_hash"),
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("_name"),
    )
    # Told apart by place in the end, so that no key, however often it repeats, fills a range of the sort alone.
    rows = cut(rows.withColumn("_place", F.monotonically_increasing_id()), "words")
    counts = cut(rows.groupBy("_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"), F.first("source").alias("source")), "sizes")
    shares = budgets(counts.select("source", "source_size"), weights, share, repeats)
    shares = cut(shares.withColumn("_name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source"), "shares")

    order = [
        F.col("source").isNull(), F.col("source"), F.col("_hash").isNull(), F.col("_hash"), F.col("_key"),
        F.col("size"), F.col("_place"),
    ]
    summed = with_running_sum(rows, order, "size", "_upto")
    told = join_unique(summed, shares, "_name", "inner", hot_keys(counts, "_name"))
    whole = F.expr("CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) DIV source_size ELSE 0 END")
    told = told.withColumn("copies", F.when(F.col("size") > 0, whole).otherwise(0).cast("long"))
    rest = F.floor("target").cast("long") - whole * F.col("source_size")
    ahead = F.col("_upto") - F.col("size") - F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - ahead)).cast("long")
    taken = F.col("copies") * F.col("size") + F.col("part")
    return told.withColumn("part", part).select(
        F.col("_key").alias(key), "source", "size", "source_size", "target", "copies", "part", taken.alias("taken")
    )
