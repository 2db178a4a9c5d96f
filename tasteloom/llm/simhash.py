"""SimHash fingerprints and groups of documents whose fingerprints nearly agree.

Equal fingerprints are one entry. The 64 bits are two segments of 32. Two entries within
two bits differ by at most one in the first segment or not at all in the second, so the ball of radius one around
the first segment and the second segment itself are looked up. As a segment can be shared by
very many entries, each table is keyed by more bits: the pieces of the other segment of which, by
the same argument, one must agree too. Matches are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.components import components
from tasteloom.sources.scratch import cut

SEED = 42
RADIUS = 2
LOW = 0xFFFFFFFF


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of the word shingles of a whole text, unsigned; 0 where there is no word."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        chunk = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number, without the text."""
    rest = [c for c in docs.columns if c != text]

    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.array([fingerprint(t, words) for t in batch], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return docs.select(*rest, F.pandas_udf(prints, "long")(F.col(text)).alias(name))


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(LOW))


def _pieces(part: Column, cuts: list[int]) -> list[Column]:
    """The 32 bits cut at the given places."""
    return [
        F.shiftright(part, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])
    ]


def _entry(kind: int, segment: Column, piece: Column) -> Column:
    """A lookup key: which table, a whole segment, a piece of the other segment, as one number.

    Different keys with one number only add lookups, as the distance is verified.
    """
    return F.xxhash64(F.lit(kind), segment, piece)


THIRDS, HALVES = [0, 11, 22, 32], [0, 16, 32]


def table_keys(fp: Column) -> Column:
    """Keys under which an entry is stored."""
    high, low = _high(fp), _low(fp)
    same_high = [_entry(i, high, p) for i, p in enumerate(_pieces(low, THIRDS))]
    near_high = [_entry(3 + i, high, p) for i, p in enumerate(_pieces(low, HALVES))]
    same_low = [_entry(5 + i, low, p) for i, p in enumerate(_pieces(high, THIRDS))]
    return F.array(*same_high, *near_high, *same_low)


def probe_keys(fp: Column) -> Column:
    """Keys under which partners within two bits are stored.

    High segment equal: two bits may differ in the low one, so one of its thirds agrees.
    High segment one bit off, on the ball's surface: one bit may differ in the low one, so a half agrees.
    The partner that lacks the bit asks for the one that has it, which halves the ball.
    Otherwise the low segment agrees, and two bits differ in the high one.
    """
    high, low = _high(fp), _low(fp)
    same_high = [_entry(i, high, p) for i, p in enumerate(_pieces(low, THIRDS))]
    near_high = [
        F.when(high.bitwiseAND(F.lit(1 << bit)) == 0, _entry(3 + i, high.bitwiseOR(F.lit(1 << bit)), p))
        for bit in range(32) for i, p in enumerate(_pieces(low, HALVES))
    ]
    same_low = [_entry(5 + i, low, p) for i, p in enumerate(_pieces(high, THIRDS))]
    return F.array_compact(F.array(*same_high, *near_high, *same_low))


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): pairs of the distinct numbers ``fp`` that differ in at most two bits, in either order.

    A pair found through several keys appears several times. A number has at most 2,080 such
    partners, and the keys hold 43 or more of the 64 bits, so lookups stay small where many
    entries share a segment.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError("the tables serve distances up to two bits")
    stored = prints.select(F.col("fp").alias("b"), F.explode(table_keys(F.col("fp"))).alias("k"))
    probes = prints.select(F.col("fp").alias("a"), F.explode(probe_keys(F.col("fp"))).alias("k"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    once = (F.col("a") < F.col("b")) | (_high(F.col("a")) != _high(F.col("b")))
    # Merged at every size: both sides grow with the documents.
    found = probes.hint("merge").join(stored, (probes["k"] == stored["k"]) & (F.col("a") != F.col("b")) & once & near)
    return found.select("a", "b")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = RADIUS,
) -> DataFrame:
    """(key, fp, component_id): each row's fingerprint and the smallest key of its group.

    Rows are linked where fingerprints differ in at most ``radius`` bits; groups are what links
    connect. Null and empty texts have fingerprint 0 and are linked like others. Rows without a key
    take part; a group with no key at all has none. Repeated rows get equal answers, and an
    empty table gives no rows. Other columns are dropped.
    """
    prints = cut(with_fingerprint(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", words), "prints")
    entries = cut(prints.groupBy("fp").agg(F.min("key").alias("least")), "entries")
    pairs = near_pairs(entries.select("fp"), radius).distinct()
    roots = components(pairs, entries.select(F.col("fp").alias("v")))
    rooted = cut(entries.join(roots.withColumnRenamed("v", "fp"), "fp").select("fp", "root", "least"), "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = rooted.select("fp", "root").join(groups, "root").select("fp", "component_id")
    return prints.join(answer, "fp").select(F.col("key").alias(key), "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """The unsigned number in 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest key; columns unchanged.

    Groups are those of ``near_duplicates``, which takes ``how``. Rows without a key stay. A key that several
    rows have goes if one of them is near a smaller key; else one of its rows stays, the same at every run. An
    empty table gives no rows. Columns may have any name.
    """
    told = near_duplicates(docs, key, text, **how).where(F.col(key).isNotNull())
    leads, n = F.col("component_id") == F.col(key), F.count(F.lit(1))
    kept = cut(told.groupBy(key).agg(F.min(leads).alias("leads"), n.alias("n")).where("leads").select(F.col(key).alias("kept"), "n"), "kept")
    # Merged at every size: both sides grow with the documents.
    own, once = docs.hint("merge").alias("d"), kept.where("n = 1").alias("k")
    rows = own.join(once, F.col(f"d.`{key}`") == F.col("k.kept"), "left_semi")
    repeated = own.join(kept.where("n > 1").alias("k"), F.col(f"d.`{key}`") == F.col("k.kept"), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = repeated.select(F.col(f"`{key}`").alias("k"), row.alias("row")).groupBy("k").agg(
        F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return docs.where(F.col(key).isNull()).unionByName(rows).unionByName(one)
