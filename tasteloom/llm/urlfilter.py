"""Exact membership of URL keys in a rule list, by a cascade of Bloom filters.

Level 1 holds the listed keys. Every key of the corpus that passes it without being listed goes into
level 2, every listed key that passes level 2 goes into level 3, and so on until nothing passes
wrongly. As the levels are built against all keys of the corpus, a key of the corpus is listed if the
number of levels it passes before the first miss is odd. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.sources.scratch import cut

# Hash functions per filter after the first; with 1.44 bits per key each halves what passes.
LATER_HASHES = 1
# Largest filter in bits. It travels inside the plan, so its size is checked and not assumed.
MAX_BITS = 1 << 26


@dataclass(frozen=True)
class Rule:
    """A rule fits its host and all subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    seed: int
    hashes: int
    bits: int
    words: list[int]


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str) -> Column:
    """After the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Keys of all rules that could fit, longest first.

    Only as many host labels and path characters as some rule has are tried, so the array is
    as long as the rule list is varied, however long the url is.
    """
    labels = sorted({r.host.count(".") + 1 for r in rules}, reverse=True)
    lengths = sorted({len(r.path) for r in rules}, reverse=True)
    parts = F.split(host, r"\.")
    keys = [
        F.when(
            (F.size(parts) >= n) & (F.length(path) >= m),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)),
        )
        for n in labels for m in lengths
    ]
    # Longest first; of equally long ones the one with the longer host.
    ordered = F.transform(
        F.filter(F.array(*keys), lambda k: k.isNotNull()),
        lambda k, i: F.struct((-F.length(k)).alias("size"), i.alias("at"), k.alias("key")),
    )
    return F.transform(F.array_sort(ordered), lambda k: k["key"])


def _slots(key: Column, seed: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + i)), F.lit(bits)) for i in range(hashes)]


def _filter(keys: DataFrame, seed: int, hashes: int, bits: int) -> Level:
    """Bits set by the keys, ORed per 64-bit word within tasks first."""
    bits = max(64, ceil(bits / 64) * 64)
    if bits > MAX_BITS:
        raise ValueError(f"a filter of {bits} bits is over the bound of {MAX_BITS}")
    slots = keys.select(F.explode(F.array(*_slots(F.col("key"), seed, hashes, bits))).alias("slot"))
    word = F.shiftright("slot", 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    rows = slots.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("set")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row["word"]] = row["set"]
    return Level(seed, hashes, bits, words)


def passes(key: Column, level: Level) -> Column:
    words = F.lit(level.words).cast("array<bigint>")
    tests = None
    for slot in _slots(key, level.seed, level.hashes, level.bits):
        word = F.element_at(words, (F.shiftright(slot, 6) + 1).cast("int"))
        test = F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1
        tests = test if tests is None else tests & test
    return tests


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Filters that tell the ``key`` rows of ``listed`` from all other ``key`` rows of ``universe``.

    Both are distinct non-null keys. The first filter is sized so that about as many foreign
    keys pass as are listed, which keeps all levels near the size of the list, with a
    logarithm of the universe: their sum is bounded by the list, not by the corpus.
    """
    inside = cut(listed.select("key"), "listed")
    n = inside.count()
    if not n:
        return []
    others = universe.select("key").join(F.broadcast(inside), "key", "left_anti")
    total = others.count()
    rate = min(0.5, n / max(total, 1))
    hashes = max(1, round(log2(1 / rate)))
    levels = [_filter(inside, 1, hashes, ceil(n * hashes / log(2)))]
    here, other = inside, cut(others.where(passes(F.col("key"), levels[0])), "passed")
    while size := other.count():
        level = _filter(other, len(levels) + 1, LATER_HASHES, ceil(size * LATER_HASHES / log(2)))
        levels.append(level)
        here, other = other, cut(here.where(passes(F.col("key"), level)), "passed")
    return levels


def listed_in(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed: the cascade read from its last level backwards.

    Missing level i means "not in the set that level i holds"; passing the last level is right.
    """
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        # A miss at level i (from 0): not listed for even i, listed for odd i.
        answer = F.when(passes(key, levels[i]), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", unlisted: str = "allow") -> DataFrame:
    """``pages`` with (host, path, rule, verdict); the longest fitting rule wins.

    Urls that no listed key fits get ``unlisted`` and a null rule, null urls and urls without
    ``://`` among them. Repeated urls get equal answers; an empty table gives no rows. Other
    columns are passed through; columns named like the results are replaced. The driver holds
    the rules and filters of their size, never urls.
    """
    judged = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    keys = candidate_keys(F.col("host"), F.col("path"), rules)
    universe = cut(judged.select(F.explode(keys).alias("key")).distinct(), "universe")
    verdicts = {r.key: r.verdict for r in rules}
    listed = pages.sparkSession.createDataFrame([(k,) for k in verdicts], "key string")
    levels = build_cascade(universe, listed)
    fitting = F.filter(keys, lambda k: listed_in(k, levels)) if levels else F.array().cast("array<string>")
    # No key is outside the universe, so what the cascade lets through is a rule.
    names = F.create_map(*[F.lit(x) for pair in verdicts.items() for x in pair]) if verdicts else None
    rule = F.get(fitting, F.lit(0))
    verdict = F.coalesce(F.element_at(names, F.col("rule")), F.lit(unlisted)) if verdicts else F.lit(unlisted)
    return judged.withColumn("rule", rule).withColumn("verdict", verdict)
