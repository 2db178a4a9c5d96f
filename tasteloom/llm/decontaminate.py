"""Benchmark passages in documents, also with edits: pigeonhole pieces, verified by Myers' algorithm.

An item of m characters may be met with e = floor(rate * m) edits. Cut into e + 1 pieces, at least one
piece occurs unchanged in any such passage. Taken in pairs, some pair even has at most one edit, so its second
piece must nearly follow the first. An automaton finds all pieces in one pass over a text; hits
that pass the test of their pair name windows, and the bit-parallel edit distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import with_running_sum

RATE = 0.1
# Benchmark characters per automaton; a larger benchmark takes several passes over the texts.
BLOCK_CHARS = 4_000_000
GRAM = 4
LEAK = "array<struct<item_id: bigint, distance: int, start: int, stop: int>>"


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def normal_places(text: str) -> list[int]:
    """For each character of ``normal(text)``, the place in ``text`` it comes from."""
    places, gap = [], -1
    for i, c in enumerate(text):
        if c.isspace():
            gap = i if gap < 0 else gap
            continue
        if gap >= 0 and places:
            places.append(gap)
        gap = -1
        places.extend([i] * len(c.lower()))
    return places


def pieces(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, end) of ``edits + 1`` parts of near-equal length."""
    n = edits + 1
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


def masks(pattern: str) -> dict[str, int]:
    """Bit i of a character's number is set where the pattern has it at place i."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | (1 << i)
    return out


def myers(peq: dict[str, int], m: int, text: str, anchored: bool) -> tuple[int, int]:
    """(distance, end): the least edit distance of the whole pattern to a part of ``text``, and where
    that part first ends. ``anchored``: the part starts where the text starts; else anywhere.

    A column of the distance matrix is kept as two numbers of m bits, the places where it
    rises and falls by one.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    rise, fall, score = full, 0, m
    best, end, carry = m, 0, 1 if anchored else 0
    for at, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        vertical = eq | fall
        diagonal = ((((eq & rise) + rise) ^ rise) | eq) & full
        up = fall | (~(diagonal | rise) & full)
        down = rise & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = ((up << 1) | carry) & full
        down = (down << 1) & full
        rise = down | (~(vertical | up) & full)
        fall = up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Item:
    """A benchmark text ready for verification."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.id, self.text, self.size = item_id, text, len(text)
        self.edits = int(self.size * rate)
        self.masks, self.back = masks(text), masks(text[::-1])
        self.grams = {text[i : i + GRAM] for i in range(self.size - GRAM + 1)}

    def best_in(self, window: str) -> tuple[int, int, int] | None:
        """(distance, start, end) of the best match within the budget."""
        # An edit changes GRAM grams at most: windows sharing too few cannot match.
        if self.grams:
            shared = self.grams.intersection([window[i : i + GRAM] for i in range(len(window) - GRAM + 1)])
            if len(shared) < len(self.grams) - GRAM * self.edits:
                return None
        distance, end = myers(self.masks, self.size, window, anchored=False)
        if distance > self.edits:
            return None
        # Backwards from the end, the same distance is first met at the nearest start.
        _, length = myers(self.back, self.size, window[end - 1 :: -1] if end else "", anchored=True)
        return distance, end - length, end


def beside(text: str, start: int, stop: int, side: int, first: str, second: str) -> bool:
    """Whether the piece ``first + second`` can lie right of ``stop``, or left of ``start``, with one edit.

    One edit leaves one half unchanged: the near one in its place, or the far one moved by one at most.
    """
    if side > 0:
        far = stop + len(first)
        return text.startswith(first, stop) or second in text[far - 1 : far + len(second) + 1]
    far = start - len(second)
    return text.endswith(second, 0, start) or first in text[max(0, far - len(first) - 1) : max(0, far + 1)]


class Finder:
    """All items of one block of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [Item(i, t, rate) for i, t in items if t]
        owners: dict[str, list[tuple[int, int, int, str, str]]] = {}
        for n, item in enumerate(self.items):
            cuts = pieces(item.size, item.edits)
            for i, (start, end) in enumerate(cuts):
                # The other of the pair, in halves; an odd last piece has none and needs no test.
                side = 0 if i % 2 == 0 and i + 1 == len(cuts) else 1 - i % 2 * 2
                a, b = cuts[i + side]
                half = (a + b) // 2
                owners.setdefault(item.text[start:end], []).append(
                    (n, start, side, item.text[a:half], item.text[half:b])
                )
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        if owners:
            self.automaton.make_automaton()

    def leaks(self, text: str | None) -> list[dict]:
        """The best match of each item in the text, in original places; ties to the first."""
        found = normal(text) if self.items else ""
        diagonals: dict[int, list[int]] = {}
        if found:
            for last, (size, where) in self.automaton.iter(found):
                for n, offset, side, near, far in where:
                    if not side or beside(found, last - size + 1, last + 1, side, near, far):
                        diagonals.setdefault(n, []).append(last - size + 1 - offset)
        matches = []
        for n, starts in diagonals.items():
            item, best = self.items[n], None
            # Hits of one passage lie on diagonals at most e apart: join what overlaps.
            starts.sort()
            first = previous = starts[0]
            for start in [*starts[1:], None]:
                if start is not None and start - previous <= item.edits:
                    previous = start
                    continue
                low = max(0, first - item.edits)
                hit = item.best_in(found[low : previous + item.size + item.edits])
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], hit[1] + low, hit[2] + low)
                first = previous = start
            if best:
                matches.append((item.id, *best))
        if not matches:
            return []
        places = normal_places(text)
        return [
            {"item_id": i, "distance": d, "start": places[a], "stop": places[b - 1] + 1} for i, d, a, b in sorted(matches)
        ]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Benchmark items in blocks of about BLOCK_CHARS characters; an item is never cut."""
    rows = benchmark.where(F.col(item).isNotNull()).select(
        F.col(item).cast("long").alias("id"), F.col(text).alias("text"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n"),
    )
    placed = with_running_sum(rows, [F.col("id"), F.col("text")], "n", "upto").withColumn(
        "block", F.floor((F.col("upto") - F.col("n")) / BLOCK_CHARS)
    )
    for row in placed.select("block").distinct().orderBy("block").collect():
        block = placed.where(F.col("block") == row["block"]).select("id", "text").distinct().collect()
        yield [(r["id"], normal(r["text"])) for r in block]


def _leaks(text: Column, block: list[tuple[int, str]], rate: float) -> Column:
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(block, rate)
        for batch in texts:
            yield pd.Series([finder.leaks(t) for t in batch])

    return F.pandas_udf(leaks, LEAK)(text)


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    rate: float = RATE, name: str = "leaks",
) -> DataFrame:
    """``docs`` with an array of (item_id, distance, start, stop): benchmark items found in the text.

    Case and white space are not edits. Places are characters of the whole original text, the end
    exclusive. Null and empty texts, and null or empty items, match nothing; items without a
    number are left out. Items of equal text, and repeated documents, are each reported. An empty
    benchmark gives empty arrays. A column called ``name`` is replaced.
    """
    found = [_leaks(F.col(text), block, rate) for block in _blocks(benchmark, item, item_text)]
    if not found:
        return docs.withColumn(name, F.array().cast(LEAK))
    return docs.withColumn(name, F.concat(*found) if len(found) > 1 else found[0])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, columns unchanged."""
    flag = "_leaks"
    while flag in docs.columns:
        flag += "_"
    return with_leaks(docs, benchmark, text, rate=rate, name=flag).where(F.size(flag) == 0).select(*docs.columns)
