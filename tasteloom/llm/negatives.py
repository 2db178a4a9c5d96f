"""Hard negatives by blocks: Strassen products of anchor and candidate tiles, heaps that merge.

Anchors are cut into parts and all rows into groups, both by place and so of even size whatever their
values; every part meets every group in one cell. In a cell the whole-number products come tile by tile from
Strassen's recursion, padded with zeros. A first pass keeps the best rows of an anchor's own label, the
positives; their scores set the windows in which a second pass keeps the best rows of other labels. Heaps of
tiles merge within a cell, those of cells in a ranking that each task begins before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.llm.topk import whole_numbers
from tasteloom.sources.scratch import cut

POSITIVES, NEGATIVES = 5, 10
# Bounds of a negative's score in hundredths of the positive's.
LOW, HIGH = 30, 90
# Anchors of a part, rows of a group, rows of a tile, and the side at which the recursion ends.
PART, GROUP, TILE, LEAF = 32_768, 8_192, 512, 16
LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, exact where it fits in 63 bits.

    Odd sides get a row or column of zeros. Additions are whole; sums on the way may wrap around at 64
    bits, which the last additions undo. A block with a side of at most ``leaf`` is multiplied directly.
    """
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return _leaf(a, b)
    a = np.pad(a, ((0, m % 2), (0, d % 2)))
    b = np.pad(b, ((0, d % 2), (0, n % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), dtype=np.int64)
    out[:i, :j], out[:i, j:] = m1 + m4 - m5 + m7, m3 + m5
    out[i:, :j], out[i:, j:] = m2 + m4, m1 - m2 + m3 + m6
    return out[:m, :n]


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Doubles hold every sum where the largest possible is below 2**53; else the product is taken in int64."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), dtype=np.int64)
    most = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(float) @ b.astype(float)).astype(np.int64)
    return a @ b


class Heaps:
    """The ``size`` best (score, id) of each owner, best first, ties to the smaller id; LEAST stands for none."""

    def __init__(self, owners: int, size: int):
        self.score = np.full((owners, size), LEAST)
        self.id = np.full((owners, size), np.iinfo(np.int64).max)

    def merge(self, owners: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take in other heaps of the given owners."""
        score, ids = np.hstack([self.score[owners], score]), np.hstack([self.id[owners], ids])
        order = np.lexsort((ids, ~score), axis=-1)[:, : self.score.shape[1]]
        self.score[owners], self.id[owners] = (np.take_along_axis(x, order, axis=1) for x in (score, ids))

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """Take in a tile: a row per owner from ``first`` on, a column per id, ids in rising order."""
        shown = np.where(fits, scores, LEAST)
        held = self.score[first : first + len(shown), -1]
        # Only owners whose best of the tile reaches their last entry.
        rows = np.flatnonzero(shown.max(axis=1) >= np.maximum(held, LEAST + 1)) if shown.size else []
        if not len(rows):
            return
        order = np.argsort(~shown[rows], axis=1, kind="stable")[:, : self.score.shape[1]]
        self.merge(first + rows, np.take_along_axis(shown[rows], order, axis=1), ids[order])

    def listed(self, owners: pd.DataFrame, own: list[str], names: list[str]) -> pd.DataFrame:
        """One row per entry: columns of its owner, then id and score."""
        row, col = np.nonzero(self.score > LEAST)
        held = owners[own].iloc[row]
        return pd.DataFrame(dict(zip(names, [*(held[c].to_numpy() for c in own), self.id[row, col], self.score[row, col]])))


def _vectors(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _tiles(anchors: pd.DataFrame, rows: pd.DataFrame, width: int, tile: int, leaf: int) -> Iterator[tuple]:
    """(slice of anchors, rows of a tile, their products) of all pairs of tiles, anchors outermost."""
    asked, offered = _vectors(anchors["q"], width), _vectors(rows["q"], width)
    for start in range(0, len(anchors), tile):
        own = slice(start, min(start + tile, len(anchors)))
        for at in range(0, len(rows), tile):
            part = slice(at, min(at + tile, len(rows)))
            yield own, part, strassen(asked[own], np.ascontiguousarray(offered[part].T), leaf)


def best_positives(anchors: pd.DataFrame, rows: pd.DataFrame, width: int, size: int, tile: int = TILE, leaf: int = LEAF) -> pd.DataFrame:
    """(at, anchor_id, positive_id, score): per anchor the best other rows of its label in this cell."""
    rows = rows.sort_values("id", kind="stable", ignore_index=True)
    ids, labels, places = (rows[c].to_numpy() for c in ("id", "label", "at"))
    heaps = Heaps(len(anchors), size)
    for own, part, scores in _tiles(anchors, rows, width, tile, leaf):
        same = anchors["label"].to_numpy()[own, None] == labels[part]
        heaps.offer(own.start, scores, ids[part], same & (anchors["at"].to_numpy()[own, None] != places[part]))
    return heaps.listed(anchors, ["at", "id"], ["at", "anchor_id", "positive_id", "score"])


def best_negatives(
    asked: pd.DataFrame, rows: pd.DataFrame, width: int, size: int, low: int, high: int, tile: int = TILE, leaf: int = LEAF
) -> pd.DataFrame:
    """(at, nth, anchor_id, positive_id, positive_score, negative_id, score): per anchor and positive the best
    rows of other labels in the positive's window, in this cell. ``asked`` has a row per anchor with lists of its
    positives and their scores."""
    rows = rows.sort_values("id", kind="stable", ignore_index=True)
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    # A row per anchor and positive; whole bounds of the window from numbers of any size.
    counts = asked["positives"].map(len).to_numpy()
    pairs = asked[["at", "id"]].loc[np.repeat(np.arange(len(asked)), counts)].reset_index()
    pairs["nth"] = np.concatenate([np.arange(1, n + 1) for n in counts])
    pairs["positive_id"] = np.concatenate(asked["positives"].to_list())
    pairs["positive_score"] = np.concatenate(asked["scores"].to_list())
    least = np.array([-(-low * s // 100) for s in map(int, pairs["positive_score"])], dtype=np.int64)
    most = np.array([high * s // 100 for s in map(int, pairs["positive_score"])], dtype=np.int64)
    owner = pairs["index"].to_numpy()
    heaps = Heaps(len(pairs), size)
    for own, part, scores in _tiles(asked, rows, width, tile, leaf):
        mine = slice(*np.searchsorted(owner, [own.start, own.stop]))
        of, other = owner[mine] - own.start, asked["label"].to_numpy()[own, None] != labels[part]
        shown = scores[of]
        heaps.offer(mine.start, shown, ids[part], other[of] & (shown >= least[mine, None]) & (shown <= most[mine, None]))
    names = ["at", "nth", "id", "positive_id", "positive_score"]
    return heaps.listed(pairs, names, ["at", "nth", "anchor_id", "positive_id", "positive_score", "negative_id", "score"])


def hard_negatives(
    df: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    part: int = PART, group: int = GROUP, tile: int = TILE, leaf: int = LEAF,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x is taken as floor(scale * x), a score is the inner product with the anchor. The positives of an
    anchor, a row where ``is_anchor`` holds, are its best other rows of the same label. Of each positive the
    best rows of other labels are returned whose score is ``low`` to ``high`` hundredths of the positive's. Ties go to
    the smaller key. With fewer rows than asked for all are taken; a positive without a row in its window has none.

    Rows without key, label or vector, or with a null or non-finite component, take no part. Rows are told apart by
    place: a repeated row is another row, also for its twin. Vectors of different widths are filled with zeros. An
    empty table gives no rows. Other columns are dropped, whatever their names. Scores that could pass 63 bits
    are an error before anything is multiplied.
    """
    named = df.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).where("id IS NOT NULL AND label IS NOT NULL")
    # The place is stored before it is used: cells and the twin test rest on it.
    rows = whole_numbers(named, "v", scale).select("id", "label", "asks", "q", F.monotonically_increasing_id().alias("at"))
    rows = cut(rows, "rows")
    largest = F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q")))
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("anchors"), F.max(F.size("q")).alias("width"), F.max(largest).alias("largest")
    ).first()
    width = max(stats["width"] or 0, 1)
    if (stats["largest"] or 0) ** 2 * width >= 1 << 63:
        raise ValueError("scores could pass 63 bits")
    if not stats["anchors"]:
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    kind = "array<int>" if (stats["largest"] or 0) < 1 << 31 else "array<bigint>"
    groups, parts = -(-stats["n"] // group), -(-stats["anchors"] // part)
    rows = rows.withColumn("q", F.col("q").cast(kind))
    anchors = cut(rows.where("asks"), "anchors")

    found = _cells(
        rows, anchors, groups, parts, lambda a, r: best_positives(a, r, width, positives, tile, leaf),
        "at long, anchor_id long, positive_id long, score long",
    )
    first = Window.partitionBy("at").orderBy(F.col("score").desc(), "positive_id")
    ranked = found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives)
    # At most ``positives`` entries a list.
    entries = F.array_sort(F.collect_list(F.struct("nth", "positive_id", "score")))
    lists = ranked.groupBy("at").agg(entries.alias("l")).select(
        "at", F.col("l.positive_id").alias("positives"), F.col("l.score").alias("scores"))
    asked = cut(anchors.join(lists, "at"), "asked")

    met = _cells(
        rows, asked, groups, parts, lambda a, r: best_negatives(a, r, width, negatives, low, high, tile, leaf),
        "at long, nth long, anchor_id long, positive_id long, positive_score long, negative_id long, score long",
    )
    best = Window.partitionBy("at", "nth").orderBy(F.col("score").desc(), "negative_id")
    kept = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return kept.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))


def _cells(
    rows: DataFrame, anchors: DataFrame, groups: int, parts: int, look: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """``look`` at each part of the anchors with each group of the rows.

    Rows are sent once per part and anchors once per group; a cell holds about ``part`` and ``group`` of them.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("at"), F.lit(n)).cast("int")
    names = [c for c in anchors.columns if c != "asks"]
    left = rows.select("id", "label", "q", "at", dealt(groups).alias("group"), every(parts).alias("part"))
    right = anchors.select(*names, dealt(parts).alias("part"), every(groups).alias("group"))

    def meet(offered: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(offered) or not len(asking):
            return pd.DataFrame({name.split()[0]: pd.Series([], dtype="int64") for name in schema.split(", ")})
        return look(asking.drop(columns=["group", "part"]), offered.drop(columns=["group", "part"]))

    return left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInPandas(meet, schema)
