"""Exact top-k inner products over whole-number vectors, longest vectors first.

Vectors are ordered by length and cut into blocks. A query first meets the block of the longest
vectors, which gives it a lower bound of its k-th score; it is sent on only to blocks whose longest
vector could reach that bound by Cauchy-Schwarz. Within a block the leading dimensions of an SVD
rotation give a partial score, and the lengths of what is left bound the rest; only vectors that
can still enter the list get a whole-number product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.operators.ordering import with_position
from tasteloom.sources.scratch import cut

BLOCK = 1024
# Queries that share a part: every part is sent the blocks it reaches, so few parts mean few copies. A part of vectors
# of 64 numbers takes 4 MB in a task.
PART = 8192
# Share of the squared length that the leading dimensions should hold.
ENERGY = 0.9


def whole_numbers(df: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """``df`` with ``q``: floor(scale * component); rows with a null or non-finite component go."""
    x = F.col(vector)
    fine = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != F.lit(float("inf")))
    )
    return df.where(fine).withColumn("q", F.transform(x, lambda v: F.floor(v.cast("double") * scale)))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows as doubles; shorter vectors are filled with zeros. Whole numbers stay exact in doubles."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _gram(items: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products of all vectors: one width-square matrix per task."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch["q"], width)
            total += m.T @ m
        yield pd.DataFrame({"i": np.arange(width), "g": list(total)})

    rows = items.select("q").mapInPandas(partial, "i int, g array<double>")
    flat = rows.select("i", F.posexplode("g").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for row in flat.collect():
        out[row["i"], row["j"]] = row["v"]
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def search_block(
    queries: np.ndarray, at: np.ndarray, bounds: np.ndarray, items: np.ndarray, ids: np.ndarray,
    places: np.ndarray, rotation: np.ndarray, lead: int, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, item ids, scores): the best k of the block that reach the query's bound.

    ``at`` and ``places`` say which row a query or an item is; a query does not meet itself.
    """
    order = np.argsort(-np.einsum("ij,ij->i", items, items), kind="stable")
    items, ids, places = items[order], ids[order], places[order]
    turned, asked = items @ rotation, queries @ rotation
    rest = np.sqrt(np.maximum(np.einsum("ij,ij->i", turned[:, lead:], turned[:, lead:]), 0))
    asked_rest = np.sqrt(np.maximum(np.einsum("ij,ij->i", asked[:, lead:], asked[:, lead:]), 0))
    lengths = np.sqrt(np.einsum("ij,ij->i", items, items))
    for i in range(len(queries)):
        bound, own = bounds[i], np.linalg.norm(queries[i])
        # Rounding of the rotation and of the lengths.
        slack = 1e-9 * (1 + own * (lengths[0] if len(lengths) else 0))
        # Longest first: past this place no vector reaches the bound.
        reach = int(np.searchsorted(-lengths * own, -(bound - slack), side="right"))
        if not reach:
            continue
        partial = turned[:reach, :lead] @ asked[i, :lead] + rest[:reach] * asked_rest[i]
        keep = np.flatnonzero((partial >= bound - slack) & (places[:reach] != at[i]))
        scores = items[keep] @ queries[i]
        keep, scores = keep[scores >= bound], scores[scores >= bound]
        best = _best(ids[keep], scores, k)
        if len(best):
            yield i, ids[keep[best]], scores[best]


def top_k(
    df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    block: int = BLOCK, part: int = PART, energy: float = ENERGY,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` holds, the k best other rows.

    Ties go to the smaller key. Vectors null or with null or non-finite components, and rows
    without a key, take no part. Rows are told apart by place: a repeated row is a candidate for its
    twin. Vectors of different widths are filled with zeros; an empty vector scores 0 with
    all. Fewer than k other rows give shorter lists; an empty table gives none.
    """
    rows = whole_numbers(df.where(F.col(key).isNotNull()), vector, scale)
    square = F.aggregate("q", F.lit(0).cast("double"), lambda a, v: a + (v * v).cast("double"))
    rows = rows.select(
        F.col(key).cast("long").alias("id"), "q", square.alias("square"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    # Longest first; the whole row decides ties, so that a place is the same at every reading.
    order = [F.col("square").desc(), F.col("id"), F.col("q")]
    placed = cut(with_position(rows, order, "at").withColumn("block", (F.col("at") / block).cast("int")), "items")
    largest = F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q")))
    stats = placed.agg(F.max(F.size("q")), F.count(F.lit(1)), F.max(largest)).first()
    # What is shuffled and sent to Python is as narrow as the numbers allow.
    kind = next((k for k, bits in (("smallint", 15), ("int", 31)) if (stats[2] or 0) < 1 << bits), "bigint")
    items = placed.withColumn("q", F.col("q").cast(f"array<{kind}>"))
    width, count = max(stats[0] or 1, 1), stats[1]
    answer = "query_id long, rank int, vec_id long, score long"
    if not count:
        return df.sparkSession.createDataFrame([], answer)
    values, vectors = np.linalg.eigh(_gram(items, width))
    rotation, share = vectors[:, ::-1], np.cumsum(values[::-1]) / max(values.sum(), 1e-300)
    lead = int(min(np.searchsorted(share, energy) + 1, width))

    # The longest vectors: at most one block, whatever the table holds.
    head = items.where(F.col("at") < block).select("id", "at", "q").toPandas()
    head_items, head_at = _matrix(head["q"], width), head["at"].to_numpy()

    def first_bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = _matrix(batch["q"], width) @ head_items.T
            scores[batch["at"].to_numpy()[:, None] == head_at[None, :]] = -np.inf
            if scores.shape[1] < k:
                bounds = np.full(len(batch), -np.inf)
            else:
                bounds = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            yield batch.assign(bound=bounds)

    asked = items.where("asks").select("id", "at", "q", "square")
    asked = cut(asked.mapInPandas(first_bounds, f"id long, at long, q array<{kind}>, square double, bound double"), "asked")
    # Length an item must have to matter, then queries of like reach share a part.
    need = F.when(F.col("bound") <= 0, 0.0).otherwise(F.col("bound") / F.sqrt(F.greatest("square", F.lit(1.0))) * (1 - 1e-9))
    asked = with_position(asked.withColumn("need", need), [F.col("need"), F.col("at")], "_q")
    asked = cut(asked.withColumn("part", (F.col("_q") / part).cast("int")), "parts")
    parts = asked.groupBy("part").agg(F.min("need").alias("need"))
    tops = items.groupBy("block").agg(F.sqrt(F.max("square")).alias("top"))
    # Both lists have one row per block or part; a part with a smaller need reaches more blocks.
    reach = cut(_reached(tops, parts), "reach")
    left = reach.join(items, "block").select("part", "block", "id", "at", "q")
    right = reach.join(asked, "part").select(F.col("part").alias("p"), F.col("block").alias("b"), "id", "at", "q", "bound")

    def search(key: tuple, found: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(asking):
            return pd.DataFrame({"at": [], "query_id": [], "vec_id": [], "score": []})
        out = search_block(
            _matrix(asking["q"], width), asking["at"].to_numpy(), asking["bound"].to_numpy(),
            _matrix(found["q"], width), found["id"].to_numpy(), found["at"].to_numpy(), rotation, lead, k,
        )
        at, ids = asking["at"].to_numpy(), asking["id"].to_numpy()
        rows = [(at[i], ids[i], v, s) for i, found_ids, scores in out for v, s in zip(found_ids, scores)]
        return pd.DataFrame(rows, columns=["at", "query_id", "vec_id", "score"])

    pairs = left.groupBy("part", "block").cogroup(right.groupBy("p", "b")).applyInPandas(
        search, "at long, query_id long, vec_id long, score long"
    )
    # At most k rows per query and block come here; each task keeps the best k of a query before the shuffle.
    best = Window.partitionBy("at").orderBy(F.col("score").desc(), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _reached(tops: DataFrame, parts: DataFrame) -> DataFrame:
    """(part, block) where the block's longest vector meets the part's smallest need.

    Lengths fall with the block number and needs rise with the part number, so a block is
    reached by the first parts: the rank of its length among the needs says how many.
    """
    merged = tops.select(F.col("block"), F.lit(None).cast("int").alias("part"), F.col("top").alias("v")).unionByName(
        parts.select(F.lit(None).cast("int").alias("block"), F.col("part"), F.col("need").alias("v"))
    )
    # Needs come before equal lengths, so that a block of exactly the needed length is reached.
    placed = with_position(merged, [F.col("v"), F.col("block").isNotNull(), F.col("block").desc()], "_at")
    blocks = placed.where("block is not null").select("block", "_at")
    # Blocks in rising length are in falling number: those before it are known from the number.
    last = tops.count() - 1
    reaching = F.col("_at") - (F.lit(last) - F.col("block"))
    return blocks.where(reaching > 0).select(
        "block", F.explode(F.sequence(F.lit(0), (reaching - 1).cast("int"))).alias("part")
    )
