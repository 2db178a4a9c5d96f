"""Clusters around whole-number centroids, most distances ruled out by an n-simplex projection.

The distances of a vector to several fixed pivots are computed once and kept. With the distances among the
pivots they are the edges of a simplex whose apex is the vector: its coordinates in the space that
the pivots span, and its height above it. Between two apexes the plain Euclidean distance is a lower
bound of the true one, and the distance with one height turned over an upper bound. A centroid whose lower
bound is above the smallest upper bound is no candidate; exact whole-number distances decide among the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.topk import whole_numbers
from tasteloom.sources.scratch import cut

CENTROIDS, ROUNDS, PIVOTS = 16, 3, 8
# Rows of a portion: its exact differences take rows x centroids x width whole numbers at most.
PORTION = 1024
ANSWER = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


class Simplex:
    """The space that some pivots span, and the apex of every vector above it.

    A pivot that lies in the span of those before it adds nothing and is left out.
    """

    def __init__(self, pivots: np.ndarray):
        chosen, basis = [0], []
        for i in range(1, len(pivots)):
            rest = (pivots[i] - pivots[0]).astype(float)
            size = np.linalg.norm(rest)
            for b in basis:
                rest = rest - (rest @ b) * b
            if np.linalg.norm(rest) > 1e-6 * max(size, 1):
                chosen.append(i)
                basis.append(rest / np.linalg.norm(rest))
        self.pivots = pivots[chosen]
        edges = (self.pivots[1:] - self.pivots[0]).astype(float)
        # Lower triangle: row i has the coordinates of pivot i + 1 with the first pivot at the origin.
        self.base = np.linalg.cholesky(edges @ edges.T) if len(edges) else np.zeros((0, 0))
        self.squares = np.einsum("ij,ij->i", edges, edges)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, exact."""
        return np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)

    def apexes(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(coordinates in the span, height above it) from squared distances to the pivots."""
        d = distances.astype(float)
        flat = np.zeros((len(d), len(self.base)))
        for i in range(len(self.base)):
            inner = (d[:, 0] + self.squares[i] - d[:, i + 1]) / 2
            flat[:, i] = (inner - flat[:, :i] @ self.base[i, :i]) / self.base[i, i]
        return flat, np.sqrt(np.maximum(d[:, 0] - (flat**2).sum(axis=1), 0))


def nearest(
    vectors: np.ndarray, distances: np.ndarray, centroids: np.ndarray, simplex: Simplex
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance to it, exact distances computed); ties go to the smaller number."""
    flat, height = simplex.apexes(distances)
    at, above = simplex.apexes(simplex.distances(centroids))
    across = np.maximum((flat**2).sum(axis=1)[:, None] + (at**2).sum(axis=1) - 2 * flat @ at.T, 0)
    lower = across + (height[:, None] - above) ** 2
    upper = across + (height[:, None] + above) ** 2
    # Rounding of the projection, in relation to the lengths it came from.
    slack = 1e-9 * (1 + (flat**2).sum(axis=1) + height**2 + (at**2).sum(axis=1).max() + (above**2).max())
    row, number = np.nonzero(lower <= (upper.min(axis=1) + slack)[:, None])
    exact = np.full(lower.shape, np.iinfo(np.int64).max)
    exact[row, number] = ((vectors[row] - centroids[number]) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[np.arange(len(best)), best], len(row)


def _assigned(table: DataFrame, centroids: np.ndarray, simplex: Simplex, width: int) -> DataFrame:
    """(vec, cluster, distance) of each stored vector."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for vectors, distances, part in _portions(batches, width):
            best, d, _ = nearest(vectors, distances, centroids, simplex)
            yield pd.DataFrame({"key": part["key"], "cluster": best.astype(np.int32), "distance": d})

    return table.mapInPandas(assign, f"key {table.schema['key'].dataType.simpleString()}, cluster int, distance long")


def _portions(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, pd.DataFrame]]:
    for batch in batches:
        for start in range(0, len(batch), PORTION):
            part = batch.iloc[start : start + PORTION]
            vectors = np.concatenate(part["q"].to_list()).astype(np.int64).reshape(len(part), width)
            yield vectors, np.stack(part["d"].to_list()).astype(np.int64), part


def _sums(table: DataFrame, centroids: np.ndarray, simplex: Simplex, width: int) -> DataFrame:
    """(cluster, i, s, n): sums of component i and counts, one row per task, cluster and component before the shuffle."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for vectors, distances, _ in _portions(batches, width):
            best, _, _ = nearest(vectors, distances, centroids, simplex)
            counts += np.bincount(best, minlength=len(centroids))
            for c in np.unique(best):
                sums[c] += vectors[best == c].sum(axis=0)
        c, i = np.divmod(np.arange(sums.size), width)
        yield pd.DataFrame({"cluster": c, "i": i, "s": sums.ravel(), "n": counts[c]})

    partial = table.select("q", "d").mapInPandas(add, "cluster int, i int, s long, n long")
    return partial.groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = 64, scale: int = 64,
    k: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS, seed: int = 1,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector of exactly ``width`` components.

    A component x is taken as floor(scale * x). The first centroids are the ``k`` vectors with the smallest sha256 of
    "seed:key", equal keys by their components; with fewer vectors there are fewer centroids. Each round gives every
    vector to its nearest centroid (ties: the smaller number) and moves a centroid to the floor of the mean; one without
    vectors stays. ``distance`` is squared and whole. The first ``pivots`` centroids are the pivots of the projection.

    Vectors that are null, of another width, or hold a null or non-finite component take no part. Rows without a key do,
    but come last among the first centroids. Repeated rows are rows of their own. An empty table gives no rows. Other
    columns are dropped, whatever their names. A component so large that distances pass 63 bits fails the job.
    """
    if width < 1 or k < 1 or pivots < 1:
        raise ValueError("width, k and pivots must be positive")
    spark, id_type = df.sparkSession, df.schema[key].dataType.simpleString()
    named = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(F.size("v") == width)
    limit = int(np.sqrt(np.iinfo(np.int64).max / width)) // 2
    big = F.exists("q", lambda x: F.abs(x) > F.lit(limit))
    whole = whole_numbers(named, "v", scale).select(
        "key", F.when(big, F.raise_error(F.lit("distances would pass 63 bits")).cast("array<bigint>")).otherwise(F.col("q")).alias("q")
    )
    vectors = cut(whole, "vectors")
    tag = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(tag.isNull(), tag, "q").limit(k).select("q").collect()
    if not first:
        return spark.createDataFrame([], f"{key} {id_type}, {ANSWER}")
    centroids = np.array([r["q"] for r in first], dtype=np.int64)
    simplex = Simplex(centroids[:pivots])
    table = cut(_with_distances(vectors, simplex, width, id_type), "projected")
    for _ in range(rounds):
        moved = centroids.copy()
        # k x width rows.
        for r in _sums(table, centroids, simplex, width).where("n > 0").collect():
            moved[r["cluster"], r["i"]] = r["s"] // r["n"]
        centroids = moved
    found = cut(_assigned(table, centroids, simplex, width), "assigned")
    inertia = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    total = sum(inertia.values())
    per_cluster = [(inertia.get(c, 0), hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    return found.select(
        F.col("key").alias(key), "cluster", "distance",
        _by_number([d for d, _ in per_cluster], "long").alias("cluster_inertia"), F.lit(total).cast("long").alias("inertia"),
        _by_number([h for _, h in per_cluster], "string").alias("centroid_sha256"),
    )


def _by_number(values: list, kind: str) -> Column:
    """The entry of a list, of one value per centroid, at ``cluster``."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)


def _with_distances(vectors: DataFrame, simplex: Simplex, width: int, id_type: str) -> DataFrame:
    """(key, q, d): the vectors with their squared distances to the pivots."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = np.concatenate(batch["q"].to_list() or [np.empty(0)]).astype(np.int64).reshape(len(batch), width)
            yield batch.assign(d=list(simplex.distances(q)))

    return vectors.mapInPandas(measure, f"key {id_type}, q array<bigint>, d array<bigint>")
