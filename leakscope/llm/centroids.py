"""Centroid clustering of integer vectors with an equal-average equal-variance search for the nearest centroid
(Lee and Chen 1994; Baek, Bae and Sung 1999).

Centroids are sorted by the sum of their components. From the place of a vector's own sum the search walks
outward, the closer side first. With n components, sums S and T, and deviations V and W (root of the summed
squared distance from the mean), the squared distance is at least ``(S - T)^2 / n`` and at least
``(S - T)^2 / n + (V - W)^2``. Once the first bound passes the best distance no centroid further out can win; one
whose second bound passes it is skipped. Whatever is left gets its exact distance in 64-bit integers. The bounds
are taken a little too small, so rounding never skips a winner or a tie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import stored

# Components up to this size have exact squared distances in a long, for up to 64 of them.
LARGEST = 1 << 27
BLOCK = 4096  # vectors searched at once
SLACK = 1e-9


@dataclass
class Centroids:
    """Integer centroids in search order, with their sums, deviations and numbers."""

    points: np.ndarray
    number: np.ndarray
    sums: np.ndarray
    spread: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> "Centroids":
        order = np.argsort(points.sum(axis=1), kind="stable")
        sorted_ = points[order]
        return cls(sorted_, order, sorted_.sum(axis=1), deviations(sorted_))


def deviations(points: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - points.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))


def nearest(block: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of each vector (ties: the smaller number), its squared distance, and how
    many distances were computed."""
    size, width, k = len(block), block.shape[1], len(c.points)
    sums, spread = block.sum(axis=1), deviations(block)
    reach = SLACK * (1.0 + np.abs(block).max(axis=1, initial=0) + np.abs(c.points).max(initial=0))
    high = np.searchsorted(c.sums, sums)
    low = high - 1
    best = np.full(size, np.iinfo(np.int64).max)
    who = np.full(size, k, np.int64)
    live, computed = np.arange(size), 0
    for _ in range(k):
        to_low = np.where(low[live] >= 0, sums[live] - c.sums[low[live]], np.iinfo(np.int64).max)
        to_high = np.where(high[live] < k, c.sums[np.minimum(high[live], k - 1)] - sums[live], np.iinfo(np.int64).max)
        down = to_low <= to_high
        gap = np.minimum(to_low, to_high).astype(np.float64)
        at = np.where(down, low[live], high[live])
        low[live] -= down
        high[live] += ~down
        limit = best[live] * (1.0 + SLACK)
        bound = gap * gap / width
        inside = bound <= limit
        live, at, bound, limit = live[inside], at[inside], bound[inside], limit[inside]
        if not len(live):
            break
        apart = np.maximum(np.abs(spread[live] - c.spread[at]) - reach[live], 0.0)
        asked = bound + apart * apart <= limit
        rows, near = live[asked], at[asked]
        gaps = block[rows] - c.points[near]
        d = (gaps * gaps).sum(axis=1)
        computed += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c.number[near] < who[rows]))
        best[rows[better]], who[rows[better]] = d[better], c.number[near[better]]
    return who, best, computed


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for b in batches:
        for at in range(0, len(b), BLOCK):
            part = b.iloc[at:at + BLOCK]
            yield part, np.stack(part["v"].to_numpy()).astype(np.int64)


def usable(vector: Column, width: int) -> Column:
    """Vectors of ``width`` components, none null or non-finite, and each small enough for exact distances."""
    bound = float(LARGEST // 256)
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < bound))
    return F.coalesce((F.size(vector) == width) & fits, F.lit(False))


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5,
            width: int = 64, scale: int = 256, salt: str = "2") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid)`` of every usable vector.

    Components become ``floor(scale * x)``. The first centroids are the ``k`` vectors whose ``salt:id`` has the
    least SHA-256, numbered in that order (fewer vectors: fewer centroids). Each round assigns every vector and
    moves each centroid that has any to the floor of their mean; then all are assigned once more. A vector with a
    null, a NaN, an infinity, another length or a component of 2^19 or more (with scale 256; its distances would
    not fit a long) is left out. Null ids hash last and are clustered like others; rows that repeat an id are
    vectors of their own, ordered by their components where they tie. No usable vector: no rows. An inertia
    beyond a long is null.

    Each round reads the stored integer vectors once; tasks hand on one sum per centroid, so no key is shuffled
    however full a cluster is, and the driver sees ``k`` rows.
    """
    x = F.col(f"`{vector_col}`")
    vectors = stored(df.filter(usable(x, width)).select(
        F.col(f"`{id_col}`").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v")),
        "cluster_vectors")
    first = vectors.select("v", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("h")).orderBy(
        F.col("h").asc_nulls_last(), "v").limit(k).collect()
    points = np.array([r.v for r in sorted(first, key=lambda r: (r.h is None, r.h or "", r.v))], np.int64).reshape(-1, width)
    context = df.sparkSession.sparkContext
    if not len(points):
        points = np.zeros((1, width), np.int64)  # nothing will be assigned to it

    def moved(shared):
        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c = shared.value
            total, n = np.zeros((len(c.points), width), np.int64), np.zeros(len(c.points), np.int64)
            for _, block in _blocks(batches):
                who, _, _ = nearest(block, c)
                order = np.argsort(who, kind="stable")
                starts = np.flatnonzero(np.diff(who[order], prepend=-1))
                total[who[order][starts]] += np.add.reduceat(block[order], starts, axis=0)
                n += np.bincount(who, minlength=len(n))
            some = np.flatnonzero(n)
            if len(some):
                yield pd.DataFrame({"cluster": some, "n": n[some], "total": list(total[some])})

        return sums

    for _ in range(rounds):
        shared = context.broadcast(Centroids.of(points))
        parts = vectors.select("v").mapInPandas(moved(shared), "cluster long, n long, total array<long>")
        # Sums of all rows may pass 64 bits; they are added as decimals and come as text.
        whole = parts.select("cluster", "n", F.posexplode("total")).groupBy("cluster", "pos").agg(
            F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).cast("string").alias("total"))
        points = points.copy()
        for r in whole.collect():  # at most k * width numbers
            points[r.cluster, r.pos] = int(r.total) // r.n
        shared.destroy()

    shared = context.broadcast(Centroids.of(points))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block in _blocks(batches):
            who, distance, _ = nearest(block, shared.value)
            yield pd.DataFrame({"id": part["id"].to_numpy(), "cluster": who.astype(np.int32), "distance": distance})

    kind = vectors.schema["id"].dataType.simpleString()
    assigned = stored(vectors.mapInPandas(assign, f"id {kind}, cluster int, distance long"), "cluster_rows")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    found = {r.cluster: int(r.d) for r in inertia.collect()}  # one row per centroid
    fits = lambda total: total if total < 1 << 63 else None
    places = df.sparkSession.createDataFrame(
        [(n, fits(d), fits(sum(found.values())), [int(v) for v in points[n]]) for n, d in found.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(places), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
