"""Approximate vector search over inverted-file cells: k-means cells, few of them probed, exact re-rank."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.functions.vectors import cosine_scores
from leakscope.operators import vector_blocks as blocks

# The centres are fitted on about so many vectors per cell; all vectors are then put into cells.
FIT_PER_CELL = 256
PLACES = 1 << 30


def build_cells(embeddings: DataFrame, cells: int | None = None, seed: int = 42, max_iter: int = 10,
                fit_per_cell: int = FIT_PER_CELL) -> tuple[DataFrame, np.ndarray]:
    """Embeddings with their cell number, and the cell centres.

    By default there are as many cells as the square root of the number of vectors, so a probe reads that
    many times fewer rows at any size. Centres are fitted on about ``fit_per_cell`` vectors per cell, chosen
    by a hash of their id; every vector is indexed.
    """
    vectors = embeddings.withColumn("_v", array_to_vector("embedding"))
    n = embeddings.count()
    cells = cells or max(2, round(math.sqrt(n)))
    share = min(1.0, fit_per_cell * cells / max(1, n))
    fitted = vectors.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(PLACES)) < share * PLACES)
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, featuresCol="_v", predictionCol="cell",
                   initSteps=2).fit(fitted)
    return model.transform(vectors).drop("_v"), np.array(model.clusterCenters())


def nearest_cells(centres: np.ndarray, vector: Sequence[float], probes: int) -> list[int]:
    """The ``probes`` cells whose centres are closest to the query."""
    distance = ((centres - np.asarray(vector, dtype="float64")) ** 2).sum(axis=1)
    return [int(c) for c in np.argsort(distance, kind="stable")[:probes]]


def probe_search(celled: DataFrame, centres: np.ndarray, vector: Sequence[float], k: int, probes: int) -> DataFrame:
    """Exact top ``k`` among the probed cells.

    ``celled`` should be stored partitioned by ``cell`` so that the scan reads only those folders.
    """
    cells = nearest_cells(centres, vector, probes)
    found = cosine_scores(celled.filter(F.col("cell").isin(cells)), vector, out="similarity")
    return found.orderBy(F.desc("similarity"), "doc_id").limit(k)


def _cell_order(celled: DataFrame, centres: np.ndarray, probes: int):
    """Column function: the ``probes`` cells nearest to a query vector, nearest first."""
    shared = celled.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        middle = shared.value
        squares = (middle ** 2).sum(axis=1)
        out = []
        for vector in vectors:
            distance = squares - 2.0 * (middle @ np.asarray(vector, dtype="float64"))
            out.append(np.argsort(distance, kind="stable")[:probes].astype("int32"))
        return pd.Series(out)

    return nearest


def _fitting(queries: DataFrame, centres: np.ndarray) -> DataFrame:
    """Queries with a whole vector of the cells' length; others match nothing."""
    return queries.filter(blocks.whole(F.col("query_vector")) & (F.size("query_vector") == centres.shape[1]))


def probes_for(celled: DataFrame, centres: np.ndarray, queries: DataFrame, k: int, share: float = 0.95) -> int:
    """The least number of probes that finds ``share`` of the exact ``k`` nearest of these queries.

    A neighbour is found as soon as its cell is probed, so one exact search tells it for every number.
    """
    asked = _fitting(queries, centres)
    near = blocks.exact_matches(celled, asked, k).select("query_id", "doc_id")
    order = asked.select(
        "query_id", _cell_order(celled, centres, len(centres))("query_vector").alias("cells"))
    met = near.join(celled.select("doc_id", "cell"), "doc_id").join(order, "query_id")
    counts = dict(met.groupBy(F.array_position("cells", F.col("cell")).alias("at")).count().collect())
    reached, wanted = 0, share * sum(counts.values())
    for at in sorted(counts):
        reached += counts[at]
        if reached >= wanted:
            return int(at)
    return 1


def probe_batch(celled: DataFrame, centres: np.ndarray, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """``(query_id, doc_id, vector_score)``: top ``k`` of every (query_id, query_vector) among its probed cells.

    Large cells are cut into blocks, which are visited one by one, so a cell with a third of all vectors
    fills no task. The centres, one per cell, are the only thing broadcast.
    """
    nearest = _cell_order(celled, centres, probes)
    celled = celled.filter(blocks.whole(F.col("embedding")))
    asked = _fitting(queries, centres)
    largest = celled.groupBy("cell").count().agg(F.max("count")).first()[0] or 0
    cuts = blocks.parts_of(largest, blocks.STORED_ROWS)
    parts = blocks.parts_of(asked.count(), blocks.QUERY_ROWS)
    visits = asked.select("query_id", "query_vector", F.explode(nearest("query_vector")).alias("cell"))
    return blocks.best_matches(
        celled.select("cell", "doc_id", "embedding", blocks.dealt("doc_id", cuts).alias("block"),
                      blocks.every(parts).alias("part")),
        visits.select("cell", "query_id", "query_vector", blocks.every(cuts).alias("block"),
                      blocks.dealt("query_id", parts).alias("part")),
        ["cell", "block", "part"], k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours asked for and how many of them were found."""
    hit = found.select("query_id", "doc_id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "doc_id"], "left").agg(
        F.count("*").alias("neighbours"), F.count("hit").alias("found"))
