"""Best matches of many query vectors: blocks of queries meet blocks of stored vectors in tasks of bounded size.

Both sides stay tables. A key names what meets what; rows of a key are bounded by the way it is dealt, so a
task holds one block of each side, and only its best ``k`` per query are shuffled on.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.operators.ranking import top_per_group

# About so many rows of each side meet in a task.
STORED_ROWS = 16_384
QUERY_ROWS = 4_096
# Scores a task holds at a time.
SCORE_CELLS = 4_000_000

# The scoring helpers travel with the tasks, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def whole(vector: Column) -> Column:
    """Vectors that can be scored: not empty, no NULL in them."""
    return (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull())


def parts_of(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))


def dealt(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def every(parts: int) -> Column:
    """One row for each part."""
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def _best(queries: pd.DataFrame, stored: pd.DataFrame, k: int, cells: int) -> pd.DataFrame:
    """Best ``k`` cosines (6 places, ties by id) of each query of a block among the stored vectors of a block."""
    if queries.empty or stored.empty:
        return pd.DataFrame(columns=["query_id", "doc_id", "vector_score"], dtype=object)
    unit = np.stack(queries["query_vector"].to_numpy()).astype("float64")
    norms = np.linalg.norm(unit, axis=1)
    unit /= np.where(norms > 0, norms, 1.0)[:, None]
    best_score = np.full((len(unit), 0), 0.0)
    best_row = np.full((len(unit), 0), 0)
    names = stored["doc_id"].to_numpy()
    order_of = np.argsort(np.argsort(names.astype(str) if names.dtype == object else names, kind="stable"), kind="stable")
    step = max(1, cells // len(unit))
    for at in range(0, len(stored), step):
        rows = np.stack(stored["embedding"].iloc[at:at + step].to_numpy()).astype("float64")
        norm = np.linalg.norm(rows, axis=1)
        scores = np.round(unit @ (rows / np.where(norm > 0, norm, 1.0)[:, None]).T, 6)
        scores[:, norm == 0] = -np.inf
        scores = np.concatenate([best_score, scores], axis=1)
        index = np.concatenate([best_row, np.broadcast_to(np.arange(at, at + len(rows)), (len(unit), len(rows)))], axis=1)
        order = np.lexsort((order_of[index], -scores), axis=1)[:, :k]
        best_score = np.take_along_axis(scores, order, axis=1)
        best_row = np.take_along_axis(index, order, axis=1)
    good = np.isfinite(best_score) & (norms > 0)[:, None]
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[np.nonzero(good)[0]],
                         "doc_id": names[best_row[good]], "vector_score": best_score[good]})


def best_matches(stored: DataFrame, visits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``(query_id, doc_id, vector_score)``: the best ``k`` of each query among the stored vectors it visits.

    ``stored`` has the keys, doc_id and embedding, ``visits`` the keys, query_id and query_vector; vectors of a
    key have one length.
    """
    schema = (f"query_id {visits.schema['query_id'].dataType.simpleString()}, "
              f"doc_id {stored.schema['doc_id'].dataType.simpleString()}, vector_score double")
    cells = SCORE_CELLS

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _best(left, right, k, cells)

    met = visits.select(*keys, "query_id", "query_vector").groupBy(*keys).cogroup(
        stored.select(*keys, "doc_id", "embedding").groupBy(*keys)).applyInPandas(score, schema)
    return top_per_group(met, "query_id", [F.desc("vector_score"), F.asc("doc_id")], k)


def exact_matches(stored: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of every query among all stored vectors of its length.

    Every block of queries meets every block of vectors, a given set of queries against all rows. A vector
    with a NULL in it matches nothing.
    """
    stored = stored.filter(whole(F.col("embedding")))
    queries = queries.filter(whole(F.col("query_vector")))
    blocks = parts_of(stored.count(), STORED_ROWS)
    parts = parts_of(queries.count(), QUERY_ROWS)
    return best_matches(
        stored.select("doc_id", "embedding", F.size("embedding").alias("dim"), dealt("doc_id", blocks).alias("block"),
                      every(parts).alias("part")),
        queries.select("query_id", "query_vector", F.size("query_vector").alias("dim"), every(blocks).alias("block"),
                       dealt("query_id", parts).alias("part")),
        ["dim", "block", "part"], k)
