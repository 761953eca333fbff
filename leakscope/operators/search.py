"""Keyword, vector and hybrid search over the document corpus, one query or many at a time.

Searches take the stored word positions of :mod:`leakscope.operators.postings`: then the keyword leg reads
the rows of its terms there, and no lexeme list. Without them it reads the lists.

``documents`` carries ``content_tsv``, the stored lexeme list; ``embeddings`` has one vector per
document. A single query is a scan with a top-k per leg. A batch finds its keyword candidates by
each query's rarest term and its vector hits by block products with a bounded top-k per task. Where the
vector table has the document's ``source_type`` (it is stored partitioned by it), a search for some types
reads only theirs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.functions import text as X
from leakscope.functions.vectors import cosine_scores
from leakscope.operators import postings as P
from leakscope.operators import vector_blocks
from leakscope.operators.ranking import top_per_group

VECTOR_WEIGHT = 0.6
KEYWORD_WEIGHT = 0.4
OVER_FETCH = 3
PER_TYPE_CAP = 2

# The source types the analytics search looks at.
ANALYTICS_TYPES = (
    "schema_doc", "leakage_scenario", "sql_template", "kpi_glossary", "join_graph", "anti_pattern",
    "routing_hint", "enum_reference", "generated_column", "metric_definition", "lineage_doc",
    "anomaly_interpretation", "summary_profile",
)
SUFFIXES = ("ings", "ing", "ied", "ies", "edly", "ed", "es", "ly", "s")


def query_terms(query: str) -> tuple[list[str], list[str]]:
    """Distinct raw words and distinct stems of a query, cut the way documents are."""
    words = re.findall(r"[^\W_]+", query.lower())

    def stem(word: str) -> str:
        fits = [s for s in SUFFIXES if word.endswith(s) and len(word) - len(s) >= 3]
        return word[: len(word) - len(max(fits, key=len))] if fits else word

    return list(dict.fromkeys(words)), list(dict.fromkeys(stem(w) for w in words))


def _searchable(documents: DataFrame, types: Sequence[str] | None) -> DataFrame:
    active = documents.filter("is_active")
    return active if types is None else active.filter(F.col("source_type").isin(list(types)))


def _vectors_of(embeddings: DataFrame, types: Sequence[str] | None) -> DataFrame:
    """Vectors that documents of these types can have; others are not read."""
    if types is None or "source_type" not in embeddings.columns:
        return embeddings
    return embeddings.filter(F.col("source_type").isin(list(types)))


def keyword_hits(documents: DataFrame, query: str, k: int, types: Sequence[str] | None = None,
                 postings: DataFrame | None = None) -> DataFrame:
    """The best ``k`` active documents that hold all raw terms or all stems, by cover density."""
    raw, stemmed = query_terms(query)
    if postings is not None:
        return P.matches(postings, raw, stemmed, types).drop("raw_match", "stem_match").orderBy(
            F.desc("bm25_score"), "doc_id").limit(k)
    lex = F.col("content_tsv")
    matching = _searchable(documents, types).filter(X.contains_all(lex, raw) | X.contains_all(lex, stemmed))
    literal = [F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
               for terms in (raw, stemmed)]
    score = X.cover_density(lex, *literal)
    return matching.select(
        "doc_id", "source_type", "retrieval_weight", "priority", score.alias("bm25_score")
    ).orderBy(F.desc("bm25_score"), "doc_id").limit(k)


def vector_hits(documents: DataFrame, embeddings: DataFrame, vector: Sequence[float], k: int | None,
                types: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` active documents whose vectors are closest in cosine; all of them for ``k=None``."""
    keep = _searchable(documents, types).select("doc_id", "source_type", "retrieval_weight", "priority")
    scored = cosine_scores(_vectors_of(embeddings, types), vector)
    hits = scored.join(keep, "doc_id")
    if k is None:
        return hits
    return hits.orderBy(F.desc("vector_score"), "doc_id").limit(k)


def _fuse(keyword: DataFrame, vector: DataFrame, on: list[str], vector_weight: float, keyword_weight: float,
          weighted: bool) -> DataFrame:
    """Full join of both legs, missing scores as 0, blended and scaled by the document's weight."""
    k, v = keyword.alias("k"), vector.alias("v")
    cond = [F.col(f"k.{c}") == F.col(f"v.{c}") for c in on]
    either = [F.coalesce(F.col(f"k.{c}"), F.col(f"v.{c}")).alias(c)
              for c in [*on, "source_type", "retrieval_weight", "priority"]]
    joined = k.join(v, cond, "full").select(
        *either,
        F.coalesce("k.bm25_score", F.lit(0.0)).alias("bm25_score"),
        F.coalesce("v.vector_score", F.lit(0.0)).alias("vector_score"),
    )
    blend = F.lit(keyword_weight) * F.col("bm25_score") + F.lit(vector_weight) * F.col("vector_score")
    if weighted:
        blend = blend * F.col("retrieval_weight").cast("double")
    return joined.withColumn("hybrid_score", F.round(blend, 9))


def _best() -> list[Column]:
    return [F.desc("hybrid_score"), F.desc("priority"), F.asc("doc_id")]


def _result_rows(ranked: DataFrame, documents: DataFrame, order: list[Column]) -> DataFrame:
    """Add title, content and metadata to a handful of hits.

    The hits are at most a few rows, so they are the broadcast side; joining on the partition
    column as well lets the scan skip source types without hits.
    """
    text = documents.select("source_type", "doc_id", "title", "content", "metadata")
    lead = ["query_id"] if "query_id" in ranked.columns else []
    return text.join(F.broadcast(ranked), ["source_type", "doc_id"]).select(
        *lead, "doc_id", "source_type", "title", "content", "metadata", "bm25_score", "vector_score",
        "hybrid_score", "priority", "retrieval_weight").orderBy(*lead, *order)


def hybrid_search(documents: DataFrame, embeddings: DataFrame, query: str, vector: Sequence[float] | None = None,
                  types: Sequence[str] | None = None, k: int = 8, vector_weight: float = VECTOR_WEIGHT,
                  keyword_weight: float = KEYWORD_WEIGHT, per_type_cap: int | None = PER_TYPE_CAP,
                  postings: DataFrame | None = None) -> DataFrame:
    """Top ``k`` documents by blended keyword and vector score, at most ``per_type_cap`` per source type.

    Without a query vector the vector leg is left out instead of being filled with arbitrary rows.
    """
    leg = OVER_FETCH * k
    words = keyword_hits(documents, query, leg, types, postings)
    if vector is None:
        near = words.select("doc_id", "source_type", "retrieval_weight", "priority",
                            F.lit(0.0).alias("vector_score")).limit(0)
    else:
        near = vector_hits(documents, embeddings, vector, leg, types)
    fused = _fuse(words, near, ["doc_id"], vector_weight, keyword_weight, weighted=True)
    if per_type_cap is not None:
        fused = top_per_group(fused, "source_type", [F.desc("hybrid_score"), F.asc("doc_id")], per_type_cap)
    top = fused.orderBy(*_best()).limit(k)
    return _result_rows(top, documents, _best())


def search_analytics(documents: DataFrame, embeddings: DataFrame, query: str,
                     vector: Sequence[float] | None = None, k: int = 8, postings: DataFrame | None = None) -> DataFrame:
    return hybrid_search(documents, embeddings, query, vector, ANALYTICS_TYPES, k, postings=postings)


def search_reviews(documents: DataFrame, embeddings: DataFrame, query: str,
                   vector: Sequence[float] | None = None, k: int = 5, per_type_cap: int | None = PER_TYPE_CAP,
                   postings: DataFrame | None = None) -> DataFrame:
    """Review search. The cap per type also holds here, so it gives at most two rows by default."""
    return hybrid_search(documents, embeddings, query, vector, ("review",), k, per_type_cap=per_type_cap, postings=postings)


def semantic_search(documents: DataFrame, embeddings: DataFrame, vector: Sequence[float], k: int = 5,
                    types: Sequence[str] | None = None) -> DataFrame:
    """Plain vector search, text included."""
    near = vector_hits(documents, embeddings, vector, k, types).withColumnRenamed("vector_score", "similarity")
    text = documents.select("source_type", "doc_id", "title", "content")
    return text.join(F.broadcast(near.select("source_type", "doc_id", "similarity")), ["source_type", "doc_id"]).orderBy(
        F.desc("similarity"), "doc_id")


def unweighted_search(documents: DataFrame, embeddings: DataFrame, query: str, vector: Sequence[float],
                      k: int = 8, postings: DataFrame | None = None) -> DataFrame:
    """Blend without leg limits, document weight or type cap; raw terms only, ties by priority."""
    raw, _ = query_terms(query)
    if postings is not None:
        words = P.matches(postings, raw, []).drop("raw_match", "stem_match")
    else:
        lex = F.col("content_tsv")
        terms = F.array(*[F.lit(t) for t in raw])
        words = _searchable(documents, None).filter(X.contains_all(lex, raw)).select(
            "doc_id", "source_type", "retrieval_weight", "priority",
            X.cover_density(lex, terms, F.array().cast("array<string>")).alias("bm25_score"))
    fused = _fuse(words, vector_hits(documents, embeddings, vector, None), ["doc_id"], VECTOR_WEIGHT, KEYWORD_WEIGHT,
                  weighted=False)
    return fused.orderBy(*_best()).limit(k).select(
        "doc_id", "source_type", "bm25_score", "vector_score", "hybrid_score", "priority")


# ---- many queries at once --------------------------------------------------------------------------


def batch_keyword_hits(documents: DataFrame, queries: DataFrame, k: int, types: Sequence[str] | None = None,
                       postings: DataFrame | None = None) -> DataFrame:
    """Best ``k`` keyword matches of every (query_id, query_text).

    A match must hold all terms, so it holds the query's rarest term. Only documents with that term
    are candidates; no query meets a document it shares nothing with, and none is cut off.
    """
    if postings is not None:
        return P.batch_matches(postings, queries, k, types)
    q = queries.select(
        "query_id",
        F.array_distinct(X.tokens(F.col("query_text"))).alias("raw"),
        F.array_distinct(X.stems(F.col("query_text"))).alias("stem"),
    )
    terms = q.select("query_id", F.lit("raw").alias("kind"), F.explode("raw").alias("term")).unionByName(
        q.select("query_id", F.lit("stem").alias("kind"), F.explode("stem").alias("term")))
    words = _searchable(documents, types).select("doc_id", F.explode(F.array_distinct("content_tsv")).alias("term"))
    frequency = words.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(
        F.count("*").alias("df"))
    rarest = (
        terms.join(frequency, "term", "left")
        .groupBy("query_id", "kind")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("r"))
        .filter("r.df > 0")
        .select("query_id", F.col("r.term").alias("term")).distinct()
    )
    candidates = words.join(rarest, "term").select("doc_id", "query_id").distinct()
    lex = F.col("content_tsv")

    def held(col: str) -> Column:
        return (F.size(col) > 0) & (F.size(F.array_except(F.col(col), lex)) == 0)

    scored = (
        candidates.join(
            documents.select("doc_id", "source_type", "retrieval_weight", "priority", "content_tsv"), "doc_id")
        .join(q, "query_id")
        .filter(held("raw") | held("stem"))
        .select("query_id", "doc_id", "source_type", "retrieval_weight", "priority",
                X.cover_density(lex, F.col("raw"), F.col("stem")).alias("bm25_score"))
    )
    return top_per_group(scored, "query_id", [F.desc("bm25_score"), F.asc("doc_id")], k)


def batch_vector_hits(documents: DataFrame, embeddings: DataFrame, queries: DataFrame, k: int,
                      types: Sequence[str] | None = None) -> DataFrame:
    """Best ``k`` cosine matches of every (query_id, query_vector).

    Vectors of another length or with a NULL in them match nothing; they do not fail the others.
    """
    keep = _searchable(documents, types).select("doc_id", "source_type", "retrieval_weight", "priority")
    stored = _vectors_of(embeddings, types).select("doc_id", "embedding").join(keep.select("doc_id"), "doc_id", "left_semi")
    return vector_blocks.exact_matches(stored, queries.select("query_id", "query_vector"), k).join(keep, "doc_id")


def batch_search(documents: DataFrame, embeddings: DataFrame, queries: DataFrame, k: int = 8,
                 per_type_cap: int | None = PER_TYPE_CAP, types: Sequence[str] | None = None,
                 vector_weight: float = VECTOR_WEIGHT, keyword_weight: float = KEYWORD_WEIGHT,
                 postings: DataFrame | None = None) -> DataFrame:
    """Hybrid search for every row of ``queries`` (query_id, query_text, query_vector)."""
    leg = OVER_FETCH * k
    fused = _fuse(
        batch_keyword_hits(documents, queries, leg, types, postings), batch_vector_hits(documents, embeddings, queries, leg, types),
        ["query_id", "doc_id"], vector_weight, keyword_weight, weighted=True)
    if per_type_cap is not None:
        fused = (
            fused.withColumn("_pair", F.struct("query_id", "source_type"))
            .transform(lambda d: top_per_group(d, "_pair", [F.desc("hybrid_score"), F.asc("doc_id")], per_type_cap))
            .drop("_pair")
        )
    return top_per_group(fused, "query_id", _best(), k, out="rank").select(
        "query_id", "rank", "doc_id", "source_type", "bm25_score", "vector_score", "hybrid_score", "priority",
        "retrieval_weight")


def batch_search_analytics(documents: DataFrame, embeddings: DataFrame, queries: DataFrame, k: int = 8,
                           postings: DataFrame | None = None) -> DataFrame:
    return batch_search(documents, embeddings, queries, k, types=ANALYTICS_TYPES, postings=postings)


def batch_search_reviews(documents: DataFrame, embeddings: DataFrame, queries: DataFrame, k: int = 5,
                         per_type_cap: int | None = PER_TYPE_CAP, postings: DataFrame | None = None) -> DataFrame:
    return batch_search(documents, embeddings, queries, k, per_type_cap, types=("review",), postings=postings)
