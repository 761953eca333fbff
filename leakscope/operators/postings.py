"""A stored table of word positions: one row per lexeme and document, so that a search reads only the rows
of its own terms.

The table is partitioned by a hash of the term and sorted by term within a file, so a scan opens the
folders of the query's terms and, by the statistics of their row groups, little else there. What ranking needs
of a document stands in its rows; texts are joined to the final hits alone. A frequent term is many rows over
several files of its folder, never one value.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.functions import text as X
from leakscope.operators.ranking import top_per_group
from leakscope.session import shared_dir

# Folders of the table. A table is read with the number it was built with.
BUCKETS = 64
PARTITION = "bucket"
ORDER = ("term", "doc_id")
ABOUT = ("source_type", "is_active", "retrieval_weight", "priority")
PACKED = (PARTITION, "kinds", "docs", "kind", "terms", "held", "at", "counts", "short", "long")
RAREST = 4  # terms of a query that a document must hold to be looked into
CHUNK, CHUNK_BYTES = 1_024, 64 << 20  # documents whose words are told apart at a time, and bytes of their lists

# The helpers travel with the tasks, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _kinds(about: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """For documents described by ``about``: which description each has, and the first document with each."""
    code = np.zeros(len(about[0]), np.int64)
    for column in about:
        values = pc.dictionary_encode(column, null_encoding="encode")
        code = np.unique(code * len(values.dictionary) + values.indices.to_numpy(), return_inverse=True)[1]
    _, first, kind = np.unique(code, return_index=True, return_inverse=True)
    return kind, first


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Lists of values, those of list i between ends i and i + 1."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _folders(docs: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Documents ``(doc_id, about..., lexemes, buckets)`` as rows of :func:`packed`, one per folder."""
    lists = docs.column(1 + len(ABOUT))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not sizes.sum():
        return
    words = pc.dictionary_encode(lists.flatten(), null_encoding="encode")
    codes = words.indices.to_numpy().astype(np.int64)
    bucket = np.zeros(len(words.dictionary), np.int64)
    bucket[codes] = docs.column(2 + len(ABOUT)).flatten().to_numpy()
    # Places are numbered within a document; sorting by folder, word and document keeps them in order. Rows of a folder leave
    # in the order they are stored in, so that what is sorted there are runs.
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(doc)) - np.repeat(ends - sizes, sizes)
    by_word = pc.sort_indices(words.dictionary).to_numpy().astype(np.int64)
    of_bucket = by_word[np.argsort(bucket[by_word], kind="stable")]
    rank = np.empty_like(of_bucket)
    rank[of_bucket] = np.arange(len(of_bucket))
    key = rank[codes] * len(sizes) + doc
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order].astype(np.int32)
    # One posting is one word in one document, one term is one word, one folder is all words of a bucket.
    posting = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    word, at = np.divmod(key[posting], len(sizes))
    term = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    of_term = bucket[of_bucket[word[term]]]
    folder = np.flatnonzero(np.r_[True, of_term[1:] != of_term[:-1]])
    terms = words.dictionary.take(pa.array(of_bucket[word[term]]))
    held, counts = np.diff(np.r_[term, len(posting)]), np.diff(np.r_[posting, len(place)])
    kind, first = _kinds([docs.column(1 + i) for i in range(len(ABOUT))])
    kinds = pa.StructArray.from_arrays([docs.column(1 + i).take(pa.array(first)) for i in range(len(ABOUT))], list(ABOUT))
    last_term, n = np.r_[folder, len(term)], len(folder)
    last_posting = np.r_[term, len(posting)][last_term]
    last_place = np.r_[posting, len(place)][last_posting]
    fits = np.maximum.reduceat(place, last_place[:-1]) < 1 << 15

    def every(values: pa.Array) -> pa.ListArray:
        """All documents are named in each folder's row."""
        return _lists(np.arange(n + 1) * len(values), pa.concat_arrays([values] * n))

    def some(chosen: np.ndarray, kind: str) -> pa.ListArray:
        sizes = np.where(chosen, np.diff(last_place), 0)
        return _lists(np.r_[0, np.cumsum(sizes)], pa.array(place[np.repeat(chosen, np.diff(last_place))].astype(kind)))

    yield pa.RecordBatch.from_arrays([
        pa.array(of_term[folder].astype(np.int32)), every(kinds), every(docs.column(0)), every(pa.array(kind.astype(np.int16))),
        _lists(last_term, terms), _lists(last_term, pa.array(held.astype(np.int32))), _lists(last_posting, pa.array(at.astype(np.int16))),
        _lists(last_posting, pa.array(counts.astype(np.int32))), some(fits, "int16"), some(~fits, "int32")], list(PACKED))


def _rows(folder: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The table's rows of each row of :func:`packed`."""
    for i in range(len(folder)):
        bucket, kinds, docs, kind, terms, held, at, counts, short, long = (c.slice(i, 1).flatten() if pa.types.is_list(c.type) else c[i]
                                                                          for c in folder.columns)
        at, n = at.to_numpy(), held.to_numpy()
        about = kinds.take(pa.array(kind.to_numpy()[at])).flatten()
        ends = np.r_[0, np.cumsum(counts.to_numpy())]
        yield pa.RecordBatch.from_arrays([
            terms.take(pa.array(np.repeat(np.arange(len(n)), n))), docs.take(pa.array(at)),
            _lists(ends, pc.cast(short, pa.int32()) if len(short) else long), *about,
            pa.array(np.full(len(at), bucket.as_py(), np.int32))], ["term", "doc_id", "positions", *ABOUT, PARTITION])


def packed(documents: DataFrame) -> DataFrame:
    """Rows ``PACKED``: what up to ``CHUNK`` documents have in one folder.

    ``docs`` are those documents and ``kind`` which of ``kinds`` describes each; ``held`` says how many documents have each of
    ``terms``, ``at`` which ones and ``counts`` how often; ``short`` or ``long`` holds all the places in turn, in two bytes each
    where they fit. Words are told apart in batches of documents, so neither lists nor single words are shuffled, a term is
    named once a batch, and :func:`spread` makes the table's rows where they are written. Rows with the same id and
    description are put together.
    """
    about = ["doc_id", *ABOUT]
    kind = {f.name: f.dataType.simpleString() for f in documents.select(*about).schema}
    described = ", ".join(f"{c}: {kind[c]}" for c in ABOUT)
    layout = (f"{PARTITION} int, kinds array<struct<{described}>>, docs array<{kind['doc_id']}>, kind array<smallint>, terms array<string>, "
              "held array<int>, at array<smallint>, counts array<int>, short array<smallint>, long array<int>")
    step, most = CHUNK, CHUNK_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            for begin in range(0, len(b), step):
                part = b.slice(begin, step)
                if held and (sum(map(len, held)) + len(part) > step or sum(h.nbytes for h in held) + part.nbytes > most):
                    yield from _folders(pa.concat_batches(held))
                    held = []
                held.append(part)
        if held:
            yield from _folders(pa.concat_batches(held))

    def of(docs: DataFrame) -> DataFrame:
        return docs.select(*about, "content_tsv", F.transform("content_tsv", _bucket).alias("buckets")).mapInArrow(cut, layout)

    again = documents.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return of(documents)
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    merged = spread(of(documents.join(again, same, "left_semi"))).groupBy(*about, "term", PARTITION).agg(
        F.sort_array(F.flatten(F.collect_list("positions"))).alias("long"))
    one = lambda i, t: F.array(F.lit(i).cast(t))
    return of(documents.join(again, same, "left_anti")).unionByName(merged.select(
        PARTITION, F.array(F.struct(*ABOUT)).alias("kinds"), F.array("doc_id").alias("docs"), one(0, "smallint").alias("kind"),
        F.array("term").alias("terms"), one(1, "int").alias("held"), one(0, "smallint").alias("at"),
        F.array(F.size("long")).alias("counts"), F.array().cast("array<smallint>").alias("short"), "long"))


def spread(rows: DataFrame) -> DataFrame:
    """``(term, doc_id, positions, about the document..., bucket)``: one row per term and document of the rows of :func:`packed`."""
    kinds = rows.schema["kinds"].dataType.elementType
    described = ", ".join(f"{c} {kinds[c].dataType.simpleString()}" for c in ABOUT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _rows(b)

    return rows.select(*PACKED).mapInArrow(
        cut, f"term string, doc_id {rows.schema['docs'].dataType.elementType.simpleString()}, positions array<int>, {described}, {PARTITION} int")


def build(documents: DataFrame) -> DataFrame:
    """The table's rows from the stored lexeme lists. A document without words, or with a null list, has no row."""
    return spread(packed(documents))


def _readable(postings: DataFrame, types: Sequence[str] | None) -> DataFrame:
    active = postings.filter("is_active")
    return active if types is None else active.filter(F.col("source_type").isin(list(types)))


def of_terms(postings: DataFrame, terms: Sequence[str], types: Sequence[str] | None = None, active: bool = True) -> DataFrame:
    """Rows of some literal terms, of active documents unless told otherwise; other folders are not opened."""
    found = _readable(postings, types) if active else postings
    if not terms:
        return found.filter(F.lit(False))
    return found.filter(F.col(PARTITION).isin([_bucket(F.lit(t)) for t in terms]) & F.col("term").isin(list(terms)))


def _gathered(raw_slot: Column, stem_slot: Column) -> list[Column]:
    """Aggregates of one document's rows: its hits in order, and how many raw terms and stems it holds."""
    hits = F.transform("positions", lambda p: F.struct(
        p.cast("bigint").alias("pos"), raw_slot.alias("a"), stem_slot.alias("b")))
    return [F.sort_array(F.flatten(F.collect_list(hits))).alias("hits"),
            F.count_if(raw_slot > 0).alias("n_raw"), F.count_if(stem_slot > 0).alias("n_stem")]


def _literals(terms: Sequence[str]) -> Column:
    return F.array(*map(F.lit, terms)) if terms else F.array().cast("array<string>")


def matches(postings: DataFrame, raw: Sequence[str], stem: Sequence[str], types: Sequence[str] | None = None,
            active: bool = True) -> DataFrame:
    """Documents that hold all raw terms or all stems (``raw_match``, ``stem_match``), with their cover density.

    No terms match nothing. ``active=False`` looks at all documents and all types.
    """
    rows = of_terms(postings, list(dict.fromkeys([*raw, *stem])), types, active)
    slots = [F.array_position(_literals(t), F.col("term")) for t in (raw, stem)]
    per_doc = rows.groupBy("doc_id", "source_type", "retrieval_weight", "priority").agg(*_gathered(*slots))
    flags = [((F.col(c) == len(t)) if t else F.lit(False)).alias(m)
             for c, t, m in (("n_raw", raw, "raw_match"), ("n_stem", stem, "stem_match"))]
    return per_doc.select("*", *flags).filter("raw_match or stem_match").select(
        "doc_id", "source_type", "retrieval_weight", "priority", "raw_match", "stem_match",
        X.cover_density_of(F.col("hits"), _literals(raw), _literals(stem)).alias("bm25_score"))


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that the planner knows their size before it joins them."""
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def batch_matches(postings: DataFrame, queries: DataFrame, k: int, types: Sequence[str] | None = None) -> DataFrame:
    """Best ``k`` matches of every (query_id, query_text).

    A match holds all of the query's terms, raw or stem, so it holds the ``RAREST`` least frequent ones: only documents with
    those become candidates, and the query's other terms are looked for in them alone. Nothing is cut off. Terms and candidates
    are kept in between, so that they meet the positions by their size: where they are small, positions of other documents
    are not shuffled.
    """
    q = queries.select("query_id", F.array_distinct(X.tokens(F.col("query_text"))).alias("raw"),
                       F.array_distinct(X.stems(F.col("query_text"))).alias("stem"))
    asked = q.select("query_id", "raw", "stem", F.explode(F.array_distinct(F.concat("raw", "stem"))).alias("term")).select(
        "query_id", "term", F.array_position("raw", F.col("term")).alias("a"),
        F.array_position("stem", F.col("term")).alias("b"))
    terms = _kept(asked.select("term", _bucket(F.col("term")).alias(PARTITION)).distinct(), "asked_terms")
    # The partition column is part of the join, so the scan is pruned by the buckets of the terms asked for.
    readable = _readable(postings, types)
    wanted = readable.join(terms, [PARTITION, "term"], "left_semi")
    frequency = wanted.groupBy("term").agg(F.count("*").alias("df"))
    kinds = asked.select("query_id", "term", F.explode(F.filter(F.array(
        F.when(F.col("a") > 0, "raw"), F.when(F.col("b") > 0, "stem")), lambda x: x.isNotNull())).alias("kind"))
    by_rarity = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")))
    rarest = _kept(kinds.join(frequency, "term", "left").groupBy("query_id", "kind").agg(F.slice(by_rarity, 1, RAREST).alias("r"))
                   .filter(F.get("r", F.lit(0))["df"] > 0)
                   .select("query_id", "kind", F.size("r").alias("need"), F.explode("r.term").alias("term"))
                   .withColumn(PARTITION, _bucket(F.col("term"))), "rare_terms")
    # A document with several descriptions has several rows of a term: it may stay for now.
    candidates = _kept(readable.select(PARTITION, "term", "doc_id").join(rarest, [PARTITION, "term"])
                       .groupBy("query_id", "kind", "doc_id", "need").agg(F.count("*").alias("n")).filter("n >= need")
                       .select("query_id", "doc_id").distinct(), "candidates")
    of_candidates = wanted.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    rows = candidates.join(asked, "query_id").join(of_candidates, ["doc_id", "term"])
    per_doc = rows.groupBy("query_id", "doc_id", "source_type", "retrieval_weight", "priority").agg(
        *_gathered(F.col("a"), F.col("b")))

    def held(col: str, n: str) -> Column:
        return (F.size(col) > 0) & (F.col(n) == F.size(col))

    scored = per_doc.join(q, "query_id").filter(held("raw", "n_raw") | held("stem", "n_stem")).select(
        "query_id", "doc_id", "source_type", "retrieval_weight", "priority",
        X.cover_density_of(F.col("hits"), F.col("raw"), F.col("stem")).alias("bm25_score"))
    return top_per_group(scored, "query_id", [F.desc("bm25_score"), F.asc("doc_id")], k)
