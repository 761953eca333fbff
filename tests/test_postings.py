"""The keyword leg from stored word positions gives the rows of the lexeme lists and reads only its terms' folders."""

import re

import pytest
from pyspark.sql import functions as F

from leakscope.functions import text as X
from leakscope.operators import postings, search

WORDS = "the refunds refunded late order orders of a seller and margins".split()


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with a word in all of them, none, a null list, and inactive ones."""
    rows = [(i, ["review", "schema_doc"][i % 3 == 0], " ".join(["hot", *[WORDS[(i * j + j) % len(WORDS)] for j in range(i % 9)]]), i % 7 != 0)
            for i in range(200)] + [(1000, "review", "", True), (1001, "review", None, True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source_type string, content string, is_active boolean").select(
        "*", F.lit(1).cast("smallint").alias("priority"), F.lit("1.50").cast("decimal(4,2)").alias("retrieval_weight"),
        X.lexemes(F.col("content")).alias("content_tsv")).cache()
    return docs, postings.build(docs).cache()


@pytest.mark.parametrize("query", ["hot", "refund", "the refunded order", "late late", "absent", "", "hot absent", "orders of the seller"])
@pytest.mark.parametrize("types", [None, ["review"]])
def test_leg_equals_lexeme_lists(corpus, query, types):
    docs, table = corpus
    want = search.keyword_hits(docs, query, 500, types).collect() if query else []
    assert search.keyword_hits(docs, query, 500, types, table).collect() == want


def test_batch_equals_single(spark, corpus):
    docs, table = corpus
    asked = ["hot", "refund", "the refunded order", "", "absent", "hot late", None]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id int, query_text string")
    got = postings.batch_matches(table, q, 30, ["review"]).collect()
    for i, text in enumerate(asked):
        mine = sorted(((-r.bm25_score, r.doc_id) for r in got if r.query_id == i))
        want = search.keyword_hits(docs, text, 30, ["review"]).collect() if text else []
        assert mine == [(-r.bm25_score, r.doc_id) for r in want]


def test_inactive_documents_only_when_asked_for(corpus):
    docs, table = corpus
    assert postings.matches(table, ["hot"], ["hot"], active=False).count() == 200
    assert postings.matches(table, ["hot"], ["hot"]).count() == docs.filter("is_active and doc_id < 1000").count()
    assert table.filter("doc_id >= 1000").count() == 0


def test_empty_corpus(spark, corpus):
    docs, _ = corpus
    none = postings.build(docs.limit(0))
    assert postings.matches(none, ["a"], ["a"]).count() == 0
    q = spark.createDataFrame([(1, "a")], "query_id int, query_text string")
    assert postings.batch_matches(none, q, 3).count() == 0


def test_scan_is_pruned_to_the_terms(plat):
    table = plat.published("postings")
    found = postings.matches(table, ["this", "was"], ["this", "was"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content_tsv" not in plan
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert "bucket" in filters[1] and "term" in filters[2]
    read = found.inputFiles()
    assert 0 < len({f.split("bucket=")[1].split("/")[0] for f in table.inputFiles()}) <= postings.BUCKETS and read
    opened = table.filter(F.col("bucket").isin([postings._bucket(F.lit(t)) for t in ("this", "was")]))
    assert opened.select("bucket").distinct().count() <= 2


def test_positions_follow_refreshed_documents(spark, plat):
    from leakscope.plans.platform import Platform

    own = Platform(spark, plat.star.folder, root=f"{plat.root}/scratch/positions-{spark.sparkContext.startTime}")
    before = own.published("postings")
    own.refresh("documents")
    assert own.store._versions("postings", True) == [1, 2]
    assert own.published("postings").count() == before.count()


def test_words_are_told_apart_without_a_shuffle(spark, corpus):
    """Neither lexeme lists nor single words are shuffled on the way to the table, and none is sorted out of an aggregate."""
    docs, _ = corpus
    plan = postings.build(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_positions_of_every_word(spark):
    """Against a plain count, with words that come often, null words, empty lists and rows with an id that repeats."""
    lists = [["b", "a", "b", "c"], [], None, ["x", None, "x", None], ["w%d" % (i % 90) for i in range(700)], ["b", "b"], ["b", "z"], ["n"], ["n", "m"],
             ["f", *["g"] * 40_000, "f"]]
    ids = [1, 2, 3, 4, 5, 1, 1, None, None, 6]
    rows = [(d, "review", True, i == 6, words) for i, (d, words) in enumerate(zip(ids, lists, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id bigint, source_type string, is_active boolean, low boolean, content_tsv array<string>").select(
        "doc_id", "source_type", "is_active", F.when(F.col("low"), 1).otherwise(2).cast("smallint").alias("priority"),
        F.lit("1.50").cast("decimal(4,2)").alias("retrieval_weight"), "content_tsv")
    want = {}
    for d, _, _, low, words in rows:
        for at, word in enumerate(words or []):
            want.setdefault((d, 1 if low else 2, word), []).append(at)
    got = postings.build(docs).select("*", postings._bucket(F.col("term")).alias("own")).collect()
    assert {(r.doc_id, r.priority, r.term): r.positions for r in got} == {k: sorted(v) for k, v in want.items()}
    assert len(got) == len(want) and all(r.bucket == r.own for r in got)


def test_words_are_packed_by_batches_of_documents(spark, corpus, monkeypatch):
    """A term travels once for all documents of a batch, in Arrow batches of bounded size, and the rows are the same (F1)."""
    docs, table = corpus
    want = sorted(map(str, table.collect()))
    one = docs.coalesce(1)
    rows = postings.packed(one).collect()
    assert len(rows) <= postings.BUCKETS and len({t for r in rows for t in r.terms}) == sum(len(r.terms) for r in rows)
    monkeypatch.setattr(postings, "CHUNK", 7)
    assert len(postings.packed(one).collect()) > len(rows)
    assert sorted(map(str, postings.build(one).collect())) == want
    monkeypatch.setattr(postings, "CHUNK", 1_024)
    monkeypatch.setattr(postings, "CHUNK_BYTES", 1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(str, postings.build(one).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_batches_are_small_where_rows_are_unpacked(spark, corpus, tmp_path):
    """The settings hold while the table is written, and only then."""
    from leakscope.sources import tables

    docs, _ = corpus
    name, value = tables.UNPACKED_ROWS
    before, seen = spark.conf.get(name), []

    def unpack(rows):
        return postings.spread(rows)

    class Store(tables.TableStore):
        def _set(self, settings):
            seen.extend(settings)
            return super()._set(settings)

    stored = Store(spark, str(tmp_path)).replace("postings", postings.packed(docs), [postings.PARTITION], list(postings.ORDER), unpack=unpack)
    assert (name, value) in seen and spark.conf.get(name) == before
    assert stored.count() == corpus[1].count()


def test_positions_of_other_documents_are_not_shuffled(spark, corpus, monkeypatch):
    """Candidates hold several of a query's rarest terms; the positions of other documents meet them in a broadcast (F2)."""
    docs, table = corpus
    kept, plain = {}, postings._kept
    monkeypatch.setattr(postings, "_kept", lambda rows, name: kept.setdefault(name, plain(rows, name)))
    asked = ["hot seller margins", "hot the late order", "hot nowhere", "hot"]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id int, query_text string")
    # Written, so that the planner knows the sizes of all it joins.
    got = postings.batch_matches(plain(table, "table"), q, 30)
    both = docs.filter("is_active and array_contains(content_tsv, 'seller') and array_contains(content_tsv, 'margin')").count()
    assert 0 < both < docs.filter("is_active and array_contains(content_tsv, 'seller')").count()
    assert kept["candidates"].filter("query_id = 0").count() == both and kept["candidates"].filter("query_id = 2").count() == 0
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin [bucket" not in text
    rows = got.collect()
    for i, t in enumerate(asked):
        want = search.keyword_hits(docs, t, 30).collect()
        assert sorted((-r.bm25_score, r.doc_id) for r in rows if r.query_id == i) == [(-r.bm25_score, r.doc_id) for r in want]
