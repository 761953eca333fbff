import numpy as np
import pytest
from pyspark.sql import functions as F

from leakscope.functions import text as X
from leakscope.functions.vectors import cosine, cosine_scores
from leakscope.operators import ivf, search, vector_blocks

DIM = 8


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    words = ["refund", "order", "late", "seller", "margin", "payment"]
    docs, vecs = [], []
    for i in range(300):
        text = " ".join(rng.choice(words, size=int(rng.integers(1, 15))))
        # half of the corpus is one source type
        kind = "review" if i % 2 else ["schema_doc", "sql_template", "join_graph"][i % 3]
        docs.append((i, kind, f"T{i}", text, "{}", int(rng.integers(1, 11)), float(rng.choice([0.6, 1.0, 1.5])), i % 17 != 0))
        if i % 5:
            vecs.append((i, [float(x) for x in rng.normal(size=DIM)]))
    d = spark.createDataFrame(
        docs, "doc_id bigint, source_type string, title string, content string, metadata string, priority int, w double, "
              "is_active boolean")
    d = d.withColumn("retrieval_weight", F.col("w").cast("decimal(4,2)")).drop("w").withColumn(
        "content_tsv", X.lexemes(F.col("content"))).cache()
    e = spark.createDataFrame(vecs, "doc_id bigint, embedding array<float>").cache()
    return d, e, docs, dict(vecs)


def exact_search(spark, docs, vecs, query, vector, k, cap=2, types=None):
    """The search spelled out in plain Python."""
    raw, stem = search.query_terms(query)
    texts = spark.createDataFrame([(d[0], d[3]) for d in docs], "i bigint, t string").select(
        "i", X.lexemes(F.col("t")).alias("l"))
    scored = {}
    arr = lambda ts: F.array(*[F.lit(t) for t in ts])
    for r in texts.select("i", "l", X.cover_density(F.col("l"), arr(raw), arr(stem)).alias("s")).collect():
        if set(raw) <= set(r.l) or set(stem) <= set(r.l):
            scored[r.i] = r.s
    usable = {d[0]: d for d in docs if d[7] and (types is None or d[1] in types)}
    kw = sorted(((s, i) for i, s in scored.items() if i in usable), key=lambda p: (-p[0], p[1]))[:3 * k]
    sims = []
    if vector is not None:
        for i, v in vecs.items():
            if i in usable:
                v = np.array(v, dtype="float32").astype(float)
                sims.append((round(float(v @ vector / np.linalg.norm(v) / np.linalg.norm(vector)), 6), i))
        sims = sorted(sims, key=lambda p: (-p[0], p[1]))[:3 * k]
    both = {}
    for s, i in kw:
        both[i] = [s, 0.0]
    for s, i in sims:
        both.setdefault(i, [0.0, 0.0])[1] = s
    rows = [(round((0.4 * a + 0.6 * b) * usable[i][6], 9), usable[i][5], i, usable[i][1]) for i, (a, b) in both.items()]
    kept = []
    for kind in {r[3] for r in rows}:
        mine = sorted((r for r in rows if r[3] == kind), key=lambda r: (-r[0], r[2]))
        kept += mine[:cap] if cap else mine
    return [r[2] for r in sorted(kept, key=lambda r: (-r[0], -r[1], r[2]))[:k]]


def ids(df):
    return [r.doc_id for r in df.collect()]


def test_hybrid_equals_plain_python(spark, corpus):
    d, e, docs, vecs = corpus
    vector = np.random.default_rng(9).normal(size=DIM)
    for query in ("refund order", "late", "missing words"):
        assert ids(search.hybrid_search(d, e, query, vector.tolist(), k=8)) == exact_search(spark, docs, vecs, query, vector, 8)
    got = ids(search.hybrid_search(d, e, "refund order", vector.tolist(), ["review"], 5, per_type_cap=None))
    assert got == exact_search(spark, docs, vecs, "refund order", vector, 5, cap=None, types=["review"])
    assert ids(search.hybrid_search(d, e, "refund order", None, k=8)) == exact_search(spark, docs, vecs, "refund order", None, 8)


def test_result_schema_and_wrappers(corpus):
    d, e, _, vecs = corpus
    out = search.search_analytics(d, e, "order margin", vecs[1])
    assert out.columns == ["doc_id", "source_type", "title", "content", "metadata", "bm25_score", "vector_score",
                           "hybrid_score", "priority", "retrieval_weight"]
    assert {r.source_type for r in out.collect()} <= set(search.ANALYTICS_TYPES)
    reviews = search.search_reviews(d, e, "order", vecs[1]).collect()
    assert len(reviews) == 2 and all(r.source_type == "review" for r in reviews)
    assert len(search.search_reviews(d, e, "order", vecs[1], per_type_cap=None).collect()) == 5


@pytest.mark.parametrize("rows", [10_000, 3])
def test_batch_equals_single_queries(spark, corpus, monkeypatch, rows):
    """Also when queries and vectors are dealt into many blocks and scores come in small pieces."""
    d, e, _, vecs = corpus
    monkeypatch.setattr(vector_blocks, "SCORE_CELLS", 64)
    monkeypatch.setattr(vector_blocks, "QUERY_ROWS", rows)
    monkeypatch.setattr(vector_blocks, "STORED_ROWS", 10 * rows)
    queries = [(1, "refund order", vecs[1]), (2, "late", vecs[2]), (3, "the", vecs[3]), (4, "order", None),
               (5, "", vecs[6]), (6, "late", vecs[2]), (7, "margin seller", [0.0] * DIM)]
    q = spark.createDataFrame(queries, "query_id int, query_text string, query_vector array<float>")
    near = search.batch_vector_hits(d, e, q, 24)
    words = search.batch_keyword_hits(d, q, 24)
    for query_id, text, vector in queries:
        got = [(r.doc_id, r.bm25_score) for r in words.filter(F.col("query_id") == query_id).orderBy(
            F.desc("bm25_score"), "doc_id").collect()]
        want = [(r.doc_id, r.bm25_score) for r in search.keyword_hits(d, text, 24).collect()] if text else []
        assert got == want
        got = ids(near.filter(F.col("query_id") == query_id).orderBy(F.desc("vector_score"), "doc_id"))
        assert got == (ids(search.vector_hits(d, e, vector, 24)) if vector else [])
    if rows > 3:
        pairs = ((search.batch_search, search.hybrid_search), (search.batch_search_analytics, search.search_analytics),
                 (search.batch_search_reviews, search.search_reviews))
        for batch, single in pairs:
            best = batch(d, e, q).collect()
            for query_id, text, vector in queries[:3]:
                got = [r.doc_id for r in sorted(best, key=lambda r: r.rank) if r.query_id == query_id]
                assert got == ids(single(d, e, text, vector))


def test_cosine_forms_agree(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=20)]) for i in range(50)]
    q = [float(x) for x in rng.normal(size=20)]
    odd = [(98, [1.0]), (99, [0.0] * 20)]  # wrong length, no direction: not scored
    df = spark.createDataFrame(rows + odd, "doc_id int, embedding array<double>")
    fast = {r.doc_id: r.vector_score for r in cosine_scores(df, q).collect()}
    slow = {r.doc_id: r.s for r in df.filter("doc_id < 98").select("doc_id", cosine(F.col("embedding"), F.lit(q)).alias("s")).collect()}
    assert set(fast) == set(slow) and all(abs(fast[i] - slow[i]) < 1e-6 for i in fast)
    assert cosine_scores(df, [0.0] * 20).count() == 0


def test_ivf_recall_and_exactness(corpus):
    d, e, _, vecs = corpus
    celled, centres = ivf.build_cells(e, cells=8)
    celled = celled.cache()
    hit = total = 0
    for probe in list(vecs)[:20]:
        exact = ids(ivf.probe_search(celled, centres, vecs[probe], 10, probes=8))
        want = [r.doc_id for r in cosine_scores(e, vecs[probe]).orderBy(F.desc("vector_score"), "doc_id").limit(10).collect()]
        assert exact == want
        hit += len(set(want) & set(ids(ivf.probe_search(celled, centres, vecs[probe], 10, probes=5))))
        total += 10
    assert hit / total > 0.8


@pytest.mark.parametrize("rows", [10_000, 4])
def test_probed_batch_equals_single_probes(spark, corpus, monkeypatch, rows):
    """Cells are cut into blocks without changing what is found; by default cells grow with the root of the rows."""
    _, e, _, vecs = corpus
    monkeypatch.setattr(vector_blocks, "STORED_ROWS", rows)
    monkeypatch.setattr(vector_blocks, "QUERY_ROWS", rows)
    celled, centres = ivf.build_cells(e)
    celled = celled.cache()
    assert len(centres) == round(len(vecs) ** 0.5)
    asked = [(i, vecs[i]) for i in list(vecs)[:6]] + [(-1, None), (-2, [1.0])]
    q = spark.createDataFrame(asked, "query_id int, query_vector array<float>")
    got = ivf.probe_batch(celled, centres, q, 5, 3).collect()
    assert {r.query_id for r in got} == {i for i, _ in asked[:6]}
    for i, vector in asked[:6]:
        mine = sorted(((-r.vector_score, r.doc_id) for r in got if r.query_id == i))
        assert [m[1] for m in mine] == ids(ivf.probe_search(celled, centres, vector, 5, 3))
    exact = vector_blocks.exact_matches(celled, q, 5)
    full = ivf.recall(ivf.probe_batch(celled, centres, q, 5, len(centres)), exact).first()
    assert full.neighbours == full.found == 30
    probes = ivf.probes_for(celled, centres, q, 5, 0.8)
    less = ivf.recall(ivf.probe_batch(celled, centres, q, 5, probes - 1), exact).first()
    enough = ivf.recall(ivf.probe_batch(celled, centres, q, 5, probes), exact).first()
    assert less.found < 24 <= enough.found


def test_search_for_some_types_reads_only_their_vectors(spark, plat):
    """Both tables are pruned to the folders of the source types asked for."""
    found = search.vector_hits(plat.published("documents"), plat.published("embeddings"), [0.1] * 64, 5, ["schema_doc"])
    plan = found._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(scans) >= 2 and all("schema_doc" in line.split("PartitionFilters")[1] for line in scans)


def test_vectors_of_another_shape_do_not_fail_a_batch(spark):
    from leakscope.operators import search

    docs = spark.createDataFrame([(i, "t", True, 1, 1.0) for i in (1, 2, 3)],
                                 "doc_id bigint, source_type string, is_active boolean, priority int, retrieval_weight double")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [None, 1.0])], "doc_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.0]), (8, [1.0]), (9, [None, 0.0]), (10, None), (11, [0.0, 1.0, 0.0])],
                                  "query_id int, query_vector array<double>")
    got = search.batch_vector_hits(docs, vectors, asked, 5).select("query_id", "doc_id").collect()
    assert sorted(map(tuple, got)) == [(7, 1), (11, 2)]
