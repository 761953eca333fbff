import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leakscope.functions import text as X
from leakscope.operators import search


def brute_cover(words, raw, stem):
    """Every minimal span, found by trying all spans."""
    def satisfied(lo, hi):
        part = set(words[lo:hi + 1])
        return (raw and set(raw) <= part) or (stem and set(stem) <= part)

    terms, total = set(raw) | set(stem), 0.0
    for lo in range(len(words)):
        for hi in range(lo, len(words)):
            if satisfied(lo, hi):
                if not satisfied(lo + 1, hi) and not (hi > lo and satisfied(lo, hi - 1)):
                    noise = sum(1 for w in words[lo:hi + 1] if w not in terms)
                    total += X.COVER_WEIGHT / (1 + noise)
                break
    return round(total, 6)


def test_cover_density_equals_brute_force(spark):
    rnd = random.Random(3)
    cases = []
    for i in range(150):
        words = [rnd.choice("abcdefg") for _ in range(rnd.randint(0, 25))]
        raw = rnd.sample("abcd", rnd.randint(1, 3))
        stem = rnd.sample("abce", rnd.randint(0, 3))
        cases.append((i, words, raw, stem))
    df = spark.createDataFrame(cases, "i int, w array<string>, r array<string>, s array<string>")
    got = {r.i: r.x for r in df.select("i", X.cover_density(F.col("w"), F.col("r"), F.col("s")).alias("x")).collect()}
    for i, words, raw, stem in cases:
        assert abs(got[i] - brute_cover(words, raw, stem)) < 2e-6, (words, raw, stem)


def test_query_is_cut_like_documents(spark):
    texts = ["Refunds, delivered orders & BUSINESS rules", "été déjà payés; 12 items", "ings ing sing singing ties tied", ""]
    for text in texts:
        row = spark.createDataFrame([(text,)], "t string").select(
            F.array_distinct(X.tokens(F.col("t"))).alias("raw"), F.array_distinct(X.stems(F.col("t"))).alias("stem")).first()
        assert (row.raw, row.stem) == search.query_terms(text)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abdegilns éÄ3-", max_size=12), min_size=20, max_size=40))
def test_query_cut_on_random_text(texts):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", F.array_distinct(X.tokens(F.col("t"))).alias("raw"), F.array_distinct(X.stems(F.col("t"))).alias("stem")).collect()
    for r in rows:
        assert (r.raw, r.stem) == search.query_terms(r.t)


def test_stem_positions_follow_raw_positions(spark):
    content = ("Order ID: feedfe79\nRisk Tier: Medium\nAnomaly Score: 0.42")
    lex = spark.createDataFrame([(content,)], "t string").select(X.lexemes(F.col("t")).alias("l")).first().l
    half = len(lex) // 2
    assert lex[:half] == ["order", "id", "feedfe79", "risk", "tier", "medium", "anomaly", "score", "0", "42"]
    assert len(lex) == 2 * half and lex[half + 6] == "anoma" and lex[half + 5] == "medium"


def test_trigram_similarity(spark):
    df = spark.createDataFrame([("word", "two words"), ("cat", "cat"), ("", "")], "a string, b string")
    got = [r.s for r in df.select(X.trigram_similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    # "word" has 5 trigrams, "two words" has 10, 4 are shared
    assert abs(got[0] - 4 / 11) < 1e-9 and got[1] == 1.0 and got[2] is None


def test_text_matches(spark):
    df = spark.createDataFrame([("the refunded orders",), ("refund order",), ("refunded",)], "t string")
    raw, stem = search.query_terms("refunded orders")
    assert [r.m for r in df.select(X.text_matches(F.col("t"), raw, stem).alias("m")).collect()] == [True, True, False]
