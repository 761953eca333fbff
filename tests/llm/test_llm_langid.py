"""What the language stage lets pass, and which languages are learned."""

import random

from conftest import SF
from pyspark.sql import functions as F

from leakscope.llm import langid
from leakscope.llm.common import read

RUSSIAN = "это русский текст о погоде и людях которые живут в городе и каждый день ходят на работу хотя идет снег "
FINNISH = "tämä on suomenkielinen lause säästä ja ihmisistä jotka asuvat kaupungissa ja käyvät joka päivä töissä "


def gibberish(n):
    rng = random.Random(n)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))


def test_stage_drops_what_is_in_no_learned_language(spark):
    docs = read(spark, SF, "documents")
    own = {r.doc_id for r in docs.filter(F.col("text").rlike(r"\p{L}")).collect()}
    extra = [(-k, t, None, "x", len(t)) for k, t in enumerate(
        [RUSSIAN, RUSSIAN * 5, FINNISH, FINNISH * 5, gibberish(10), gibberish(50), gibberish(300), "12 34 !!"], 1)]
    got = langid.known_only(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == own


def test_stage_without_labels_drops_no_text(spark):
    rows = [(1, "some text", None), (2, "12 34", None), (3, None, None), (4, RUSSIAN, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.known_only(frame).collect()} == {1, 4}


def test_rare_languages_are_learned(spark):
    """However many rows the others have: two rows of 3,000 in one language, three in another."""
    rng = random.Random(1)
    words = "the people who live in the city go to work every day even though it snows and the wind is cold".split()
    rows = [(i, " ".join(rng.choices(words, k=12)), "en") for i in range(3000)]
    rows += [(10_000 + i, RUSSIAN, "ru") for i in (0, 2)] + [(20_000 + i, FINNISH, "fi") for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trained = {r.lang for r in frame.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).collect()}
    assert trained == {"en", "fi", "ru"}
    model = langid.fit(frame, rows=60)
    assert model.languages == ["en", "fi", "ru"]
    told = frame.select("lang", langid.identify(F.col("text"), model, spark).alias("l"))
    assert told.filter("lang <> l.lang_pred").count() == 0
    sizes = {r.lang: r["count"] for r in langid._sample(frame, "doc_id", "text", "lang", 60).groupBy("lang").count().collect()}
    assert sizes["en"] < 200


def test_held_out_rows_change_nothing(spark):
    docs = read(spark, SF, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = docs.withColumn("text", F.when(held, F.lit(RUSSIAN)).otherwise(F.col("text"))).withColumn(
        "lang", F.when(held, F.lit("ru")).otherwise(F.col("lang")))
    for calibrate in (False, True):
        a, b = (langid.fit(d, calibrate=calibrate) for d in (docs, other))
        assert a.languages == b.languages and a.limit == b.limit and (a.limit < float("inf")) == calibrate
        assert (a.weights == b.weights).all() and (a.slope == b.slope).all() and (a.trust == b.trust).all()


def test_a_language_of_one_row_is_learned_beside_the_limit(spark):
    rows = [(i, "the people live in the city and go to work", "en") for i in range(40)]
    rows += [(i, RUSSIAN, "ru") for i in (100, 102)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit(frame, calibrate=True).languages == ["en", "ru"]
