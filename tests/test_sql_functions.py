"""SQL functions give what their DataFrame forms give."""

from pyspark.sql import functions as F

from leakscope.operators import guard
from leakscope.plans import sql_functions

STATEMENTS = [
    "SELECT orders.status FROM orders", "select ORDERS_STATUS, 'Complete' from t", "SELECT 1", "", None,
    "SELECT * FROM reviews r JOIN orders o\nJOIN payments p JOIN shipping s", "SELECT x FROM ecommerce.payments WHERE a = 'success'",
    "SELECT x FROM ecommerce.payments WHERE payment_sequential = 1", r"it's \ 'quoted'",
]


def test_statements_are_vetted_alike(spark):
    sql_functions.register(spark)
    rows = spark.createDataFrame(list(enumerate(STATEMENTS)), "statement_id int, sql_text string")
    rows.createOrReplaceTempView("given_statements")
    want = guard.validate_sql(rows).select("statement_id", "guard_type", "pattern", "message").collect()
    got = spark.sql("SELECT statement_id, inline(found) FROM "
                    "(SELECT statement_id, sql_findings(sql_text) AS found FROM given_statements)").collect()
    assert sorted(got) == sorted(want) and len(got) >= 5
    for i, text in enumerate(STATEMENTS):
        if text is not None:
            one = spark.sql("SELECT * FROM validate_sql(:text)", {"text": text}).collect()
            assert sorted(one) == sorted((r.guard_type, r.pattern, r.message) for r in want if r.statement_id == i)


def test_own_rules_with_quotes(spark):
    rules = (guard.GuardRule("own", "exact", r"a 'b' \d", "it's"), guard.GuardRule("own", "regex", r"\d'\s", "digits"))
    sql_functions.register(spark, rules)
    assert [r.message for r in spark.sql("SELECT * FROM validate_sql(:t)", {"t": r"a 'b' \d"}).collect()] == ["it's"]
    assert [r.message for r in spark.sql("SELECT * FROM validate_sql(:t)", {"t": "7' x"}).collect()] == ["digits"]
    sql_functions.register(spark)


def test_intents(spark):
    sql_functions.register(spark)
    asked = ["Show me orders", "total by month", "monthly trend", "أظهر الجدول", "nothing known", None]
    rows = spark.createDataFrame([(a,) for a in asked], "q string")
    rows.createOrReplaceTempView("given_questions")
    got = spark.sql("SELECT q, question_intent(q) AS i, question_sources(q) AS s FROM given_questions").collect()
    want = rows.select("q", guard.intent(F.col("q")).alias("i")).select("q", "i", guard.intent_sources(F.col("i")).alias("s")).collect()
    assert got == want
