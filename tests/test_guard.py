import pytest
from pyspark.sql import functions as F

from leakscope.operators import guard


def hits(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "sql_text string")
    return [(r.guard_type, r.pattern) for r in guard.validate_sql(df).collect()]


def test_known_bad_statement_breaks_two_rules(spark):
    got = hits(spark, "SELECT SUM(orders.amount) FROM ecommerce.payments WHERE order_id = 'X'")
    assert [t for t, _ in got] == ["fake_column", "dangerous_join"]
    assert got[0][1] == "orders.amount" and "payment_sequential" in got[1][1]


def test_good_statement_is_clean(spark):
    assert hits(spark, "SELECT payment_value FROM ecommerce.payments WHERE payment_sequential = 1") == []
    assert hits(spark, "SELECT price_after_discount FROM order_items i JOIN orders o USING (order_id) WHERE price_after_discount > 1") == []


def test_contains_wildcards_stay_live_and_dots_are_literal(spark):
    assert hits(spark, "select orderXitemsXfinalYprice") == []  # the dot is literal, "_" is any one character
    assert hits(spark, "select orderXitems.finalYprice") == [("fake_column", "order_items.final_price")]
    assert hits(spark, "select ordersXamount") == []


def test_regex_spans_lines_and_cases(spark):
    text = "select 1 from REVIEWS r\njoin b on 1=1 join orders o\n join x join payments p join y join shipping s"
    assert ("dangerous_join", guard.GUARD_RULES[10].pattern) in hits(spark, text)
    assert hits(spark, "select oi.price from order_items oi\njoin orders o\nwhere oi.price > 1")[0][0] == "dangerous_join"


def test_exact_mode_and_unknown_mode(spark):
    rule = guard.GuardRule("g", "exact", "DROP", "m")
    df = spark.createDataFrame([("DROP",), ("drop",), ("DROP x",)], "sql_text string")
    assert guard.validate_sql(df, rules=[rule]).count() == 1
    with pytest.raises(ValueError):
        guard.breaks(F.col("sql_text"), guard.GuardRule("g", "fuzzy", "x", "m"))


def test_intents_take_the_first_match(spark):
    df = spark.createDataFrame(
        [("Show me the total",), ("Average per table",), ("كم عدد الطلبات",), ("monthly trend",), ("hello",)], "q string")
    got = [r.i for r in df.select(guard.intent(F.col("q")).alias("i")).collect()]
    assert got == ["simple_lookup", "aggregation", "simple_lookup", "trend_analysis", None]
