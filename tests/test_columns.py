import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from leakscope.functions import columns as C
from leakscope.plans import orders


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("if_score, lof_score, expected", [
    ("0.363543", "0.040777", "0.250575"), ("0.078715", "0.014981", "0.056408"), ("0.130913", "0.023230", "0.093224")])
def test_ensemble_score(spark, if_score, lof_score, expected):
    row = one(spark, s=C.ensemble_score(C.dec(if_score, 8, 6), C.dec(lof_score, 8, 6)))
    assert row.s == D(expected)


@pytest.mark.parametrize("revenue, logistics, expected", [
    ("144.50", "52.42", "70.40"), ("597.48", "98.67", "409.19"), ("7423.37", "413.14", "5896.72")])
def test_total_profit_within_a_cent(spark, revenue, logistics, expected):
    row = one(spark, p=C.total_profit(C.dec(revenue, 14, 2), C.dec(logistics, 14, 2)))
    assert abs(row.p - D(expected)) <= D("0.01")


def test_margin_and_ratios(spark):
    row = one(
        spark, m=C.profit_margin(C.dec("70.40", 14, 2), C.dec("144.50", 14, 2)),
        none=C.profit_margin(C.dec("1", 14, 2), C.dec("0", 14, 2)),
        a=C.fee_to_cost_ratio(C.dec("68.07", 10, 2), C.dec("52.42", 10, 2)),
        b=C.fee_to_cost_ratio(C.dec("16.86", 10, 2), C.dec("98.67", 10, 2)),
        c=C.fee_to_cost_ratio(C.dec("63.27", 10, 2), C.dec("413.14", 10, 2)))
    assert (row.m, row.none, row.a, row.b, row.c) == (D("0.4872"), None, D("1.2986"), D("0.1709"), D("0.1531"))


@pytest.mark.parametrize("price, discount, expected", [
    ("149.43", "0.033", "144.50"), ("457.52", "0.004", "455.69"), ("157.02", "0.097", "141.79")])
def test_price_after_discount(spark, price, discount, expected):
    assert one(spark, p=C.price_after_discount(C.dec(price, 12, 2), C.dec(discount, 5, 3))).p == D(expected)


@pytest.mark.parametrize("delivered, estimated, days", [
    ("2023-05-31", "2023-06-02", -2), ("2023-09-01", "2023-08-30", 2), ("2023-11-11", "2023-11-12", -1)])
def test_delay(spark, delivered, estimated, days):
    assert one(spark, d=C.shipping_delay_days(F.to_timestamp(F.lit(delivered)), F.to_timestamp(F.lit(estimated)))).d == days


def test_calendar_is_cairo_time(spark):
    # 22:30 UTC on the last of the month is already the next month in Cairo
    ts = F.expr("timestamp_ntz '2023-08-31 22:30:00'")
    row = one(spark, m=C.order_month(ts), q=C.order_quarter(ts), y=C.order_year(ts), label=C.month_label(C.order_month(ts)))
    assert (row.m, row.q, row.y, row.label) == (dt.date(2023, 9, 1), dt.date(2023, 7, 1), 2023, "September 2023")


def test_session_minutes_and_cost(spark):
    row = one(
        spark,
        m=C.session_minutes(F.expr("timestamp_ntz '2024-01-01 23:31:00'"), F.expr("timestamp_ntz '2024-01-02 00:31:00'")),
        usd=C.token_cost_usd(F.lit(1000), F.lit(200)))
    assert (row.m, row.usd) == (D("60.00"), D("0.006000"))


@pytest.mark.parametrize("score, tier", [
    ("0.399999", "Low"), ("0.40", "Medium"), ("0.65", "High"), ("0.80", "Critical"), (None, None)])
def test_tier_edges(spark, score, tier):
    col = F.lit(None).cast("decimal(8,6)") if score is None else C.dec(score, 8, 6)
    assert one(spark, t=C.risk_tier(col)).t == tier


def test_enum_rank_follows_declared_order(spark):
    df = spark.createDataFrame([("Critical",), ("Low",), ("High",), ("odd",)], "t string")
    ranks = {r.t: r.k for r in df.select("t", C.enum_rank(F.col("t"), "risk_tier").alias("k")).collect()}
    assert ranks == {"Low": 1, "High": 3, "Critical": 4, "odd": None}


def test_concat_skips_null_and_shorten(spark):
    row = one(spark, a=C.text_or_empty("x", F.lit(None).cast("string"), "y"), cut=C.shorten(F.lit("a" * 61)),
              kept=C.shorten(F.lit("a" * 60)))
    assert (row.a, row.cut, row.kept) == ("xy", "a" * 60 + "…", "a" * 60)


def test_order_rollup_sums_items(spark):
    items = spark.createDataFrame(
        [("o", D("455.69"), D("58.56"), D("1"), D("0.004")), ("o", D("141.79"), D("40.11"), D("1"), D("0.097"))],
        "order_id string, price_after_discount decimal(12,2), logistics_cost decimal(10,2), freight_value decimal(10,2), "
        "item_discount_pct decimal(5,3)")
    row = orders.order_rollup(items).first()
    assert (row.total_revenue, row.total_logistics, row.item_count) == (D("597.48"), D("98.67"), 2)
    assert row.avg_discount_pct == D("0.051")  # 0.0505 rounds half up
    assert row.profit_margin == D("0.6849")


def test_latest_review_breaks_ties_by_id(spark):
    rows = spark.createDataFrame(
        [("o", "a", 1.0, "negative", "old", dt.datetime(2024, 1, 1)), ("o", "b", 2.0, "neutral", "tie-b", dt.datetime(2024, 1, 2)),
         ("o", "c", 3.0, "positive", "tie-c", dt.datetime(2024, 1, 2))],
        "order_id string, review_id string, rating double, sentiment string, review_comment string, review_date timestamp")
    assert [r.review_comment for r in orders.latest_review(rows).collect()] == ["tie-c"]


def test_dashboard_meets_customers_before_it_is_wide(plat):
    """The last shuffle before the dashboard is laid out is by order; customers are joined to the orders alone."""
    plan = plat.build("dashboard")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    by_order, by_customer = ([i for i, j in enumerate(joins) if c in j] for c in ("order_id", "customer_id"))
    assert len(by_order) == 4 and len(by_customer) == 1 and by_customer[0] > by_order[-1]
