"""Lines placed by order before they are reduced: how often rows travel, and the same results as without."""

import datetime as dt

import pytest

from leakscope.plans import corpus, marts, orders
from leakscope.sources import star as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Orders with repeated line numbers, equal lines and missing values; one order without a number."""
    folder = str(tmp_path_factory.mktemp("lines"))
    day = dt.datetime(1995, 1, 1)
    lines = [(i % 7 if i % 7 != 6 else None, i % 5, i % 3, None if i % 11 == 0 else i % 4, float(i % 9), 100.0 + i % 13, 0.1 * (i % 2),
              0.01 * (i % 9), "R" if i % 2 else "N", "F" if i % 3 else "O", day) for i in range(300)]
    columns = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
               "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    spark.createDataFrame(lines + lines[:40], columns).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, 10.0) for i in range(4)] + [(0, 10.0)], "p_partkey long, p_retailprice double").write.parquet(
        f"{folder}/part.parquet")
    return S.Star(spark, folder)


@pytest.mark.parametrize("lines", [40, 1_000_000])
def test_first_payments_are_sorted_once_after_they_are_placed(star, monkeypatch, lines):
    monkeypatch.setattr(S, "TASK_LINES", lines)
    placed, plain = orders.payment_summary(star.payments(by_order=True)), orders.payment_summary(star.payments())
    text = plan(placed)
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1 < plan(plain).count("Sort [")
    assert text.index("Sort [") < text.index("Exchange")  # read from below: lines travel, then are sorted
    assert sorted(map(str, placed.collect())) == sorted(map(str, plain.collect()))
    if lines == 40:
        assert "hashpartitioning(l_orderkey" in text and f", {-(-340 // 40)})" in text.replace(", REPARTITION_BY_NUM", ")")


def test_pairs_of_order_and_seller_travel_once(spark, star):
    sellers = spark.createDataFrame([(i, f"s{i}") for i in range(3)], "seller_id long, seller_name string")
    for c in marts.SELLER_RISK_COLUMNS:
        if c not in ("seller_id", "seller_name", "total_orders", "leakage_orders", "total_revenue", "avg_anomaly_score", "leakage_rate_pct"):
            sellers = sellers.selectExpr("*", f"1 AS {c}")
    scores = spark.createDataFrame([(i, i % 2, None) for i in range(6)], "order_id long, anomaly_flag int, ensemble_score decimal(8,6)")
    items = star.order_items().select("order_id", "seller_id", "price_after_discount")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed, plain = marts.seller_risk(sellers, star.by_order(items), scores), marts.seller_risk(sellers, items, scores)
        assert plan(placed).count("Exchange") == plan(plain).count("Exchange") - 1
        assert sorted(map(str, placed.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_of_top_reviews_are_met_by_key(spark):
    rows = [("r1", "a", "a long enough comment", "negative"), ("r1", "a", "short", "negative"), ("r2", "b", "another long comment", "neutral"),
            ("r2", "b", "the same key again, long", "neutral"), ("r3", None, "nobody ordered this one", "negative"), (None, "a", "no number on it", "negative")]
    reviews = spark.createDataFrame([(r, o, t, s, dt.datetime(2024, 1, 1), False, s) for r, o, t, s in rows],
                                    "review_id string, order_id string, review_comment string, sentiment string, review_date timestamp, "
                                    "is_emoji_only boolean, rating_group string")
    placed = spark.createDataFrame([("a", "delivered"), ("b", "delivered"), ("b", "delivered")], "order_id string, order_status string")
    scores = spark.createDataFrame([("a", 1, "High"), ("b", 0, "Low")], "order_id string, anomaly_flag int, risk_tier string")
    reasons = spark.createDataFrame([("a", "no_invoice_on_completion")], "order_id string, leakage_type string")
    known = spark.createDataFrame([], "source_type string, source_id string")
    got = corpus.review_documents(reviews, placed, scores, reasons, known, 200)
    assert plan(got).count("LeftSemi") == 4 and "TakeOrdered" not in plan(got)
    assert sorted(r.content.rsplit("Review: ", 1)[1] for r in got.collect()) == [
        "a long enough comment", "another long comment", "another long comment", "the same key again, long", "the same key again, long"]
    assert {r.source_id for r in corpus.review_documents(reviews, placed, scores, reasons, known, 1).collect()} <= {"a"}
