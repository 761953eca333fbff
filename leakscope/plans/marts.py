"""The four published views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.functions import columns as C
from leakscope.sources.schemas import DASHBOARD_COLUMNS, MONTHLY_COLUMNS, SCENARIO_COLUMNS, SELLER_RISK_COLUMNS


def dashboard(orders: DataFrame, customers: DataFrame, payments: DataFrame, shipping: DataFrame,
              reviews: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per order with everything an analyst asks about, in the published column order.

    ``payments`` and ``reviews`` come with one row per order (primary payment, newest review). All
    joins but the one to customers use ``order_id``, so the orders are shuffled on it once. Customers come first, while
    the rows are narrow.
    """
    return (
        orders.join(customers.select("customer_id", "customer_name", "customer_city",
                                     F.col("segment").alias("customer_segment")), "customer_id")
        .join(payments.select("order_id", "payment_type", "payment_value", "seller_paid_twice"),
                    "order_id", "left")
        .join(shipping.select("order_id", "shipping_status", "shipping_fee_charged", "actual_logistics_cost",
                              "fee_calculation_error", "fee_to_cost_ratio", "carrier"), "order_id", "left")
        .join(reviews, "order_id", "left")
        .join(scores.select("order_id", "ensemble_score", "anomaly_flag", "risk_tier", "leakage_scenarios",
                            "leakage_reason"), "order_id", "left")
        .select(*DASHBOARD_COLUMNS)
    )


def monthly_leakage(dash: DataFrame) -> DataFrame:
    flagged = F.col("anomaly_flag") == 1
    return (
        dash.groupBy(F.col("order_month").alias("month"))
        .agg(
            F.count("*").alias("total_orders"),
            F.count_if(flagged).alias("leakage_orders"),
            F.sum("total_revenue").alias("total_revenue"),
            F.coalesce(F.sum(F.when(flagged, F.col("total_revenue"))), F.lit(0)).alias("revenue_at_risk"),
            F.sum("total_profit").alias("total_profit"),
            C.mean(F.col("profit_margin")).alias("avg_profit_margin"),
        )
        .withColumn("month_label", C.month_label(F.col("month")))
        .withColumn("leakage_rate_pct", C.rate_pct(F.col("leakage_orders"), F.col("total_orders")))
        .select(*MONTHLY_COLUMNS)
    )


def seller_risk(sellers: DataFrame, items: DataFrame, scores: DataFrame) -> DataFrame:
    """Per seller: distinct orders, flagged orders, own revenue and mean score.

    Items collapse to one row per (order, seller) first; several items of one seller in an order
    must count as one order. Few of them do, so items that come placed by order are better not combined first: they
    meet their pairs and the scores where they are.
    """
    pairs = items.groupBy("order_id", "seller_id").agg(F.sum("price_after_discount").alias("revenue"))
    scored = pairs.join(scores.select("order_id", "anomaly_flag", "ensemble_score"), "order_id", "left")
    facts = scored.groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.count_if(F.col("anomaly_flag") == 1).alias("leakage_orders"),
        F.sum("revenue").cast("decimal(18,2)").alias("total_revenue"),
        C.mean(F.col("ensemble_score")).alias("avg_anomaly_score"),
    )
    return (
        sellers.join(facts, "seller_id")
        .withColumn("leakage_rate_pct", C.rate_pct(F.col("leakage_orders"), F.col("total_orders")))
        .select(*SELLER_RISK_COLUMNS)
    )


def leakage_by_scenario(junction: DataFrame, orders: DataFrame, scores: DataFrame) -> DataFrame:
    return (
        junction.select("order_id", F.col("leakage_type").alias("scenario"))
        .join(orders.select("order_id", "total_revenue", "profit_margin"), "order_id")
        .join(scores.select("order_id", "ensemble_score"), "order_id")
        .groupBy("scenario")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("total_revenue").alias("revenue_at_risk"),
            C.mean(F.col("ensemble_score")).alias("avg_anomaly_score"),
            C.mean(F.col("profit_margin")).alias("avg_profit_margin"),
        )
        .select(*SCENARIO_COLUMNS)
    )
