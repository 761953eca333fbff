"""Order-level facts: one row per order from items, payments, refunds, parcels and reviews.

Every many-per-order table is reduced to one row per order before it is joined. The reductions are
plain aggregates, so they combine before the shuffle and an order with very many rows costs no
single task; all joins then run on ``order_id``. Only first payments are placed by order first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.config import DEFAULT_PARAMS, RuleParams
from leakscope.functions import columns as C


def order_rollup(items: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """Revenue, logistics, freight, discount, profit and margin per order."""
    discount = F.round(F.sum("item_discount_pct") / F.count("item_discount_pct"), 3)
    sums = items.groupBy("order_id").agg(
        F.sum("price_after_discount").cast("decimal(14,2)").alias("total_revenue"),
        F.sum("logistics_cost").cast("decimal(14,2)").alias("total_logistics"),
        F.sum("freight_value").cast("decimal(14,2)").alias("total_freight"),
        F.count("*").cast("int").alias("item_count"),
        discount.cast("decimal(5,3)").alias("avg_discount_pct"),
    )
    return (
        sums.withColumn("total_profit", C.total_profit(F.col("total_revenue"), F.col("total_logistics"), params))
        .withColumn("profit_margin", C.profit_margin(F.col("total_profit"), F.col("total_revenue")))
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Primary payment (the first in sequence), paid total and double-pay flag per order.

    Structs have no place in a hash aggregate, so this one sorts what it is given, twice if it has to combine before a
    shuffle: payments that lie together by order are sorted once, in tasks of their own size.
    """
    first = F.min_by(F.struct("payment_type", "payment_value", "seller_paid_twice"), "pay_order")
    return payments.groupBy("order_id").agg(
        first.alias("primary"),
        F.sum("payment_value").cast("decimal(14,2)").alias("paid_total"),
        F.bool_or("seller_paid_twice").alias("any_paid_twice"),
    ).select(
        "order_id", "primary.payment_type", "primary.payment_value", "primary.seller_paid_twice",
        "paid_total", "any_paid_twice",
    )


def refund_summary(refunds: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """Refund facts per order: how many, which reasons, how many small ones."""
    return refunds.groupBy("order_id").agg(
        F.count("*").alias("refund_count"),
        (F.count("*") > 1).alias("duplicate_refund"),
        F.bool_or(F.col("refund_reason") == "incorrect_refund").alias("has_incorrect_refund"),
        F.bool_or(F.col("refund_reason") == "late_delivery_compensation").alias("has_late_compensation"),
        F.bool_or("processed_before_cancel").alias("refunded_before_cancel"),
        F.count_if(F.col("refund_amount") < C.dec(params.small_refund, 14, 2)).alias("small_refunds"),
        F.sum("refund_amount").cast("decimal(14,2)").alias("refunded_total"),
    )


def latest_review(reviews: DataFrame) -> DataFrame:
    """The newest review per order; the higher review id wins a tie."""
    newest = F.max_by(F.struct("rating", "sentiment", "review_comment"), F.struct("review_date", "review_id"))
    return reviews.groupBy("order_id").agg(newest.alias("r")).select(
        "order_id", "r.rating", "r.sentiment", "r.review_comment")


def review_signals(reviews: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """Facts the review rules look at, over all reviews of an order."""
    return reviews.groupBy("order_id").agg(
        F.bool_or("has_comment").alias("has_commented_review"),
        F.bool_or(F.col("sentiment") == "positive").alias("has_positive_review"),
        F.bool_or(F.coalesce(F.col("review_comment").rlike(params.not_received_pattern), F.lit(False)))
        .alias("says_not_received"),
    )


def shipping(headers: DataFrame, parcels: DataFrame, rollup: DataFrame,
             params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """One shipping row per order; an order without parcels was never shipped."""
    rows = headers.select("order_id", "carrier").join(parcels, "order_id", "left").join(
        rollup.select("order_id", "total_freight", "total_logistics"), "order_id", "left")
    status = (
        F.when(F.col("lines").isNull(), "never_shipped").when(F.col("open_lines") == 0, "delivered")
        .when(F.col("open_lines") < F.col("lines"), "in_transit").when(F.col("lines") == 1, "never_shipped")
        .when(F.col("lines") < 4, "pending").otherwise("failed")
    )
    cost = F.round(F.col("total_logistics") * C.dec("0.04"), 2).cast("decimal(12,2)")
    return (
        rows.select(
            "order_id", "carrier", "shipped_date", "delivered_date", status.alias("shipping_status"),
            F.col("total_freight").alias("shipping_fee_charged"), cost.alias("actual_logistics_cost"),
        )
        .withColumn("fee_to_cost_ratio",
                    C.fee_to_cost_ratio(F.col("shipping_fee_charged"), F.col("actual_logistics_cost")))
        .withColumn("fee_calculation_error",
                    F.coalesce(F.col("fee_to_cost_ratio") > C.dec(params.fee_ratio_error), F.lit(False)))
    )


def orders(headers: DataFrame, rollup: DataFrame, payments: DataFrame, parcels: DataFrame) -> DataFrame:
    """The orders fact table with its stored derived columns."""
    paid, billed = F.col("paid_total"), F.col("billed_total")
    status = (
        F.when(paid.isNull(), "missing").when(paid >= billed, "approved")
        .when(paid >= billed * C.dec("0.25"), "partial").otherwise("unpaid")
    )
    placed = F.col("order_purchase_timestamp")
    return (
        headers.join(rollup, "order_id", "left")
        .join(payments.select("order_id", "paid_total"), "order_id", "left")
        .join(parcels.select("order_id", F.col("delivered_date").alias("order_delivered_customer_date")),
              "order_id", "left")
        .select(
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_delivered_customer_date", "order_estimated_delivery_date",
            C.shipping_delay_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
            .alias("shipping_delay_days"),
            "invoice_available", "avg_discount_pct", "total_revenue", "total_logistics", "total_freight",
            "item_count", "total_profit", "profit_margin",
            F.coalesce(billed < F.col("total_revenue") * C.dec("0.25"), F.lit(False)).alias("inventory_mismatch"),
            status.alias("payment_status"),
            C.order_month(placed).alias("order_month"), C.order_quarter(placed).alias("order_quarter"),
            C.order_year(placed).alias("order_year"),
        )
    )


def customers(profiles: DataFrame, orders_df: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """Customers with lifetime value, order count, average order value and segment."""
    value = orders_df.groupBy("customer_id").agg(
        F.sum("total_revenue").cast("decimal(14,2)").alias("lifetime_value"),
        F.count("*").alias("total_orders"),
        F.round(F.try_divide(F.sum("total_revenue"), F.count("total_revenue")), 2).cast("decimal(14,2)")
        .alias("avg_order_value"),
    )
    return (
        profiles.join(value, "customer_id", "left")
        .withColumn("total_orders", F.coalesce("total_orders", F.lit(0).cast("bigint")))
        .withColumn("segment", C.segment(F.coalesce("lifetime_value", F.lit(0)), params))
    )
