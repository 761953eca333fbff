"""The named analytic queries over the published views and base tables.

Each top-k is ``orderBy().limit()``, which every task answers with its own best rows first; the key
is the last sort column so that ties come out the same every time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.config import DEFAULT_PARAMS, RuleParams
from leakscope.functions import columns as C

RATE_HIGH_PCT = 30.0
RETURN_RATE_HIGH = "0.15"
SCORE_HIGH = "0.65"


def leakage_overview(dash: DataFrame) -> DataFrame:
    return dash.filter("anomaly_flag = 1").agg(
        F.count("*").alias("leakage_orders"),
        F.sum("total_revenue").alias("total_revenue_at_risk"),
        C.mean(F.col("profit_margin")).alias("avg_profit_margin"),
        F.count_if(F.col("risk_tier") == "Critical").alias("critical_count"),
    )


def top_scenarios(by_scenario: DataFrame, k: int = 10) -> DataFrame:
    return by_scenario.orderBy(F.desc("revenue_at_risk"), "scenario").limit(k)


def worst_month(monthly: DataFrame) -> DataFrame:
    return monthly.select("month_label", "leakage_rate_pct", "revenue_at_risk", "leakage_orders", "month").orderBy(
        F.desc("leakage_rate_pct"), "month").limit(1).drop("month")


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("month").select("month_label", "leakage_rate_pct", "revenue_at_risk", "total_orders")


def last_months(monthly: DataFrame, k: int = 12) -> DataFrame:
    return monthly.orderBy(F.desc("month")).limit(k).select(
        "month_label", "total_orders", "leakage_orders",
        F.round("leakage_rate_pct", 2).alias("leakage_rate_pct"), "total_revenue", "revenue_at_risk")


def riskiest_sellers(sellers: DataFrame, k: int = 10) -> DataFrame:
    return sellers.orderBy(F.desc("leakage_rate_pct"), "seller_id").limit(k).select(
        "seller_name", "leakage_rate_pct", "total_orders", "avg_anomaly_score", "payment_disputes")


def seller_leaderboard(sellers: DataFrame, min_orders: int = 100, k: int = 10) -> DataFrame:
    return sellers.filter(F.col("total_orders") > min_orders).orderBy(
        F.desc("leakage_rate_pct"), "seller_id").limit(k).select(
        "seller_name", "seller_city", "leakage_rate_pct", "total_orders", "leakage_orders", "avg_anomaly_score",
        "payment_disputes", "return_rate")


def negative_margin_orders(dash: DataFrame, k: int = 20) -> DataFrame:
    return dash.filter("profit_margin < 0").orderBy("profit_margin", "order_id").limit(k).select(
        "order_id", "profit_margin", "total_revenue", "avg_discount_pct", "risk_tier")


def loss_levels(dash: DataFrame) -> DataFrame:
    margin = F.col("profit_margin")
    level = (F.when(margin < C.dec("-0.5"), "severe").when(margin < C.dec("-0.2"), "high").otherwise("moderate"))
    return dash.filter("profit_margin < 0").groupBy(level.alias("loss_level")).agg(
        F.count("*").alias("orders"), F.sum("total_revenue").alias("revenue_lost")).orderBy(F.desc("revenue_lost"))


def critical_orders(dash: DataFrame, k: int = 50) -> DataFrame:
    return dash.filter("risk_tier = 'Critical'").orderBy(F.desc("ensemble_score"), "order_id").limit(k).select(
        "order_id", "total_revenue", "profit_margin", "ensemble_score", "leakage_scenarios", "order_status",
        "payment_status")


def tier_totals(dash: DataFrame) -> DataFrame:
    return dash.filter("anomaly_flag = 1").groupBy("risk_tier").agg(
        F.count("*").alias("orders"), F.sum("total_revenue").alias("revenue")).orderBy(F.desc("revenue"))


def scenario_orders_by_array(dash: DataFrame, scenario: str, k: int | None = 20) -> DataFrame:
    hits = dash.filter(F.array_contains("leakage_scenarios", scenario)).select(
        "order_id", "total_revenue", "risk_tier", "ensemble_score").orderBy(F.desc("ensemble_score"), "order_id")
    return hits if k is None else hits.limit(k)


def scenario_orders_by_junction(reasons: DataFrame, orders: DataFrame, scenario: str) -> DataFrame:
    return reasons.filter(F.col("leakage_type") == scenario).select("order_id").join(
        orders.select("order_id", "total_revenue", "order_status"), "order_id").orderBy(
        F.desc("total_revenue"), "order_id")


def recent_critical(dash: DataFrame, as_of: dt.date, months: int = 3, k: int = 20) -> DataFrame:
    """Critical flagged orders since the start of the month ``months`` ago; prunes month partitions."""
    since = F.trunc(F.add_months(F.lit(as_of), -months), "month")
    return dash.filter(
        (F.col("anomaly_flag") == 1) & (F.col("risk_tier") == "Critical") & (F.col("order_month") >= since)
    ).orderBy(F.desc("ensemble_score"), "order_id").limit(k).select(
        "order_id", "customer_name", "customer_city", "total_revenue", "profit_margin", "risk_tier",
        "ensemble_score", "leakage_scenarios", "payment_status", "shipping_status")


def delivered_without_payment(dash: DataFrame) -> DataFrame:
    return dash.filter("order_status = 'delivered' AND payment_status = 'missing'").select(
        "order_id", "total_revenue", "customer_segment", "customer_city")


def incorrect_refunds(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    wrong = refunds.filter("refund_reason = 'incorrect_refund'").select("order_id", "refund_amount")
    return wrong.join(orders.filter("order_status = 'delivered'").select("order_id", "total_revenue"), "order_id")


def approved_never_shipped(orders: DataFrame, shipping: DataFrame) -> DataFrame:
    parcels = shipping.filter("shipping_status = 'never_shipped'").select("order_id", "carrier")
    return orders.filter("payment_status = 'approved'").select("order_id", "total_revenue").join(parcels, "order_id")


def cod_unpaid(orders: DataFrame, primary_payments: DataFrame) -> DataFrame:
    cash = primary_payments.filter("payment_type = 'cash_on_delivery'").select("order_id")
    unpaid = orders.filter("order_status = 'delivered'").filter(F.col("payment_status").isin("unpaid", "missing"))
    return unpaid.select("order_id", "total_revenue", "customer_id").join(cash, "order_id")


def discounted_losses(dash: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    return dash.filter((F.col("avg_discount_pct") > C.dec(params.high_discount)) & (F.col("profit_margin") < 0)).select(
        "order_id", "avg_discount_pct", "profit_margin", "total_revenue")


def churning_customers(customers: DataFrame) -> DataFrame:
    return customers.filter("churn_risk = 'High'").select("customer_id", "lifetime_value", "churn_risk").orderBy(
        F.desc_nulls_last("lifetime_value"), "customer_id")


def valuable_customers_leaking(customers: DataFrame, dash: DataFrame) -> DataFrame:
    at_risk = customers.filter("segment = 'High Value' AND churn_risk = 'High'").select(
        "customer_id", "lifetime_value", "churn_risk")
    # counted per customer before the join, so a customer with very many orders meets it as one row
    leaks = dash.filter("anomaly_flag = 1").groupBy("customer_id").agg(F.count("order_id").alias("leakage_orders"))
    return at_risk.join(leaks, "customer_id").orderBy(F.desc("lifetime_value"), "customer_id")


def high_risk_sellers(sellers: DataFrame, scored: bool = False) -> DataFrame:
    """Sellers with high leakage and return rates; ``scored`` asks for a high mean anomaly score as well."""
    risky = (F.col("leakage_rate_pct") > RATE_HIGH_PCT) & (F.col("return_rate") > C.dec(RETURN_RATE_HIGH))
    if scored:
        risky = risky & (F.col("avg_anomaly_score") > C.dec(SCORE_HIGH))
    return sellers.filter(risky).orderBy(F.desc("avg_anomaly_score"), "seller_id")


def fee_outliers(shipping: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    fee = F.col("fee_to_cost_ratio")
    return shipping.filter((fee > C.dec(params.fee_ratio_high)) | (fee < C.dec(params.fee_ratio_low))).select(
        "order_id", "shipping_fee_charged", "actual_logistics_cost", "fee_to_cost_ratio")


def revenue_by(orders: DataFrame, period: str) -> DataFrame:
    return orders.groupBy(period).agg(
        F.sum("total_revenue").alias("revenue"), F.count("*").alias("orders")).orderBy(period)


def revenue_at_risk_from_source(orders: DataFrame, scores: DataFrame) -> DataFrame:
    flagged = scores.filter("anomaly_flag = 1").select("order_id")
    return orders.select("order_id", "total_revenue").join(flagged, "order_id").agg(
        F.sum("total_revenue").alias("total_revenue_at_risk"))


def scenario_reason_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("leakage_scenarios", "leakage_reason").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "leakage_reason")


def risk_share(dash: DataFrame) -> DataFrame:
    at_risk = F.sum(F.when(F.col("anomaly_flag") == 1, F.col("total_revenue"))).cast("double")
    return dash.agg(C.rate_pct(at_risk, F.sum("total_revenue").cast("double")).alias("revenue_at_risk_pct"))


def payment_breakdown(primary_payments: DataFrame) -> DataFrame:
    return primary_payments.groupBy("payment_type").agg(
        F.count("*").alias("orders"), F.sum("payment_value").alias("paid"),
        F.count_if("seller_paid_twice").alias("paid_twice"))


def carrier_performance(shipping: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    def status(value: str) -> Column:
        return F.count_if(F.col("shipping_status") == value)

    return shipping.groupBy("carrier").agg(
        F.count("*").alias("parcels"), status("delivered").alias("delivered"), status("failed").alias("failed"),
        status("never_shipped").alias("never_shipped"),
        F.count_if(F.col("fee_to_cost_ratio") > C.dec(params.fee_ratio_high)).alias("overcharged"),
        C.mean(F.col("fee_to_cost_ratio")).alias("avg_fee_to_cost"),
    )


def segment_city_risk(dash: DataFrame) -> DataFrame:
    return dash.groupBy("customer_segment", "customer_city", "risk_tier").agg(
        F.count("*").alias("orders"), F.sum("total_revenue").alias("revenue"))


def sentiment_counts(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("sentiment").agg(
        F.count("*").alias("reviews"), F.count_if(F.col("rating") <= 2).alias("low_ratings"))


def product_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    per_product = items.groupBy("product_id").agg(
        F.sum("price_after_discount").alias("revenue"), F.count("*").alias("lines"),
        F.sum("item_discount_pct").alias("discounts"))
    return per_product.join(products.select("product_id", "product_category_name"), "product_id").groupBy(
        "product_category_name").agg(
        F.sum("revenue").alias("revenue"), F.sum("lines").alias("items_sold"),
        F.try_divide(F.sum("discounts").cast("double"), F.sum("lines")).alias("avg_discount"))


def session_cost(log: DataFrame) -> DataFrame:
    """Token cost per chat session."""
    cost = C.token_cost_usd(F.col("input_tokens"), F.col("output_tokens"))
    return log.groupBy("session_id").agg(F.sum(cost).alias("cost_usd"), F.count("*").alias("questions"))


def campaign_results(attribution: DataFrame, campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders and revenue per campaign; an order counts fully for each campaign it is attributed to."""
    per_campaign = attribution.join(orders.select("order_id", "total_revenue"), "order_id").groupBy("campaign_id").agg(
        F.count("*").alias("orders"), F.sum("total_revenue").alias("revenue"))
    return campaigns.join(per_campaign, "campaign_id", "left").select(
        "campaign_id", "channel", "budget", F.coalesce("orders", F.lit(0)).alias("orders"), "revenue")


def lead_funnel(qualified: DataFrame, closed: DataFrame, sellers: DataFrame) -> DataFrame:
    won = closed.join(sellers.select("seller_id", "seller_rating"), "seller_id").select("mql_id", "seller_rating")
    return qualified.join(won, "mql_id", "left").groupBy("origin").agg(
        F.count("*").alias("leads"), F.count("seller_rating").alias("won"),
        C.rate_pct(F.count("seller_rating"), F.count("*")).alias("win_rate_pct"))


def places_per_zip(geolocation: DataFrame) -> DataFrame:
    """One row per zip, so that joining customers or sellers to it keeps their row count."""
    return geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.count("*").alias("points"), F.min("geolocation_city").alias("city"),
        C.mean(F.col("geolocation_lat")).alias("lat"), C.mean(F.col("geolocation_lng")).alias("lng"))


def sessions_by_source(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("traffic_source").agg(
        F.count("*").alias("sessions"),
        C.rate_pct(F.count_if("bounce"), F.count("*")).alias("bounce_rate_pct"),
        C.mean(F.col("session_duration_min")).alias("avg_minutes"))


def chat_quality(log: DataFrame) -> DataFrame:
    """Volume, errors, helpfulness and cost of chat questions per intent."""
    cost = C.token_cost_usd(F.col("input_tokens"), F.col("output_tokens"))
    return log.groupBy("detected_intent").agg(
        F.count("*").alias("questions"),
        C.rate_pct(F.count("error_message"), F.count("*")).alias("error_rate_pct"),
        C.rate_pct(F.count_if("was_helpful"), F.count("*")).alias("helpful_rate_pct"),
        F.sum(cost).alias("cost_usd"))


def retrieval_quality(log: DataFrame) -> DataFrame:
    """Error and hallucination rates and latency of retrieval per intent."""
    return log.groupBy("query_intent").agg(
        F.count("*").alias("queries"),
        C.rate_pct(F.count("execution_error"), F.count("*")).alias("error_rate_pct"),
        C.rate_pct(F.count_if("hallucination_flag"), F.count("*")).alias("hallucination_rate_pct"),
        C.mean(F.col("latency_ms")).alias("avg_latency_ms"),
        F.percentile("latency_ms", 0.5).alias("p50_latency_ms"),
        F.percentile("latency_ms", 0.95).alias("p95_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"))


# ---- corpus statistics ---------------------------------------------------------------------------


def corpus_stats(documents: DataFrame) -> DataFrame:
    """Counts and exact averages to the published precision (half up)."""
    def average(col: str, kind: str, scale: int) -> Column:
        return F.round(F.sum(col).cast("decimal(20,2)") / F.count(col), scale).cast(kind)

    return documents.groupBy("source_type").agg(
        F.count("*").alias("doc_count"),
        average("priority", "decimal(4,1)", 1).alias("avg_priority"),
        average("retrieval_weight", "decimal(4,2)", 2).alias("avg_weight"),
        F.count_if(F.col("priority") >= 9).alias("high_priority_count"))


def scenario_documents(documents: DataFrame) -> DataFrame:
    return documents.filter("source_type = 'leakage_scenario'").select(
        F.col("source_id").alias("scenario"),
        F.get_json_object("metadata", "$.detection_columns").alias("detection_cols"),
        F.get_json_object("metadata", "$.preferred_view").alias("preferred_view"), "priority")


def top_documents(documents: DataFrame, k: int = 20) -> DataFrame:
    return documents.orderBy(F.desc("retrieval_weight"), F.desc("priority"), "doc_id").limit(k).select(
        "doc_id", "source_type", "title", "priority", "retrieval_weight")


def pending_embedding(documents: DataFrame) -> DataFrame:
    """Active documents waiting for a vector, most urgent first."""
    return documents.filter(F.col("needs_reembedding") & F.col("is_active")).select(
        "doc_id", "source_type", "embedding_type", "title", "updated_at", "priority").orderBy(
        F.desc("priority"), F.desc("updated_at"), "doc_id")


def pending_counts(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("needs_reembedding") & F.col("is_active")).groupBy("source_type").agg(
        F.count("*").alias("pending"))


def embedding_coverage(documents: DataFrame, embeddings: DataFrame) -> DataFrame:
    has = embeddings.select("doc_id", F.lit(1).alias("has_vector"))
    return documents.select("doc_id", "embedding_type").join(has, "doc_id", "left").groupBy("embedding_type").agg(
        F.count("*").alias("documents"), F.count("has_vector").alias("embedded"))
