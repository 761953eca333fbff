"""Declared schemas and closed value domains of the platform's tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Table layouts (Spark DDL), by schema-qualified name.
TABLE_DDL: dict[str, str] = {
    "ecommerce.customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
        "customer_name string, lifetime_value decimal(14,2), segment string, churn_risk string, "
        "total_orders int, avg_order_value decimal(14,2), is_verified boolean"
    ),
    "ecommerce.geolocation": (
        "id int, geolocation_zip_code_prefix int, geolocation_lat decimal(9,6), geolocation_lng decimal(9,6), "
        "geolocation_city string"
    ),
    "ecommerce.order_items": (
        "id int, order_id string, order_item_id smallint, product_id string, seller_id string, "
        "price decimal(12,2), freight_value decimal(10,2), item_discount_pct decimal(5,3), "
        "price_after_discount decimal(12,2), logistics_cost decimal(10,2)"
    ),
    "ecommerce.orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, "
        "shipping_delay_days smallint, invoice_available boolean, avg_discount_pct decimal(5,3), "
        "total_revenue decimal(14,2), total_logistics decimal(14,2), total_freight decimal(14,2), "
        "item_count smallint, total_profit decimal(14,2), profit_margin decimal(7,4), "
        "inventory_mismatch boolean, payment_status string, order_month date, order_quarter date, order_year int"
    ),
    "ecommerce.payments": (
        "id int, order_id string, payment_sequential smallint, payment_type string, payment_installments smallint, "
        "payment_value decimal(12,2), payment_status string, seller_paid_twice boolean"
    ),
    "ecommerce.products": (
        "product_id string, product_category_name string, product_name_length int, "
        "product_description_length int, product_photos_qty smallint, product_weight_g int, "
        "product_length_cm smallint, product_height_cm smallint, product_width_cm smallint, "
        "unit_price_egp decimal(12,2)"
    ),
    "ecommerce.refunds": (
        "refund_id string, order_id string, refund_amount decimal(12,2), refund_date timestamp, "
        "refund_reason string, refund_status string, duplicate_refund boolean, processed_before_cancel boolean"
    ),
    "ecommerce.reviews": (
        "review_id string, order_id string, customer_id string, rating decimal(3,1), review_comment string, "
        "review_date timestamp, sentiment string, is_emoji_only boolean, rating_group string, has_comment boolean"
    ),
    "ecommerce.sellers": (
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_name string, "
        "seller_rating decimal(3,1), total_orders int, return_rate decimal(5,3), payment_disputes int, "
        "is_verified boolean, dq_name_cleaned boolean, dq_city_cleaned boolean"
    ),
    "ecommerce.shipping": (
        "shipping_id string, order_id string, carrier string, tracking_number string, shipped_date timestamp, "
        "delivered_date timestamp, shipping_status string, shipping_fee_charged decimal(10,2), "
        "actual_logistics_cost decimal(10,2), freight_value decimal(10,2), fee_calculation_error boolean, "
        "fee_to_cost_ratio decimal(10,4)"
    ),
    "marketing.campaign_attribution": (
        "id int, order_id string, campaign_id string, attribution_type string"
    ),
    "marketing.customer_interactions": (
        "interaction_id string, customer_id string, campaign_id string, interaction_date timestamp, "
        "channel string, action_type string, device string"
    ),
    "marketing.leads_closed": (
        "mql_id string, seller_id string, sdr_id string, sr_id string, won_date date, business_segment string, "
        "lead_type string, lead_behaviour_profile string, has_company boolean, has_gtin boolean, "
        "average_stock string, business_type string, declared_product_catalog_size decimal(12,1), "
        "declared_monthly_revenue decimal(14,2)"
    ),
    "marketing.leads_qualified": (
        "mql_id string, first_contact_date date, landing_page_id string, origin string"
    ),
    "marketing.marketing_campaigns": (
        "campaign_id string, campaign_name string, channel string, campaign_type string, start_date date, "
        "end_date date, budget decimal(14,2)"
    ),
    "marketing.website_sessions": (
        "session_id string, customer_id string, session_start timestamp, session_end timestamp, "
        "traffic_source string, landing_page string, bounce boolean, session_duration_min decimal(8,2)"
    ),
    "ml_output.order_anomaly_scores": (
        "order_id string, if_score decimal(8,6), lof_score decimal(8,6), ensemble_score decimal(8,6), "
        "anomaly_flag smallint, risk_tier string, anomaly_rank decimal(6,5), leakage_scenarios array<string>, "
        "leakage_reason string, scored_at timestamp, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp, total_revenue decimal(14,2), profit_margin decimal(7,4), "
        "avg_discount_pct decimal(5,3), shipping_delay_days smallint, payment_status string, "
        "shipping_status string, month string"
    ),
    "ml_output.order_leakage_reasons": (
        "order_id string, leakage_type string, confidence decimal(5,4)"
    ),
    "ml_output.chatbot_conversations": (
        "id bigint, session_id string, turn_index int, role string, content string, tool_calls string, "
        "tool_results string, created_at timestamp"
    ),
    "ml_output.chatbot_query_log": (
        "id bigint, session_id string, turn_id bigint, user_question string, detected_intent string, "
        "generated_sql string, tables_used array<string>, execution_ms int, row_count int, was_helpful boolean, "
        "error_message string, llm_model string, input_tokens int, output_tokens int, cost_usd decimal(10,6), "
        "created_at timestamp"
    ),
    "ml_output.chatbot_prompt_versions": (
        "version_id int, version_tag string, system_prompt string, schema_context string, "
        "change_description string, auc_score decimal(6,4), avg_f1 decimal(6,4), created_at timestamp, "
        "is_active boolean"
    ),
    "ml_output.chatbot_enums": "enum_name string, enum_value string, description string",
    "ml_output.schema_metadata": (
        "table_schema string, table_name string, description string, row_count_approx bigint, "
        "key_columns string, join_hint string, chatbot_use_case string"
    ),
    "rag.documents": (
        "doc_id bigint, source_type string, source_id string, title string, content string, content_lang string, "
        "metadata string, embedding_type string, priority smallint, retrieval_weight decimal(4,2), version int, "
        "is_active boolean, needs_reembedding boolean, created_at timestamp, updated_at timestamp, "
        "content_tsv array<string>"
    ),
    "rag.embeddings": "doc_id bigint, embedding array<float>, created_at timestamp, embedding_type string",
    "rag.document_versions": (
        "doc_id bigint, version int, content string, metadata string, changed_at timestamp, changed_by string"
    ),
    "rag.retrieval_log": (
        "log_id bigint, query_text string, query_intent string, retrieved_doc_ids array<bigint>, "
        "generated_sql string, sql_valid boolean, sql_executed boolean, execution_error string, "
        "hallucination_flag boolean, confidence_score decimal(4,3), latency_ms int, created_at timestamp"
    ),
    "rag.retrieval_cache": (
        "cache_key string, query_hash string, result_json string, hit_count int, expires_at timestamp, "
        "created_at timestamp"
    ),
    "rag.sql_guard": "guard_id int, guard_type string, pattern string, message string, guard_mode string",
}

# The order in which the score export lists its 18 columns.
SCORES_CSV_COLUMNS: tuple[str, ...] = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "total_revenue", "profit_margin",
    "avg_discount_pct", "shipping_delay_days", "payment_status", "shipping_status", "if_score", "lof_score",
    "ensemble_score", "anomaly_flag", "risk_tier", "anomaly_rank", "leakage_reason", "month",
)

# Closed domains, in declared order.
ENUMS: dict[str, tuple[str, ...]] = {
    "order_status": ("delivered", "canceled", "shipped", "processing", "invoiced", "unavailable"),
    "payment_status": ("approved", "partial", "unpaid", "missing"),
    "payment_type": ("credit_card", "debit_card", "voucher", "cash_on_delivery", "unknown"),
    "shipping_status": ("delivered", "in_transit", "cancelled", "failed", "never_shipped", "pending"),
    "refund_reason": ("incorrect_refund", "return_request", "early_refund", "late_delivery_compensation",
                      "item_not_as_described", "customer_request"),
    "sentiment": ("positive", "neutral", "negative", "mixed", "unknown"),
    "content_lang": ("ar", "en", "ar+en", "de", "es", "fr"),
    "risk_tier": ("Low", "Medium", "High", "Critical"),
    "segment": ("Low Value", "Mid Value", "High Value"),
    "churn_risk": ("High", "Medium", "Low"),
    "chat_role": ("system", "user", "assistant", "tool"),
    "leakage_scenario": (
        "delivered_no_payment", "shipped_then_cancelled", "incorrect_refund_on_delivery", "duplicate_refund",
        "payment_approved_never_shipped", "logistics_exceeds_revenue", "returned_product_kept",
        "cod_unpaid_after_delivery", "fake_delivery_success", "high_discount_negative_profit",
        "no_invoice_on_completion", "partial_payment_only", "refund_before_cancellation", "inventory_mismatch",
        "seller_paid_twice", "shipping_failed_review_exists", "review_contradicts_cancelled",
        "wrong_shipping_fee", "repeated_small_refunds", "delayed_delivery_compensation", "no_leakage",
        "statistical_outlier", "negative_profit_margin"),
    "embedding_type": ("schema", "business_rule", "sql_template", "review", "metric", "routing", "glossary",
                       "lineage"),
    "query_intent": ("simple_lookup", "aggregation", "anomaly_investigation", "trend_analysis",
                     "sentiment_analysis", "schema_discovery", "kpi_definition", "sql_generation"),
    "rag_source": ("schema_doc", "business_rule", "leakage_scenario", "sql_template", "review", "leakage_reason",
                   "kpi_glossary", "join_graph", "anti_pattern", "routing_hint", "enum_reference",
                   "generated_column", "metric_definition", "lineage_doc", "anomaly_interpretation",
                   "summary_profile", "temporal_context"),
}

# Column lists of the four published views, in their published order.
DASHBOARD_COLUMNS: tuple[str, ...] = (
    "order_id", "customer_id", "customer_name", "customer_city", "customer_segment", "order_status",
    "order_purchase_timestamp", "order_month", "order_quarter", "order_year", "total_revenue", "total_profit",
    "profit_margin", "avg_discount_pct", "shipping_delay_days", "invoice_available", "inventory_mismatch",
    "payment_status", "payment_type", "payment_value", "seller_paid_twice", "shipping_status",
    "shipping_fee_charged", "actual_logistics_cost", "fee_calculation_error", "fee_to_cost_ratio", "carrier",
    "rating", "sentiment", "review_comment", "ensemble_score", "anomaly_flag", "risk_tier",
    "leakage_scenarios", "leakage_reason",
)
MONTHLY_COLUMNS: tuple[str, ...] = (
    "month", "month_label", "total_orders", "leakage_orders", "leakage_rate_pct", "total_revenue",
    "revenue_at_risk", "total_profit", "avg_profit_margin",
)
SELLER_RISK_COLUMNS: tuple[str, ...] = (
    "seller_id", "seller_name", "seller_city", "seller_rating", "return_rate", "payment_disputes",
    "total_orders", "leakage_orders", "leakage_rate_pct", "total_revenue", "avg_anomaly_score",
)
SCENARIO_COLUMNS: tuple[str, ...] = (
    "scenario", "total_orders", "revenue_at_risk", "avg_anomaly_score", "avg_profit_margin",
)


def table_schema(name: str) -> T.StructType:
    """Declared schema of a table such as ``ecommerce.orders``."""
    return T.StructType.fromDDL(TABLE_DDL[name])


def scores_csv_schema() -> T.StructType:
    """Schema of the 18-column score export, in file order."""
    full = table_schema("ml_output.order_anomaly_scores")
    return T.StructType([full[c] for c in SCORES_CSV_COLUMNS])
