"""Platform tables as DuckDB expressions, written apart from the Spark jobs they check.

``statement(body)`` puts only the table expressions a body needs in front of it.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

CTES["items"] = """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       l_extendedprice::DECIMAL(12,2) AS price,
       round(l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(5,3), 2)::DECIMAL(10,2) AS freight_value,
       l_discount::DECIMAL(5,3) AS item_discount_pct,
       round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(5,3)), 2)::DECIMAL(12,2) AS price_after_discount,
       round(l_quantity::DECIMAL(6,2) * p_retailprice::DECIMAL(10,2), 2)::DECIMAL(12,2) AS logistics_cost,
       l_returnflag AS return_flag
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

CTES["pays"] = """
SELECT l_orderkey AS order_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS payment_sequential,
       CASE WHEN l_tax < 0.015 THEN 'credit_card' WHEN l_tax < 0.035 THEN 'debit_card' WHEN l_tax < 0.055 THEN 'voucher'
            WHEN l_tax < 0.075 THEN 'cash_on_delivery' ELSE 'unknown' END AS payment_type,
       round(round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(5,3)), 2)::DECIMAL(12,2)
             * (1 + l_tax::DECIMAL(5,3)), 2)::DECIMAL(12,2) AS payment_value,
       (l_discount >= 0.095 AND l_linestatus = 'F') AS seller_paid_twice,
       l_suppkey AS seller_id
FROM lineitem
"""

CTES["paysum"] = """
SELECT order_id, sum(payment_value) AS paid_total, bool_or(seller_paid_twice) AS any_paid_twice
FROM pays GROUP BY order_id
"""

CTES["primpay"] = """
SELECT order_id, payment_type, payment_value, seller_paid_twice FROM pays WHERE payment_sequential = 1
"""

CTES["refunds"] = """
SELECT l_orderkey AS order_id,
       round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(5,3)), 2)::DECIMAL(12,2) AS refund_amount,
       l_shipdate AS refund_date,
       CASE WHEN l_quantity < 8 THEN 'incorrect_refund' WHEN l_quantity < 16 THEN 'return_request'
            WHEN l_quantity < 24 THEN 'early_refund' WHEN l_quantity < 32 THEN 'late_delivery_compensation'
            WHEN l_quantity < 40 THEN 'item_not_as_described' ELSE 'customer_request' END AS refund_reason,
       l_linestatus = 'F' AS processed_before_cancel
FROM lineitem WHERE l_returnflag = 'R'
"""

CTES["headers"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
            WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN 'canceled' ELSE 'processing' END AS order_status,
       o_orderdate AS order_purchase_timestamp, o_orderpriority <> '1-URGENT' AS invoice_available,
       o_totalprice::DECIMAL(14,2) AS billed_total,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Aramex EG' WHEN '2-HIGH' THEN 'Bosta' WHEN '3-MEDIUM' THEN 'Mylerz'
            WHEN '4-NOT SPECIFIED' THEN 'Egypt Post' WHEN '5-LOW' THEN 'Voo' END AS carrier
FROM orders
"""

CTES["parcels"] = """
SELECT l_orderkey AS order_id, min(l_shipdate) AS shipped_date, max(l_shipdate) AS delivered_date, count(*) AS n_lines,
       count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines
FROM lineitem GROUP BY 1
"""

CTES["rollup"] = """
SELECT *, (sign(total_profit) * ((2 * (abs(total_profit) * 100)::HUGEINT * 10000 + (total_revenue * 100)::HUGEINT)
            // nullif(2 * (total_revenue * 100)::HUGEINT, 0))::DECIMAL(18,0) * 0.0001)::DECIMAL(7,4) AS profit_margin
FROM (
  SELECT *, round(total_revenue - total_logistics - 0.15 * total_revenue, 2)::DECIMAL(14,2) AS total_profit
  FROM (
    SELECT order_id, sum(price_after_discount)::DECIMAL(14,2) AS total_revenue,
           sum(logistics_cost)::DECIMAL(14,2) AS total_logistics, sum(freight_value)::DECIMAL(14,2) AS total_freight,
           count(*)::INTEGER AS item_count,
           (((2 * (sum(item_discount_pct) * 1000)::BIGINT + count(*)) // (2 * count(*)))::DECIMAL(9,0) * 0.001)
             ::DECIMAL(5,3) AS avg_discount_pct
    FROM items GROUP BY order_id))
"""

CTES["ords"] = """
SELECT h.order_id, h.customer_id, h.order_status, h.order_purchase_timestamp,
       date_diff('day', h.order_purchase_timestamp::DATE, p.delivered_date::DATE) AS shipping_delay_days,
       h.invoice_available, r.avg_discount_pct, r.total_revenue, r.total_logistics, r.total_freight, r.item_count,
       r.total_profit, r.profit_margin,
       coalesce(h.billed_total < r.total_revenue * 0.25, false) AS inventory_mismatch,
       CASE WHEN s.paid_total IS NULL THEN 'missing' WHEN s.paid_total >= h.billed_total THEN 'approved'
            WHEN s.paid_total >= h.billed_total * 0.25 THEN 'partial' ELSE 'unpaid' END AS payment_status,
       date_trunc('month', h.order_purchase_timestamp + INTERVAL 2 HOUR)::DATE AS order_month,
       date_trunc('quarter', h.order_purchase_timestamp + INTERVAL 2 HOUR)::DATE AS order_quarter,
       year(h.order_purchase_timestamp + INTERVAL 2 HOUR) AS order_year
FROM headers h LEFT JOIN rollup r USING (order_id) LEFT JOIN paysum s USING (order_id)
     LEFT JOIN parcels p USING (order_id)
"""

CTES["ship"] = """
SELECT *, coalesce(fee_to_cost_ratio > 2.5, false) AS fee_calculation_error
FROM (
  SELECT *, (((2 * (shipping_fee_charged * 100)::HUGEINT * 10000 + (actual_logistics_cost * 100)::HUGEINT)
             // nullif(2 * (actual_logistics_cost * 100)::HUGEINT, 0))::DECIMAL(18,0) * 0.0001)::DECIMAL(10,4)
           AS fee_to_cost_ratio
  FROM (
    SELECT h.order_id, h.carrier, p.shipped_date, p.delivered_date,
           CASE WHEN p.n_lines IS NULL THEN 'never_shipped' WHEN p.open_lines = 0 THEN 'delivered'
                WHEN p.open_lines < p.n_lines THEN 'in_transit' WHEN p.n_lines = 1 THEN 'never_shipped'
                WHEN p.n_lines < 4 THEN 'pending' ELSE 'failed' END AS shipping_status,
           r.total_freight AS shipping_fee_charged,
           round(r.total_logistics * 0.04, 2)::DECIMAL(12,2) AS actual_logistics_cost
    FROM headers h LEFT JOIN parcels p USING (order_id) LEFT JOIN rollup r USING (order_id)))
"""

CTES["revs"] = """
SELECT review_id, order_id, review_comment, sentiment,
       CASE sentiment WHEN 'positive' THEN 5.0 WHEN 'neutral' THEN 3.0 WHEN 'negative' THEN 1.0 END::DECIMAL(3,1) AS rating,
       TIMESTAMP '2001-01-01 00:00:00' + to_minutes(length(review_comment)) AS review_date,
       NOT regexp_matches(review_comment, '\\p{L}') AS is_emoji_only, sentiment AS rating_group,
       length(trim(review_comment)) > 0 AS has_comment
FROM (
  SELECT 'D' || d.doc_id AS review_id, d.doc_id AS order_id, d.text AS review_comment,
         CASE l.quality WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'unknown' END AS sentiment
  FROM documents d LEFT JOIN labels l USING (doc_id)
  UNION ALL
  SELECT 'C' || conv_id || '-' || turn, conv_id, text, 'neutral' FROM conversations WHERE role = 'user')
"""

CTES["lastrev"] = """
SELECT order_id, rating, sentiment, review_comment
FROM revs QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_date DESC, review_id DESC) = 1
"""

CTES["custs"] = """
SELECT *, CASE WHEN coalesce(lifetime_value, 0) > 2000000 THEN 'High Value'
               WHEN coalesce(lifetime_value, 0) > 1000000 THEN 'Mid Value' ELSE 'Low Value' END AS segment
FROM (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS customer_zip_code_prefix,
         n_name AS customer_city,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'High' WHEN 'MACHINERY' THEN 'High' WHEN 'FURNITURE' THEN 'Medium'
              ELSE 'Low' END AS churn_risk,
         v.lifetime_value, coalesce(v.total_orders, 0) AS total_orders, v.avg_order_value
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (
    SELECT customer_id, sum(total_revenue)::DECIMAL(14,2) AS lifetime_value, count(*) AS total_orders,
           (((2 * (sum(total_revenue) * 100)::BIGINT + count(total_revenue)) // nullif(2 * count(total_revenue), 0))
             ::DECIMAL(18,0) * 0.01)::DECIMAL(14,2) AS avg_order_value
    FROM ords GROUP BY 1) v ON v.customer_id = c_custkey)
"""

CTES["sells"] = """
SELECT s_suppkey AS seller_id, s_name AS seller_name, n_name AS seller_city, s_nationkey AS seller_zip_code_prefix,
       least(5, greatest(1, floor(s_acctbal / 2000)))::DECIMAL(3,1) AS seller_rating, r.return_rate, d.payment_disputes
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN (SELECT seller_id, round(count(*) FILTER (WHERE return_flag = 'R') / count(*), 3)::DECIMAL(5,3) AS return_rate
           FROM items GROUP BY 1) r ON r.seller_id = s_suppkey
LEFT JOIN (SELECT seller_id, count(*) FILTER (WHERE seller_paid_twice)::INTEGER AS payment_disputes
           FROM pays GROUP BY 1) d ON d.seller_id = s_suppkey
"""

CTES["rules_in"] = """
SELECT o.*, pp.payment_type, ps.any_paid_twice, s.shipping_status, s.fee_calculation_error, s.fee_to_cost_ratio
FROM ords o LEFT JOIN primpay pp USING (order_id) LEFT JOIN paysum ps USING (order_id) LEFT JOIN ship s USING (order_id)
"""

# (order, scenario) pairs of the business rules, each rule stated on its own
CTES["rule_hits"] = """
SELECT order_id, 'delivered_no_payment' AS scenario FROM rules_in WHERE order_status = 'delivered' AND payment_status = 'missing'
UNION ALL SELECT order_id, 'shipped_then_cancelled' FROM rules_in
  WHERE shipping_status IN ('delivered', 'in_transit') AND order_status = 'canceled'
UNION ALL SELECT order_id, 'incorrect_refund_on_delivery' FROM rules_in WHERE order_status = 'delivered'
  AND order_id IN (SELECT order_id FROM refunds WHERE refund_reason = 'incorrect_refund')
UNION ALL SELECT order_id, 'duplicate_refund' FROM rules_in
  WHERE order_id IN (SELECT order_id FROM refunds GROUP BY order_id HAVING count(*) > 1)
UNION ALL SELECT order_id, 'payment_approved_never_shipped' FROM rules_in
  WHERE payment_status = 'approved' AND shipping_status = 'never_shipped'
UNION ALL SELECT order_id, 'logistics_exceeds_revenue' FROM rules_in WHERE total_logistics > total_revenue
UNION ALL SELECT order_id, 'cod_unpaid_after_delivery' FROM rules_in
  WHERE payment_type = 'cash_on_delivery' AND order_status = 'delivered' AND payment_status IN ('unpaid', 'missing')
UNION ALL SELECT order_id, 'high_discount_negative_profit' FROM rules_in WHERE avg_discount_pct > 0.07 AND profit_margin < 0
UNION ALL SELECT order_id, 'no_invoice_on_completion' FROM rules_in WHERE order_status = 'delivered' AND NOT invoice_available
UNION ALL SELECT order_id, 'partial_payment_only' FROM rules_in WHERE payment_status = 'partial'
UNION ALL SELECT order_id, 'refund_before_cancellation' FROM rules_in WHERE order_status = 'canceled'
  AND order_id IN (SELECT order_id FROM refunds WHERE processed_before_cancel)
UNION ALL SELECT order_id, 'inventory_mismatch' FROM rules_in WHERE inventory_mismatch
UNION ALL SELECT order_id, 'seller_paid_twice' FROM rules_in WHERE any_paid_twice
UNION ALL SELECT order_id, 'wrong_shipping_fee' FROM rules_in WHERE fee_to_cost_ratio > 2.5
UNION ALL SELECT order_id, 'review_contradicts_cancelled' FROM rules_in WHERE order_status = 'canceled'
  AND order_id IN (SELECT order_id FROM revs WHERE has_comment)
UNION ALL SELECT order_id, 'delayed_delivery_compensation' FROM rules_in WHERE shipping_delay_days > 1383
  AND order_id IN (SELECT order_id FROM refunds WHERE refund_reason = 'late_delivery_compensation')
UNION ALL SELECT order_id, 'shipping_failed_review_exists' FROM rules_in WHERE shipping_status = 'failed'
  AND order_id IN (SELECT order_id FROM revs WHERE sentiment = 'positive')
UNION ALL SELECT order_id, 'repeated_small_refunds' FROM rules_in
  WHERE order_id IN (SELECT order_id FROM refunds WHERE refund_amount < 20000 GROUP BY order_id HAVING count(*) >= 3)
UNION ALL SELECT order_id, 'fake_delivery_success' FROM rules_in WHERE order_status = 'delivered'
  AND order_id IN (SELECT order_id FROM revs WHERE regexp_matches(review_comment, '(?i)\\bwas\\b.*\\bnot\\b'))
UNION ALL SELECT order_id, 'negative_profit_margin' FROM rules_in WHERE profit_margin < 0
"""

CTES["base_scores"] = """
SELECT *, CASE WHEN ensemble_score >= 0.80 THEN 'Critical' WHEN ensemble_score >= 0.65 THEN 'High'
               WHEN ensemble_score >= 0.40 THEN 'Medium' ELSE 'Low' END AS risk_tier,
       (ensemble_score >= 0.6 OR coalesce(profit_margin, 0) < 0)::INTEGER AS anomaly_flag,
       percent_rank() OVER (ORDER BY ensemble_score) AS anomaly_rank
FROM (
  SELECT *, round(0.65 * if_score + 0.35 * lof_score, 6)::DECIMAL(8,6) AS ensemble_score
  FROM (
    SELECT *, least(1, greatest(0, 0.9 - coalesce(profit_margin, 0)))::DECIMAL(8,6) AS if_score,
           least(1, greatest(0, coalesce(abs(shipping_delay_days), 0) * 0.0005))::DECIMAL(8,6) AS lof_score
    FROM rules_in))
"""

CTES["raw_reasons"] = """
SELECT order_id, string_agg(word, '|' ORDER BY pos) AS raw_reason
FROM rule_hits JOIN (VALUES
  ('cod_unpaid_after_delivery', 'COD unpaid', 1), ('inventory_mismatch', 'Inventory mismatch', 2),
  ('high_discount_negative_profit', 'High discount', 3), ('negative_profit_margin', 'Negative margin', 4),
  ('logistics_exceeds_revenue', 'Logistics>revenue', 5), ('payment_approved_never_shipped', 'Never shipped', 6),
  ('no_invoice_on_completion', 'No invoice', 7), ('partial_payment_only', 'Partial payment', 8),
  ('seller_paid_twice', 'Seller paid twice', 9), ('wrong_shipping_fee', 'Wrong shipping fee', 10),
  ('review_contradicts_cancelled', 'Contradicting review', 11), ('shipping_failed_review_exists', 'Shipping failed', 12))
  w(scenario, word, pos) USING (scenario)
GROUP BY order_id
"""

CTES["scores"] = """
SELECT * EXCLUDE (slots), [x FOR x IN slots IF x IS NOT NULL] AS leakage_scenarios
FROM (
  SELECT *, [
    CASE WHEN leakage_reason LIKE '%cod\\_unpaid%' ESCAPE '\\' THEN 'cod_unpaid_after_delivery' END,
    CASE WHEN contains(leakage_reason, 'inventory_mismatch') THEN 'inventory_mismatch' END,
    CASE WHEN contains(leakage_reason, 'high_discount') THEN 'high_discount_negative_profit' END,
    CASE WHEN contains(leakage_reason, 'negative_profit') OR contains(leakage_reason, 'negative_margin')
         THEN 'negative_profit_margin' END,
    CASE WHEN contains(leakage_reason, 'logistics>revenue') THEN 'logistics_exceeds_revenue' END,
    CASE WHEN contains(leakage_reason, 'never_shipped') THEN 'payment_approved_never_shipped' END,
    CASE WHEN contains(leakage_reason, 'no_invoice') THEN 'no_invoice_on_completion' END,
    CASE WHEN contains(leakage_reason, 'partial_payment') THEN 'partial_payment_only' END,
    CASE WHEN contains(leakage_reason, 'seller_paid_twice') THEN 'seller_paid_twice' END,
    CASE WHEN contains(leakage_reason, 'wrong_shipping_fee') THEN 'wrong_shipping_fee' END,
    CASE WHEN contains(leakage_reason, 'statistical_outlier') THEN 'statistical_outlier' END,
    CASE WHEN contains(leakage_reason, 'contradicting_review') THEN 'review_contradicts_cancelled'
         WHEN contains(leakage_reason, 'shipping_failed') THEN 'shipping_failed_review_exists' END,
    CASE WHEN leakage_reason = 'no_leakage' THEN 'no_leakage' END] AS slots
  FROM (
    SELECT b.*, coalesce(raw_reason, 'Statistical outlier') AS raw_reason,
           CASE WHEN anomaly_flag = 0 THEN 'no_leakage'
                ELSE lower(replace(coalesce(raw_reason, 'Statistical outlier'), ' ', '_')) END AS leakage_reason,
           strftime(order_month, '%Y-%m') AS month
    FROM base_scores b LEFT JOIN raw_reasons USING (order_id)))
"""

CTES["reasons"] = """
SELECT order_id, unnest(leakage_scenarios) AS leakage_type, round(ensemble_score, 4)::DECIMAL(5,4) AS confidence
FROM scores WHERE NOT list_contains(leakage_scenarios, 'no_leakage')
"""

CTES["dash"] = """
SELECT o.order_id, o.customer_id, c.customer_name, c.customer_city, c.segment AS customer_segment, o.order_status,
       o.order_purchase_timestamp, o.order_month, o.order_quarter, o.order_year, o.total_revenue, o.total_profit,
       o.profit_margin, o.avg_discount_pct, o.shipping_delay_days, o.invoice_available, o.inventory_mismatch,
       o.payment_status, p.payment_type, p.payment_value, p.seller_paid_twice, s.shipping_status,
       s.shipping_fee_charged, s.actual_logistics_cost, s.fee_calculation_error, s.fee_to_cost_ratio, s.carrier,
       r.rating, r.sentiment, r.review_comment, m.ensemble_score, m.anomaly_flag, m.risk_tier, m.leakage_scenarios,
       m.leakage_reason
FROM ords o JOIN custs c USING (customer_id) LEFT JOIN primpay p USING (order_id) LEFT JOIN ship s USING (order_id)
     LEFT JOIN lastrev r USING (order_id) LEFT JOIN scores m USING (order_id)
"""

CTES["monthly"] = """
SELECT order_month AS month, strftime(order_month, '%B %Y') AS month_label, count(*) AS total_orders,
       count(*) FILTER (WHERE anomaly_flag = 1) AS leakage_orders,
       100::DOUBLE * count(*) FILTER (WHERE anomaly_flag = 1) / count(*) AS leakage_rate_pct,
       sum(total_revenue)::DOUBLE AS total_revenue,
       coalesce(sum(total_revenue) FILTER (WHERE anomaly_flag = 1), 0)::DOUBLE AS revenue_at_risk,
       sum(total_profit)::DOUBLE AS total_profit,
       sum(profit_margin)::DOUBLE / nullif(count(profit_margin), 0) AS avg_profit_margin
FROM dash GROUP BY order_month
"""

CTES["sellrisk"] = """
SELECT s.seller_id, s.seller_name, s.seller_city, s.seller_rating::DOUBLE AS seller_rating,
       s.return_rate::DOUBLE AS return_rate, s.payment_disputes, f.total_orders, f.leakage_orders,
       100::DOUBLE * f.leakage_orders / f.total_orders AS leakage_rate_pct, f.total_revenue, f.avg_anomaly_score
FROM sells s JOIN (
  SELECT seller_id, count(DISTINCT order_id) AS total_orders,
         count(DISTINCT order_id) FILTER (WHERE anomaly_flag = 1) AS leakage_orders,
         sum(revenue)::DOUBLE AS total_revenue,
         sum(ensemble_score)::DOUBLE / count(ensemble_score) AS avg_anomaly_score
  FROM (SELECT seller_id, order_id, sum(price_after_discount) AS revenue FROM items GROUP BY 1, 2)
       LEFT JOIN scores USING (order_id)
  GROUP BY 1) f USING (seller_id)
"""

CTES["byscenario"] = """
SELECT leakage_type AS scenario, count(*) AS total_orders, sum(o.total_revenue)::DOUBLE AS revenue_at_risk,
       sum(m.ensemble_score)::DOUBLE / count(m.ensemble_score) AS avg_anomaly_score,
       sum(o.profit_margin)::DOUBLE / nullif(count(o.profit_margin), 0) AS avg_profit_margin
FROM reasons JOIN ords o USING (order_id) JOIN scores m USING (order_id) GROUP BY 1
"""

CTES["docs"] = """
SELECT *, CASE WHEN source_type = 'review' THEN doc_id::VARCHAR ELSE source || '-' || doc_id END AS source_id,
       CASE source_type
            WHEN 'schema_doc' THEN 'schema' WHEN 'join_graph' THEN 'schema' WHEN 'anti_pattern' THEN 'schema'
            WHEN 'enum_reference' THEN 'schema' WHEN 'generated_column' THEN 'schema'
            WHEN 'business_rule' THEN 'business_rule' WHEN 'leakage_scenario' THEN 'business_rule'
            WHEN 'leakage_reason' THEN 'business_rule' WHEN 'sql_template' THEN 'sql_template' WHEN 'review' THEN 'review'
            WHEN 'kpi_glossary' THEN 'metric' WHEN 'metric_definition' THEN 'metric'
            WHEN 'anomaly_interpretation' THEN 'metric' WHEN 'summary_profile' THEN 'metric'
            WHEN 'routing_hint' THEN 'routing' WHEN 'lineage_doc' THEN 'lineage'
            WHEN 'temporal_context' THEN 'glossary' ELSE 'schema' END AS embedding_type
FROM (
  SELECT d.doc_id,
         coalesce((['schema_doc', 'business_rule', 'leakage_scenario', 'sql_template', 'review', 'leakage_reason',
           'kpi_glossary', 'join_graph', 'anti_pattern', 'routing_hint', 'enum_reference', 'generated_column',
           'metric_definition', 'lineage_doc', 'anomaly_interpretation', 'summary_profile', 'temporal_context'])
           [substr(d.source, 4)::INTEGER + 1], 'review') AS source_type,
         d.source, d.n_chars,
         'Document ' || d.doc_id || ' (' || d.lang || ')' AS title, d.text AS content, d.lang AS content_lang,
         least(10, 1 + d.n_chars // 500)::SMALLINT AS priority,
         CASE d.lang WHEN 'en' THEN 2.0 WHEN 'de' THEN 1.5 WHEN 'fr' THEN 1.3 ELSE 1.0 END::DECIMAL(4,2) AS retrieval_weight,
         1 AS version, coalesce(l.toxic, 0) = 0 AS is_active, e.vec_id IS NULL AS needs_reembedding,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.n_chars) AS updated_at
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = d.doc_id)
"""

CTES["raw_tokens"] = """
SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+') IF x <> ''] AS toks
FROM documents
"""

CTES["stem_tokens"] = """
SELECT doc_id, [x FOR x IN regexp_split_to_array(
         regexp_replace(lower(text), '([\\p{L}\\p{N}]{3})(ings|ing|ied|ies|edly|ed|es|ly|s)([^\\p{L}\\p{N}]|$)', '\\1\\3', 'g'),
         '[^\\p{L}\\p{N}]+') IF x <> ''] AS stems
FROM documents
"""

# (doc, position, word) with stems after the raw words
CTES["postings"] = """
SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS word
FROM (SELECT doc_id, list_concat(toks, stems) AS words FROM raw_tokens JOIN stem_tokens USING (doc_id))
"""


CTES["lexlists"] = """
SELECT doc_id, list_concat(toks, stems) AS words FROM raw_tokens JOIN stem_tokens USING (doc_id)
"""


def _cover_scores(raw: list[str], stem: list[str]) -> str:
    """Cover density of every document for a fixed query, by window functions over its hits."""
    def last(term: str) -> str:
        return f"max(pos) FILTER (WHERE word = '{term}') OVER upto"

    def start(terms: list[str]) -> str:
        if not terms:
            return "-1"
        seen = " AND ".join(f"{last(t)} IS NOT NULL" for t in terms)
        return f"CASE WHEN {seen} THEN least({', '.join(last(t) for t in terms)}) ELSE -1 END"

    words = ", ".join(f"'{t}'" for t in dict.fromkeys(raw + stem))
    return f"""
WITH hits AS (SELECT doc_id, pos, word, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n
              FROM postings WHERE word IN ({words})),
spans AS (SELECT doc_id, pos, n, greatest({start(raw)}, {start(stem)}) AS s FROM hits
          WINDOW upto AS (PARTITION BY doc_id ORDER BY pos)),
fresh AS (SELECT *, max(s) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM spans)
SELECT f.doc_id, round(sum(0.1::DOUBLE / (1 + (f.pos - f.s) - (f.n - h.n))), 6) AS bm25_score
FROM fresh f JOIN hits h ON h.doc_id = f.doc_id AND h.pos = f.s
WHERE f.s > coalesce(f.before, -1) GROUP BY 1
"""


CTES["kwscores"] = _cover_scores(["this", "was"], ["thi", "was"])
CTES["kwscores_raw"] = _cover_scores(["this", "was"], [])
CTES["thescores"] = _cover_scores(["the"], ["the"])

CTES["vecscores"] = """
SELECT e.vec_id AS doc_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS vector_score
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q
"""

# Labels, priorities and weights of these documents.
CTES["revdocs"] = """
SELECT 'review' AS source_type, r.order_id::VARCHAR AS source_id, 'Customer Review: ' || r.order_id AS title,
       'Order ID: ' || r.order_id || chr(10) || 'Rating: ' || r.rating_group || chr(10) || 'Sentiment: ' || r.sentiment
         || chr(10) || 'Leakage Scenarios: ' || coalesce(x.names, 'no_leakage') || chr(10) || 'Order Status: '
         || o.order_status || chr(10) || 'Review: ' || r.review_comment AS content,
       'ar+en' AS content_lang, 'review' AS embedding_type,
       CASE WHEN m.anomaly_flag = 1 AND r.sentiment = 'negative' THEN 5 WHEN m.anomaly_flag = 1 THEN 4
            WHEN r.sentiment = 'negative' THEN 3 ELSE 2 END AS priority,
       0.6::DECIMAL(4,2) AS retrieval_weight, r.rating_group, r.sentiment, m.anomaly_flag, m.risk_tier,
       row_number() OVER (ORDER BY coalesce(m.anomaly_flag, 0) DESC,
         CASE r.sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END,
         r.review_date DESC NULLS FIRST, r.review_id) AS place
FROM revs r JOIN ords o USING (order_id) LEFT JOIN scores m USING (order_id)
LEFT JOIN (SELECT order_id, string_agg(leakage_type, ', ' ORDER BY leakage_type) AS names FROM reasons GROUP BY 1) x USING (order_id)
WHERE r.review_comment IS NOT NULL AND length(trim(r.review_comment)) > 10 AND NOT r.is_emoji_only
  AND NOT EXISTS (SELECT 1 FROM docs d WHERE d.source_type = 'review' AND d.source_id = r.order_id::VARCHAR)
"""

# Labels, priorities and weights of these documents.
CTES["leakdocs"] = """
SELECT 'leakage_reason' AS source_type, m.order_id::VARCHAR AS source_id, 'Leakage Report: ' || m.order_id AS title,
       'Order ID: ' || m.order_id || chr(10) || 'Risk Tier: ' || m.risk_tier || chr(10) || 'Anomaly Score: '
         || m.ensemble_score || chr(10) || 'Order Status: ' || o.order_status || chr(10) || 'Payment Status: '
         || o.payment_status || chr(10) || 'Total Revenue: ' || coalesce(o.total_revenue::VARCHAR, '') || ' EGP' || chr(10)
         || 'Profit Margin: ' || coalesce(o.profit_margin::VARCHAR, '') || chr(10) || 'Shipping Delay Days: '
         || coalesce(o.shipping_delay_days::VARCHAR, '') || chr(10) || 'Leakage Scenarios: ' || coalesce(x.names, 'none')
         || chr(10) || 'Customer Segment: ' || c.segment || chr(10) || 'City: ' || c.customer_city AS content,
       'ar+en' AS content_lang, 'business_rule' AS embedding_type,
       CASE m.risk_tier WHEN 'Critical' THEN 8 WHEN 'High' THEN 7 WHEN 'Medium' THEN 5 ELSE 3 END AS priority,
       CASE m.risk_tier WHEN 'Critical' THEN 1.2 WHEN 'High' THEN 1.0 ELSE 0.8 END::DECIMAL(4,2) AS retrieval_weight
FROM scores m JOIN ords o USING (order_id) JOIN custs c ON c.customer_id = o.customer_id
LEFT JOIN (SELECT order_id, string_agg(leakage_type, ' | ' ORDER BY leakage_type) AS names FROM reasons GROUP BY 1) x USING (order_id)
WHERE m.anomaly_flag = 1
"""

CTES["visits"] = """
SELECT user_id AS customer_id, min(ts) AS session_start, max(ts) AS session_end,
       arg_min(event_type, (ts, event_id)) AS traffic_source, count(*) AS events, count(*) = 1 AS bounce,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000, 2) AS session_duration_min
FROM (
  SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit
  FROM (SELECT *, (lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                   OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE)::INTEGER AS is_new
        FROM events))
GROUP BY user_id, visit
"""

CTES["sqltexts"] = """
SELECT o_orderkey AS statement_id, CASE
  WHEN o_orderpriority = '1-URGENT' THEN 'SELECT SUM(orders.amount) FROM ecommerce.payments WHERE order_id = ''' || o_orderkey || ''''
  WHEN o_orderpriority = '2-HIGH' THEN 'select oi.price from ecommerce.order_items oi' || chr(10)
    || 'join ecommerce.orders o using (order_id)' || chr(10) || 'where price > 10 and order_id = ' || o_orderkey
  WHEN o_orderpriority = '3-MEDIUM' THEN 'SELECT payment_type FROM ecommerce.payments WHERE payment_sequential = 1 AND order_id = ' || o_orderkey
  WHEN o_orderstatus = 'F' THEN 'SELECT * FROM orders WHERE order_status = ''Complete'' AND risk_tier = ''severe'' AND order_id = ' || o_orderkey
  ELSE 'SELECT order_itemsXfinal_price, order_items.final_price FROM reviews r JOIN orders o JOIN payments p JOIN shipping s -- ' || o_orderkey
  END AS sql_text
FROM orders
"""

# the look-aheads of two rules are stated as a second, negated match (statements name the table once)
CTES["vetted"] = r"""
SELECT t.statement_id, r.guard_type, r.pattern, r.message
FROM sqltexts t JOIN (VALUES
  ('fake_column', 'contains', 'orders.status', 'Column does not exist. Use orders.order_status', ''),
  ('fake_column', 'contains', 'orders.amount', 'Column does not exist. Use orders.total_revenue', ''),
  ('fake_column', 'contains', 'customers.name', 'Column does not exist. Use customers.customer_unique_id or customer_city', ''),
  ('fake_column', 'contains', 'payments.amount', 'Column does not exist. Use payments.payment_value', ''),
  ('fake_column', 'contains', 'order_items.final_price', 'Column does not exist. Use order_items.price_after_discount', ''),
  ('fake_enum', 'contains', '''complete''', 'Invalid order_status value. Use ''delivered'' or ''processing''', ''),
  ('fake_enum', 'contains', '''success''', 'Invalid payment_status value. Use ''approved''', ''),
  ('fake_enum', 'contains', '''pending_payment''', 'Invalid status. Use payment_status = ''unpaid''', ''),
  ('fake_enum', 'contains', '''Extreme''', 'Invalid risk_tier. Valid values: Low, Medium, High, Critical', ''),
  ('fake_enum', 'contains', '''Severe''', 'Invalid risk_tier. Valid values: Low, Medium, High, Critical', ''),
  ('dangerous_join', 'regex', 'reviews\s+.*JOIN\s+.*orders\s+.*JOIN\s+.*payments\s+.*JOIN\s+.*shipping',
   'Too many JOINs — use ml_output.mv_leakage_dashboard instead', 'R1'),
  ('dangerous_join', 'regex', 'order_items\s+.*JOIN\s+.*orders\s+.*WHERE\s+.*\bprice\b(?!_after_discount)',
   'Use price_after_discount instead of price for revenue calculations', 'R2'),
  ('dangerous_join', 'regex', 'FROM\s+ecommerce\.payments(?!.*payment_sequential)',
   'Missing payment_sequential = 1 filter — will return duplicate rows', 'R3')) r(guard_type, guard_mode, pattern, message, rule)
ON CASE r.rule
  WHEN '' THEN t.sql_text ILIKE '%' || r.pattern || '%'
  WHEN 'R1' THEN regexp_matches(t.sql_text, '(?is)reviews\s+.*JOIN\s+.*orders\s+.*JOIN\s+.*payments\s+.*JOIN\s+.*shipping')
  WHEN 'R2' THEN regexp_matches(t.sql_text, '(?is)order_items\s+.*JOIN\s+.*orders\s+.*WHERE\s+.*\bprice\b')
  WHEN 'R3' THEN regexp_matches(t.sql_text, '(?is)FROM\s+ecommerce\.payments')
    AND NOT regexp_matches(t.sql_text, '(?is)FROM\s+ecommerce\.payments.*payment_sequential') END
"""

# ---- benchmark texts as a batch of queries ----

CTES["bterms"] = r"""
SELECT DISTINCT item_id AS query_id, kind, term
FROM (
  SELECT item_id, 'raw' AS kind, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM benchmark
  UNION ALL
  SELECT item_id, 'stem', unnest(regexp_split_to_array(regexp_replace(lower(text),
    '([\p{L}\p{N}]{3})(ings|ing|ied|ies|edly|ed|es|ly|s)([^\p{L}\p{N}]|$)', '\1\3', 'g'), '[^\p{L}\p{N}]+')) FROM benchmark)
WHERE term <> ''
"""

CTES["bcand"] = """
SELECT DISTINCT query_id, doc_id
FROM (
  SELECT query_id, kind, doc_id, count(*) AS found
  FROM (SELECT DISTINCT doc_id, word FROM postings) p JOIN bterms t ON t.term = p.word GROUP BY 1, 2, 3)
JOIN (SELECT query_id, kind, count(*) AS wanted FROM bterms GROUP BY 1, 2) USING (query_id, kind)
JOIN docs d USING (doc_id) WHERE found = wanted AND d.is_active
"""

CTES["bhits"] = """
SELECT c.query_id, c.doc_id, p.pos, p.word, row_number() OVER (PARTITION BY c.query_id, c.doc_id ORDER BY p.pos) AS n
FROM bcand c JOIN postings p USING (doc_id)
WHERE EXISTS (SELECT 1 FROM bterms t WHERE t.query_id = c.query_id AND t.term = p.word)
"""

CTES["bstarts"] = """
SELECT query_id, doc_id, pos, n, max(s) AS s
FROM (
  SELECT e.query_id, e.doc_id, e.pos, e.n, e.kind, CASE WHEN count(h.pos) = count(*) THEN min(h.pos) ELSE -1 END AS s
  FROM (SELECT b.*, t.kind, t.term FROM bhits b JOIN bterms t USING (query_id)) e
  ASOF LEFT JOIN bhits h ON h.query_id = e.query_id AND h.doc_id = e.doc_id AND h.word = e.term AND e.pos >= h.pos
  GROUP BY 1, 2, 3, 4, 5)
GROUP BY 1, 2, 3, 4
"""

CTES["bscores"] = """
SELECT query_id, doc_id, bm25_score
FROM (
  SELECT f.query_id, f.doc_id, round(sum(0.1::DOUBLE / (1 + (f.pos - f.s) - (f.n - h.n))), 6) AS bm25_score
  FROM (SELECT *, max(s) OVER (PARTITION BY query_id, doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          AS before FROM bstarts) f
  JOIN bhits h ON h.query_id = f.query_id AND h.doc_id = f.doc_id AND h.pos = f.s
  WHERE f.s > coalesce(f.before, -1) GROUP BY 1, 2)
"""

CTES["bsims"] = """
SELECT b.item_id AS query_id, e.vec_id AS doc_id,
       round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS vector_score
FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id, embeddings e JOIN docs d ON d.doc_id = e.vec_id
WHERE d.is_active
"""


def _batch(suffix: str, k: int, wanted: str) -> None:
    """Both legs of a batch over documents that are ``wanted``, and the ranked blend."""
    CTES[f"batchkw{suffix}"] = f"""
SELECT s.* FROM bscores s JOIN docs d USING (doc_id) WHERE {wanted}
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY bm25_score DESC, doc_id) <= {3 * k}
"""
    CTES[f"batchvec{suffix}"] = f"""
SELECT s.* FROM bsims s JOIN docs d USING (doc_id) WHERE {wanted}
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY vector_score DESC, doc_id) <= {3 * k}
"""
    CTES[f"batch{suffix}"] = f"""
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hybrid_score DESC, priority DESC, doc_id) AS rank
FROM (
  SELECT f.*, d.source_type, d.priority, d.retrieval_weight,
         round((0.4::DOUBLE * bm25_score + 0.6::DOUBLE * vector_score) * d.retrieval_weight::DOUBLE, 9) AS hybrid_score
  FROM (SELECT coalesce(k.query_id, v.query_id) AS query_id, coalesce(k.doc_id, v.doc_id) AS doc_id,
               coalesce(bm25_score, 0::DOUBLE) AS bm25_score, coalesce(vector_score, 0::DOUBLE) AS vector_score
        FROM batchkw{suffix} k FULL JOIN batchvec{suffix} v ON k.query_id = v.query_id AND k.doc_id = v.doc_id) f
  JOIN docs d USING (doc_id)
  QUALIFY row_number() OVER (PARTITION BY f.query_id, d.source_type ORDER BY hybrid_score DESC, f.doc_id) <= 2)
QUALIFY rank <= {k}
"""


_batch("", 8, "d.is_active")
_batch("rev", 5, "d.is_active AND d.source_type = 'review'")
# The source types of the analytics search: all but reviews, order reports, business rules and time context.
_batch("an", 8, "d.is_active AND d.source_type NOT IN ('review', 'leakage_reason', 'business_rule', 'temporal_context')")


def statement(body: str) -> str:
    """``body`` with the table expressions it uses, in dependency order."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name, text in CTES.items():
            if name not in order and re.search(rf"(?i)\b(?:from|join)\s+{name}\b", sql):
                need(text)
                order.append(name)

    need(body)
    if not order:
        return body
    heads = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"
