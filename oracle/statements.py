"""DuckDB statement for each query that SQL can express. Columns carry the names the query gives."""

from __future__ import annotations

from oracle.ctes import statement

S: dict[str, str] = {}


def _scores_columns() -> str:
    return """order_id, if_score::DOUBLE AS if_score, lof_score::DOUBLE AS lof_score,
  ensemble_score::DOUBLE AS ensemble_score, anomaly_flag, risk_tier, leakage_reason, customer_id, order_status,
  strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
  total_revenue::DOUBLE AS total_revenue, profit_margin::DOUBLE AS profit_margin,
  avg_discount_pct::DOUBLE AS avg_discount_pct, shipping_delay_days, payment_status, shipping_status, month"""


S["io1_scores_csv"] = f"""
SELECT {_scores_columns().replace('order_id,', 'order_id::VARCHAR AS order_id,', 1)
        .replace('customer_id,', 'customer_id::VARCHAR AS customer_id,')},
  round(anomaly_rank, 5)::DECIMAL(6,5)::DOUBLE AS anomaly_rank
FROM scores"""
S["io2_scores_scan"] = f"""
SELECT {_scores_columns()}, array_to_string(leakage_scenarios, '|') AS leakage_scenarios FROM scores"""
S["io3_documents_jsonl"] = """
SELECT doc_id, source_type, title, length(replace(content, '''''', '''')) AS chars, priority,
  retrieval_weight::DOUBLE AS retrieval_weight, is_active FROM docs"""
S["io4_append_documents"] = """
SELECT source_type, count(*) AS documents, sum(length(content))::BIGINT AS chars, sum(priority)::BIGINT AS priorities
FROM (SELECT source_type, content, priority FROM revdocs UNION ALL SELECT source_type, content, priority FROM leakdocs)
GROUP BY 1"""
S["io5_upsert_embeddings"] = """
SELECT e.vec_id AS doc_id, len(e.embedding)::INTEGER AS dim,
  CASE WHEN d.priority >= 5 THEN e.embedding[len(e.embedding)] ELSE e.embedding[1] END::DOUBLE AS first_value
FROM embeddings e JOIN docs d ON d.doc_id = e.vec_id"""
S["io6_insert_ignore_reasons"] = """
SELECT order_id, leakage_type, confidence::DOUBLE AS confidence FROM reasons WHERE confidence < 0.7"""
S["io7_join_update_scenarios"] = """
SELECT order_id, array_to_string(leakage_scenarios, '|') AS leakage_scenarios, leakage_reason FROM scores"""
S["io9_clear_flags"] = """
SELECT doc_id, needs_reembedding AND NOT (priority >= 5 AND is_active) AS needs_reembedding FROM docs"""
S["io10_delete_not_in"] = """
SELECT order_id, leakage_type, confidence::DOUBLE AS confidence FROM reasons
WHERE order_id NOT IN (SELECT order_id FROM dash WHERE customer_segment = 'Low Value') AND confidence >= 0.65"""
_MONTHLY = """strftime(month, '%Y-%m-%d') AS month, month_label, total_orders, leakage_orders, leakage_rate_pct,
  total_revenue, revenue_at_risk, total_profit, avg_profit_margin"""
S["io11_json_export"] = f"SELECT {_MONTHLY} FROM monthly"
S["io12_refresh_views"] = """
SELECT 'dashboard' AS view_name, count(*) AS n FROM dash UNION ALL SELECT 'monthly_leakage', count(*) FROM monthly
UNION ALL SELECT 'seller_risk', count(*) FROM sellrisk UNION ALL SELECT 'leakage_by_scenario', count(*) FROM byscenario"""

S["pf3_in_list"] = """
SELECT order_id, shipping_status, carrier FROM ship WHERE shipping_status IN ('delivered', 'in_transit')"""
S["pf5_optional_types"] = """
SELECT source_type, count(*) AS documents, 'listed' AS asked FROM docs
WHERE is_active AND source_type IN ('review', 'schema_doc') GROUP BY 1
UNION ALL SELECT source_type, count(*), 'all' FROM docs WHERE is_active GROUP BY 1"""
S["pf8_pattern_from_column"] = """
SELECT p_partkey, p_name ILIKE '%' || upper(split_part(p_name, ' ', 1)) || '_%' AS name_like,
  regexp_matches(p_brand, '(?is)^brand#' || substr(p_size::VARCHAR, 1, 1)) AS brand_matches FROM part"""
S["pf10_null_predicates"] = """
SELECT count(*) FILTER (WHERE profit_margin IS NULL) AS no_margin,
  count(*) FILTER (WHERE profit_margin IS NOT NULL) AS with_margin,
  count(*) FILTER (WHERE total_revenue IS DISTINCT FROM billed_total) AS distinct_from_billed
FROM ords JOIN headers USING (order_id)"""
S["pf12_coalesce_nullif"] = """
SELECT order_id, coalesce(sentiment, 'unknown') AS sentiment, nullif(payment_status, 'approved') AS open_payment,
  coalesce(shipping_delay_days, 0) AS delay FROM dash"""
S["pf14_boolean_flags"] = """
SELECT order_id, customer_id, total_revenue::DOUBLE AS total_revenue FROM dash
WHERE seller_paid_twice AND NOT invoice_available AND NOT inventory_mismatch"""
S["pf15_calendar_columns"] = """
SELECT order_id, strftime(order_month, '%Y-%m-%d') AS order_month, strftime(order_quarter, '%Y-%m-%d') AS order_quarter,
  order_year FROM ords"""
S["pf16_ratio_columns"] = """
SELECT order_id, order_item_id, product_id, price::DOUBLE AS price, item_discount_pct::DOUBLE AS item_discount_pct,
  price_after_discount::DOUBLE AS price_after_discount, freight_value::DOUBLE AS freight_value,
  logistics_cost::DOUBLE AS logistics_cost FROM items"""

S["f1_concat_nulls"] = """
SELECT order_id, 'S: ' || coalesce(sentiment, '') || ', M: ' || coalesce(profit_margin::VARCHAR, '') AS skipping,
  'S: ' || sentiment AS strict FROM dash"""
_DOMAIN = """(VALUES ('delivered_no_payment', 1), ('shipped_then_cancelled', 2), ('incorrect_refund_on_delivery', 3),
  ('duplicate_refund', 4), ('payment_approved_never_shipped', 5), ('logistics_exceeds_revenue', 6),
  ('returned_product_kept', 7), ('cod_unpaid_after_delivery', 8), ('fake_delivery_success', 9),
  ('high_discount_negative_profit', 10), ('no_invoice_on_completion', 11), ('partial_payment_only', 12),
  ('refund_before_cancellation', 13), ('inventory_mismatch', 14), ('seller_paid_twice', 15),
  ('shipping_failed_review_exists', 16), ('review_contradicts_cancelled', 17), ('wrong_shipping_fee', 18),
  ('repeated_small_refunds', 19), ('delayed_delivery_compensation', 20), ('no_leakage', 21),
  ('statistical_outlier', 22), ('negative_profit_margin', 23)) dom(value, position)"""
S["f7_scenario_domain"] = f"""
SELECT value, position, count(r.order_id) AS n FROM {_DOMAIN} LEFT JOIN reasons r ON r.leakage_type = value GROUP BY 1, 2"""
S["f9_campaign_interactions"] = """
SELECT 'Brand#' || (props::JSON->>'k') AS campaign_id, count(*) AS interactions,
  sum(value::DECIMAL(12,2))::DOUBLE AS value, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM events GROUP BY 1"""
S["f14_cosine_to_label_mean"] = """
WITH m AS (SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS i,
    unnest(embedding) AS x FROM embeddings) GROUP BY 1, 2),
mv AS (SELECT label, list(m ORDER BY i) AS mean FROM m GROUP BY 1)
SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], mean), 6) AS similarity
FROM embeddings JOIN mv USING (label)"""
S["f15_lexemes"] = "SELECT word, count(*) AS n, max(pos)::INTEGER AS last_pos FROM postings GROUP BY 1"
S["f16_text_match"] = """
SELECT doc_id, list_contains(words, 'this') AND list_contains(words, 'was') AS raw_match,
  list_contains(words, 'thi') AND list_contains(words, 'was') AS stem_match FROM lexlists"""
S["f19_shorten"] = """
SELECT doc_id, CASE WHEN length(text) > 60 THEN substr(text, 1, 60) || '…' ELSE text END AS cut FROM documents"""
S["f20_trigram_similarity"] = """
WITH t AS (SELECT DISTINCT review_id, unnest([x FOR x IN regexp_split_to_array(lower(review_comment), '[^\\p{L}\\p{N}]+')
             IF x <> '']) AS w FROM revs),
g AS (SELECT DISTINCT review_id, substr('  ' || w || ' ', i, 3) AS tri
      FROM (SELECT review_id, w, unnest(range(1, length(w) + 2)) AS i FROM t)),
q AS (SELECT DISTINCT substr('  ' || w || ' ', i, 3) AS tri
      FROM (SELECT w, unnest(range(1, length(w) + 2)) AS i FROM (VALUES ('the'), ('order'), ('was'), ('late')) v(w))),
s AS (SELECT review_id, count(*) AS n, count(q.tri) AS shared FROM g LEFT JOIN q USING (tri) GROUP BY 1)
SELECT review_id, round(coalesce(shared, 0)::DOUBLE / (coalesce(n, 0) + (SELECT count(*) FROM q) - coalesce(shared, 0)), 6)
  AS similarity FROM revs LEFT JOIN s USING (review_id)"""

S["f20_similar_reviews"] = f"SELECT review_id, similarity FROM ({S['f20_trigram_similarity']}) WHERE similarity >= 0.1"

S["f20_similar_pairs"] = """
WITH t AS (SELECT DISTINCT review_id, order_id, unnest([x FOR x IN regexp_split_to_array(lower(review_comment), '[^\\p{L}\\p{N}]+')
             IF x <> '']) AS w FROM revs),
g AS (SELECT DISTINCT review_id, order_id, substr('  ' || w || ' ', i, 3) AS tri
      FROM (SELECT review_id, order_id, w, unnest(range(1, length(w) + 2)) AS i FROM t)),
size AS (SELECT review_id, count(*) AS n FROM g GROUP BY 1),
met AS (SELECT a.review_id AS asked, b.review_id, count(*) AS shared FROM g a JOIN g b ON a.tri = b.tri
        WHERE a.order_id % 50 = 0 AND a.review_id <> b.review_id GROUP BY 1, 2)
SELECT asked AS asked_review_id, m.review_id, round(shared::DOUBLE / (x.n + y.n - shared), 6) AS similarity
FROM met m JOIN size x ON x.review_id = asked JOIN size y ON y.review_id = m.review_id
WHERE 100 * shared >= 70 * (x.n + y.n - shared)"""

S["j7_latest_review"] = """
SELECT order_id, rating::DOUBLE AS rating, sentiment, length(review_comment)::INTEGER AS chars FROM lastrev"""
S["j9_seller_chain"] = """
SELECT s.seller_name, o.order_status, m.risk_tier, count(DISTINCT (i.seller_id, i.order_id)) AS orders,
  sum(i.price_after_discount)::DOUBLE AS sold
FROM sells s JOIN items i USING (seller_id) JOIN ords o USING (order_id) LEFT JOIN scores m USING (order_id) GROUP BY 1, 2, 3"""
S["j11_scenarios_per_order"] = """
SELECT o.order_id, coalesce(string_agg(r.leakage_type, ', ' ORDER BY r.leakage_type), 'no_leakage') AS scenarios
FROM ords o LEFT JOIN reasons r USING (order_id) GROUP BY 1"""
S["j12_semi_join"] = """
SELECT customer_id, customer_name, segment FROM custs
WHERE customer_id IN (SELECT customer_id FROM dash WHERE risk_tier = 'Critical')"""
S["j13_zip_places"] = """
WITH g AS (SELECT c_nationkey AS zip, count(*) AS points, min(n_name) AS city,
    sum(round(c_acctbal::DECIMAL(12,2)::DECIMAL(18,8) * 0.005, 6)::DECIMAL(9,6))::DOUBLE / count(*) AS lat,
    sum(round(c_acctbal::DECIMAL(12,2)::DECIMAL(18,8) * 0.01, 6)::DECIMAL(9,6))::DOUBLE / count(*) AS lng
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT seller_id, points, city, lat, lng FROM sells LEFT JOIN g ON zip = seller_zip_code_prefix"""
S["j14_campaign_attribution"] = """
WITH att AS (SELECT DISTINCT l_orderkey AS order_id, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
r AS (SELECT p_brand, count(*) AS orders, sum(total_revenue) AS revenue FROM att JOIN ords USING (order_id) GROUP BY 1)
SELECT c.p_brand AS campaign_id, c.channel, c.budget, coalesce(r.orders, 0) AS orders, r.revenue::DOUBLE AS revenue
FROM (SELECT p_brand, min(p_type) AS channel, sum(p_retailprice::DECIMAL(12,2))::DOUBLE AS budget FROM part GROUP BY 1) c
LEFT JOIN r USING (p_brand)"""
S["j15_lead_funnel"] = """
SELECT c_mktsegment AS origin, count(*) AS leads, count(seller_rating) AS won,
  100::DOUBLE * count(seller_rating) / count(*) AS win_rate_pct
FROM customer LEFT JOIN sells ON seller_id = c_custkey GROUP BY 1"""

S["a6_duplicate_keys"] = """
SELECT order_id, order_item_id, count(*) AS n FROM items GROUP BY 1, 2 HAVING count(*) > 1"""
S["a7_ordered_text"] = """
SELECT p_type, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands FROM part GROUP BY 1"""
S["a8_ordered_array"] = """
SELECT r_name, string_agg(n_name, '|' ORDER BY n_nationkey) AS cities
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""
S["a9_keep_first"] = """
SELECT order_id, order_item_id, product_id, seller_id, price::DOUBLE AS price FROM items
QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY price, product_id, seller_id) = 1"""
S["a14_small_refunds"] = """
SELECT order_id, count(*) FILTER (WHERE refund_amount < 20000) AS small_refunds, sum(refund_amount)::DOUBLE AS refunded_total
FROM refunds GROUP BY 1 HAVING count(*) FILTER (WHERE refund_amount < 20000) >= 3"""
S["a15_duplicate_refunds"] = """
SELECT order_id, count(*) AS refund_count, sum(refund_amount)::DOUBLE AS refunded_total
FROM refunds GROUP BY 1 HAVING count(*) > 1"""
S["a16_customer_rollup"] = """
SELECT customer_id, customer_name, customer_zip_code_prefix, customer_city, churn_risk, c_acctbal > 0 AS is_verified,
  lifetime_value::DOUBLE AS lifetime_value, total_orders, avg_order_value::DOUBLE AS avg_order_value, segment
FROM custs JOIN customer ON c_custkey = customer_id"""
S["a17_sessions_by_source"] = """
SELECT traffic_source, count(*) AS sessions, 100::DOUBLE * count(*) FILTER (WHERE bounce) / count(*) AS bounce_rate_pct,
  sum(session_duration_min::DECIMAL(8,2))::DOUBLE / count(*) AS avg_minutes FROM visits GROUP BY 1"""
S["a18_session_cost"] = """
SELECT user_id AS session_id, sum((props::JSON->>'k')::INTEGER * 20 * 0.000003 + (props::JSON->>'k')::INTEGER * 3 * 0.000015)::DOUBLE
  AS cost_usd, count(*) AS questions FROM events GROUP BY 1"""
_INTENT = """CASE event_type WHEN 'click' THEN 'simple_lookup' WHEN 'view' THEN 'sentiment_analysis'
  WHEN 'purchase' THEN 'aggregation' WHEN 'signup' THEN 'trend_analysis' ELSE 'anomaly_investigation' END"""
S["a18_chat_quality"] = f"""
SELECT {_INTENT} AS detected_intent, count(*) AS questions,
  100::DOUBLE * count(*) FILTER (WHERE event_type = 'error') / count(*) AS error_rate_pct,
  100::DOUBLE * count(*) FILTER (WHERE event_type IN ('purchase', 'signup')) / count(*) AS helpful_rate_pct,
  sum((props::JSON->>'k')::INTEGER * 20 * 0.000003 + (props::JSON->>'k')::INTEGER * 3 * 0.000015)::DOUBLE AS cost_usd
FROM events GROUP BY 1"""
S["w3_anomaly_rank"] = "SELECT order_id, anomaly_rank FROM base_scores"
S["w4_last_turns"] = """
SELECT conv_id, turn, role, length(text)::INTEGER AS chars FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3"""
S["w5_instalments"] = """
SELECT order_id, payment_sequential::INTEGER AS payment_sequential, payment_type, payment_value::DOUBLE AS payment_value FROM pays"""
S["w6_active_versions"] = """
SELECT source, count(*) AS active, count(*) = 1 AS single
FROM (SELECT source, rank() OVER (PARTITION BY source ORDER BY n_chars DESC) AS r FROM documents) WHERE r = 1 GROUP BY 1"""
S["t4_sample"] = """
SELECT order_id, risk_tier, leakage_reason FROM dash WHERE anomaly_flag = 1 ORDER BY order_id LIMIT 5"""
S["so2_dedupe_reasons"] = "SELECT DISTINCT order_id, leakage_type, confidence::DOUBLE AS confidence FROM reasons"

S["p1_normalise_reason"] = "SELECT order_id, leakage_reason FROM scores"
S["p2_reason_scenarios"] = "SELECT order_id, array_to_string(leakage_scenarios, '|') AS leakage_scenarios FROM scores"
S["p3_leakage_reasons"] = "SELECT order_id, leakage_type, confidence::DOUBLE AS confidence FROM reasons"
S["p4_rule_scenarios"] = f"""
SELECT b.order_id, b.anomaly_flag,
  CASE WHEN count(h.scenario) > 0 THEN string_agg(h.scenario, '|' ORDER BY r.position)
       WHEN b.anomaly_flag = 1 THEN 'statistical_outlier' ELSE 'no_leakage' END AS scenarios
FROM base_scores b LEFT JOIN rule_hits h USING (order_id) LEFT JOIN (VALUES
  ('delivered_no_payment', 1), ('shipped_then_cancelled', 2), ('incorrect_refund_on_delivery', 3), ('duplicate_refund', 4),
  ('payment_approved_never_shipped', 5), ('logistics_exceeds_revenue', 6), ('cod_unpaid_after_delivery', 7),
  ('high_discount_negative_profit', 8), ('no_invoice_on_completion', 9), ('partial_payment_only', 10),
  ('refund_before_cancellation', 11), ('inventory_mismatch', 12), ('seller_paid_twice', 13), ('wrong_shipping_fee', 14),
  ('review_contradicts_cancelled', 15), ('delayed_delivery_compensation', 16), ('shipping_failed_review_exists', 17),
  ('repeated_small_refunds', 18), ('fake_delivery_success', 19), ('negative_profit_margin', 20))
  r(scenario, position) ON r.scenario = h.scenario
GROUP BY 1, 2"""
S["p4_rule_counts"] = f"""
SELECT value, position, count(h.order_id) AS n FROM {_DOMAIN} LEFT JOIN (
  SELECT order_id, scenario FROM rule_hits
  UNION ALL SELECT order_id, CASE WHEN anomaly_flag = 1 THEN 'statistical_outlier' ELSE 'no_leakage' END FROM base_scores
    WHERE order_id NOT IN (SELECT order_id FROM rule_hits)) h ON h.scenario = value GROUP BY 1, 2"""
S["p5_order_rollup"] = """
SELECT order_id, total_revenue::DOUBLE AS total_revenue, total_logistics::DOUBLE AS total_logistics,
  total_freight::DOUBLE AS total_freight, item_count, avg_discount_pct::DOUBLE AS avg_discount_pct,
  total_profit::DOUBLE AS total_profit, profit_margin::DOUBLE AS profit_margin FROM rollup"""
S["p6_leakage_dashboard"] = """
SELECT order_id, customer_id, customer_name, customer_city, customer_segment, order_status,
  strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
  strftime(order_month, '%Y-%m-%d') AS order_month, strftime(order_quarter, '%Y-%m-%d') AS order_quarter, order_year,
  total_revenue::DOUBLE AS total_revenue, total_profit::DOUBLE AS total_profit, profit_margin::DOUBLE AS profit_margin,
  avg_discount_pct::DOUBLE AS avg_discount_pct, shipping_delay_days, invoice_available, inventory_mismatch,
  payment_status, payment_type, payment_value::DOUBLE AS payment_value, seller_paid_twice, shipping_status,
  shipping_fee_charged::DOUBLE AS shipping_fee_charged, actual_logistics_cost::DOUBLE AS actual_logistics_cost,
  fee_calculation_error, fee_to_cost_ratio::DOUBLE AS fee_to_cost_ratio, carrier, rating::DOUBLE AS rating, sentiment,
  review_comment, ensemble_score::DOUBLE AS ensemble_score, anomaly_flag, risk_tier,
  array_to_string(leakage_scenarios, '|') AS leakage_scenarios, leakage_reason FROM dash"""
S["p7_monthly_leakage"] = f"SELECT {_MONTHLY} FROM monthly"
S["p8_seller_risk"] = "SELECT * FROM sellrisk"
S["p9_leakage_by_scenario"] = "SELECT * FROM byscenario"
_DOC = """source_type, source_id, title, content, content_lang, embedding_type, priority,
  retrieval_weight::DOUBLE AS retrieval_weight"""
S["p10_review_documents"] = f"SELECT {_DOC} FROM revdocs"
S["t2_top_review_documents"] = f"SELECT {_DOC} FROM revdocs WHERE place <= 200"
S["p10_review_metadata"] = """
SELECT source_id::BIGINT AS order_id, rating_group AS rating, sentiment, coalesce(anomaly_flag, 0) AS anomaly_flag,
  risk_tier FROM revdocs"""
S["p11_leakage_documents"] = f"SELECT {_DOC} FROM leakdocs"
S["p12_schema_sync"] = """
WITH cols AS (
  SELECT table_name, ordinal_position AS pos, column_name || ' (' ||
    CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
         WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
         WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END ||
    CASE table_name || '.' || column_name WHEN 'orders.o_orderstatus' THEN ' - F, O or P'
         WHEN 'lineitem.l_discount' THEN ' - share 0.0-1.0' WHEN 'customer.c_acctbal' THEN ' - account balance' ELSE '' END
    || ')' AS line
  FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
    'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations'))
SELECT table_name AS source_id, 'Auto-synced schema: ' || table_name || chr(10) || chr(10) ||
  string_agg(line, chr(10) ORDER BY pos) AS content, 1 AS n FROM cols GROUP BY 1
UNION ALL SELECT source_type, '', count(*)::INTEGER FROM docs GROUP BY 1"""


def _profile(table: str, columns: str) -> str:
    """A column with ``*`` is a double: adding zero makes its two zeros one."""
    parts = []
    for c in columns.split():
        name, value = c.rstrip("*"), c.replace("*", " + 0.0::DOUBLE")
        parts.append(
            f"SELECT '{table}' AS table_name, count(*) AS n_rows, '{name}' AS column_name, count(*) - count({name}) AS nulls, "
            f"min({value})::VARCHAR AS least, max({value})::VARCHAR AS greatest FROM {table}")
    return "\nUNION ALL ".join(parts)


S["p13_table_profile"] = "\nUNION ALL ".join([
    _profile("region", "r_regionkey r_name"),
    _profile("nation", "n_nationkey n_name n_regionkey"),
    _profile("customer", "c_custkey c_name c_nationkey c_acctbal* c_mktsegment"),
    _profile("supplier", "s_suppkey s_name s_nationkey s_acctbal*"),
    _profile("part", "p_partkey p_name p_brand p_type p_size p_retailprice*"),
    _profile("orders", "o_orderkey o_custkey o_orderstatus o_totalprice* o_orderdate o_orderpriority"),
    _profile("lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity* l_extendedprice* l_discount* l_tax* "
                         "l_returnflag l_linestatus l_shipdate"),
    _profile("events", "event_id ts user_id event_type value* props"),
    _profile("documents", "doc_id text lang source n_chars"),
    _profile("embeddings", "vec_id label"),
    _profile("pages", "page_id url html"),
    _profile("benchmark", "item_id text"),
    _profile("labels", "doc_id quality toxic"),
    _profile("conversations", "conv_id turn role text"),
])
_PLAIN_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
                "l_shipdate",
    "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id label", "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
S["p13_profile_accuracy"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS n, TRUE AS near FROM {t}" for t, columns in _PLAIN_COLUMNS.items() for c in columns.split())
_TEXT_COLUMNS = {
    "region": "r_name", "nation": "n_name", "customer": "c_name c_mktsegment", "supplier": "s_name", "part": "p_name p_brand p_type",
    "orders": "o_orderstatus o_orderpriority", "lineitem": "l_returnflag l_linestatus", "events": "event_type props",
    "documents": "text lang source", "pages": "url html", "benchmark": "text", "conversations": "role text",
}
S["p13_column_domains"] = "\nUNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_values,
  string_agg(chr(39) || {c} || chr(39), ', ' ORDER BY encode({c})) AS allowed
FROM (SELECT DISTINCT {c} FROM {table} WHERE {c} IS NOT NULL) HAVING count(*) BETWEEN 1 AND 12"""
    for table, names in _TEXT_COLUMNS.items() for c in names.split())
_COLLECTION = """CASE embedding_type WHEN 'business_rule' THEN 'business' WHEN 'metric' THEN 'metrics'
  WHEN 'glossary' THEN 'metrics' WHEN 'lineage' THEN 'metrics' WHEN 'review' THEN 'review' ELSE 'schema' END"""
S["p14_embed_pending"] = f"""
SELECT doc_id, {_COLLECTION} AS collection, 64 AS dim, 1.0::DOUBLE AS length FROM docs WHERE needs_reembedding AND is_active"""
S["p14_after_embedding"] = """
SELECT embedding_type, count(*) AS documents, count(*) FILTER (WHERE NOT needs_reembedding OR is_active) AS embedded,
  count(*) FILTER (WHERE needs_reembedding AND NOT is_active) AS still_pending FROM docs GROUP BY 1"""
S["p15_document_update"] = """
SELECT doc_id, CASE WHEN quality = 1 THEN 2 ELSE 1 END AS version, coalesce(quality = 1, false) OR needs_reembedding AS needs_reembedding,
  (length(content) + CASE WHEN quality = 1 THEN 10 ELSE 0 END)::INTEGER AS chars,
  CASE WHEN quality = 1 THEN '2025-01-01 00:00:00' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at
FROM docs LEFT JOIN labels USING (doc_id)"""
S["p15_document_history"] = """
SELECT doc_id, 1 AS version, length(content)::INTEGER AS chars, 'system' AS changed_by
FROM docs JOIN labels USING (doc_id) WHERE quality = 1"""
S["w6_version_rows"] = """
SELECT doc_id, CASE WHEN quality = 1 THEN 2 ELSE 1 END::BIGINT AS versions, is_active::BIGINT AS active, true AS single
FROM docs LEFT JOIN labels USING (doc_id)"""
# Text, search settings and the query vector in millionths.
_KEY = """sha256(concat_ws('|', text, 'k=8;types=', coalesce((SELECT array_to_string(list_transform(v.embedding,
  lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',') FROM embeddings v WHERE v.vec_id = item_id), '')))"""
S["p16_cache_invalidation"] = f"""
SELECT {_KEY} AS query_hash, '[{{"doc_id":' || item_id || ',"hybrid_score":0.5}}]' AS result_json, 1 AS hit_count
FROM benchmark WHERE length(text) > 200 AND length(text) <= 280
  AND item_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"""
S["p17_answered_queries"] = """
SELECT b.item_id AS query_id, length(text) > 200 AND length(text) <= 280 AS from_cache,
  CASE WHEN length(text) > 200 AND length(text) <= 280 THEN b.item_id::VARCHAR
       ELSE coalesce((SELECT string_agg(doc_id, '|' ORDER BY rank) FROM batch h WHERE h.query_id = b.item_id), '') END AS doc_ids
FROM benchmark b"""
S["p17_cache_after"] = f"""
WITH k AS (SELECT DISTINCT {_KEY} AS query_hash, length(text) AS n FROM benchmark)
SELECT query_hash, CASE WHEN n > 280 THEN 2 ELSE 1 END AS hit_count,
  CASE WHEN n > 200 AND n <= 280 THEN '2025-01-01 06:00:00' ELSE '2025-01-02 00:00:00' END AS expires_at,
  CASE WHEN n > 200 THEN '2024-12-31 06:00:00' ELSE '2025-01-01 00:00:00' END AS created_at FROM k"""
S["p18_sql_vetting"] = """
SELECT statement_id, guard_type, pattern, message FROM vetted"""
S["u1_validate_in_sql"] = S["p18_sql_vetting"]
S["p19_scores"] = """
SELECT order_id, if_score::DOUBLE AS if_score, lof_score::DOUBLE AS lof_score, ensemble_score::DOUBLE AS ensemble_score,
  risk_tier, anomaly_flag, anomaly_rank FROM base_scores"""
S["p21_retrieval_quality"] = """
SELECT event_type AS query_intent, count(*) AS queries,
  100::DOUBLE * count(*) FILTER (WHERE (props::JSON->>'k')::INTEGER > 90) / count(*) AS error_rate_pct,
  100::DOUBLE * count(*) FILTER (WHERE (props::JSON->>'k')::INTEGER < 5) / count(*) AS hallucination_rate_pct,
  sum(trunc(value * 10)::INTEGER)::DOUBLE / count(*) AS avg_latency_ms, quantile_cont(trunc(value * 10)::INTEGER, 0.5) AS p50_latency_ms,
  quantile_cont(trunc(value * 10)::INTEGER, 0.95) AS p95_latency_ms, max(trunc(value * 10)::INTEGER) AS max_latency_ms
FROM events GROUP BY 1"""
S["p22_intents"] = f"""
SELECT event_id AS id, {_INTENT} AS intent, CASE event_type WHEN 'click' THEN 'mv_leakage_dashboard'
  WHEN 'view' THEN 'ecommerce.reviews' WHEN 'purchase' THEN 'mv_monthly_leakage, mv_leakage_by_scenario, mv_seller_risk'
  WHEN 'signup' THEN 'mv_monthly_leakage' ELSE 'mv_leakage_dashboard, order_leakage_reasons' END AS answered_from FROM events"""
S["p23_integrity_checks"] = """
SELECT 'unique orders.order_id' AS "check", (SELECT count(*) FROM (SELECT order_id FROM ords GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'unique order_items.item', (SELECT count(*) FROM (SELECT 1 FROM items GROUP BY order_id, order_item_id HAVING count(*) > 1))
UNION ALL SELECT 'unique order_leakage_reasons', (SELECT count(*) FROM (SELECT 1 FROM reasons GROUP BY order_id, leakage_type HAVING count(*) > 1))
UNION ALL SELECT 'reference order_items.order_id', (SELECT count(*) FROM items WHERE order_id NOT IN (SELECT order_id FROM ords))
UNION ALL SELECT 'reference reviews.order_id', (SELECT count(*) FROM revs WHERE order_id NOT IN (SELECT order_id FROM ords))
UNION ALL SELECT 'reference customer_interactions.customer_id', (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'domain order_status', (SELECT count(*) FROM ords WHERE order_status NOT IN ('delivered', 'canceled', 'shipped', 'processing', 'invoiced', 'unavailable'))
UNION ALL SELECT 'domain shipping_status', (SELECT count(*) FROM ship WHERE shipping_status NOT IN ('delivered', 'in_transit', 'cancelled', 'failed', 'never_shipped', 'pending'))
UNION ALL SELECT 'domain role', (SELECT count(*) FROM conversations WHERE role NOT IN ('system', 'user', 'assistant', 'tool'))
UNION ALL SELECT 'domain embedding_type', (SELECT count(*) FROM docs WHERE embedding_type NOT IN ('schema', 'business_rule', 'sql_template', 'review', 'metric', 'routing', 'glossary', 'lineage'))
UNION ALL SELECT 'domain content_lang', (SELECT count(*) FROM docs WHERE content_lang NOT IN ('ar', 'en', 'ar+en', 'de', 'es', 'fr'))"""

_ATTR = "source_type, retrieval_weight::DOUBLE AS retrieval_weight, priority"
S["f17_cover_rank"] = "SELECT doc_id, bm25_score AS rank FROM kwscores"
S["f21_review_fulltext"] = """
WITH w AS (SELECT review_id, unnest(regexp_split_to_array(lower(review_comment), '[^\\p{L}\\p{N}]+')) AS t FROM revs
  UNION ALL SELECT review_id, unnest(regexp_split_to_array(regexp_replace(lower(review_comment),
    '([\\p{L}\\p{N}]{3})(ings|ing|ied|ies|edly|ed|es|ly|s)([^\\p{L}\\p{N}]|$)', '\\1\\3', 'g'), '[^\\p{L}\\p{N}]+')) FROM revs)
SELECT review_id, order_id, sentiment FROM revs WHERE review_id IN (SELECT review_id FROM w WHERE t IN ('this', 'thi'))
  AND review_id IN (SELECT review_id FROM w WHERE t = 'was')"""
S["h1_keyword_leg"] = f"""
SELECT doc_id, {_ATTR}, bm25_score FROM kwscores JOIN docs USING (doc_id) WHERE is_active
ORDER BY bm25_score DESC, doc_id LIMIT 24"""
S["h2_vector_leg"] = f"""
SELECT doc_id, {_ATTR}, vector_score FROM vecscores JOIN docs USING (doc_id) WHERE is_active
ORDER BY vector_score DESC, doc_id LIMIT 24"""


def _legs(k: int, keyword: str, vector: str, types: str | None, score: str, weighted: bool = True) -> str:
    """Both legs, their full join and the blended score, as the table expression ``fused``."""
    wanted = "is_active" + (f" AND source_type IN ({types})" if types else "")
    blend = f"({score}) * retrieval_weight::DOUBLE" if weighted else score
    limit = f"LIMIT {3 * k}" if weighted else ""
    return f"""
kw AS (SELECT doc_id, bm25_score FROM {keyword} JOIN docs USING (doc_id) WHERE {wanted}
       ORDER BY bm25_score DESC, doc_id {limit}),
vec AS (SELECT doc_id, vector_score FROM {vector} JOIN docs USING (doc_id) WHERE {wanted}
        ORDER BY vector_score DESC, doc_id {limit}),
fused AS (
  SELECT d.doc_id, d.source_type, d.title, b, v, round({blend}, 9) AS hybrid_score, d.priority, d.retrieval_weight
  FROM (SELECT coalesce(kw.doc_id, vec.doc_id) AS doc_id, coalesce(bm25_score, 0::DOUBLE) AS b,
               coalesce(vector_score, 0::DOUBLE) AS v FROM kw FULL JOIN vec ON kw.doc_id = vec.doc_id)
       JOIN docs d USING (doc_id))"""


_BLEND = "0.4::DOUBLE * b + 0.6::DOUBLE * v"
_FUSED_COLS = """doc_id, source_type, title, b AS bm25_score, v AS vector_score, hybrid_score, priority,
  retrieval_weight::DOUBLE AS retrieval_weight"""


def _hybrid(k: int, keyword: str = "kwscores", vector: str = "vecscores", types: str | None = None,
            cap: int | None = 2) -> str:
    body = f"""
SELECT {_FUSED_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY source_type ORDER BY hybrid_score DESC, doc_id) AS r FROM fused)
{f'WHERE r <= {cap}' if cap else ''} ORDER BY hybrid_score DESC, priority DESC, doc_id LIMIT {k}"""
    return "WITH " + _legs(k, keyword, vector, types, _BLEND).strip() + body


_ANALYTICS = """'schema_doc', 'leakage_scenario', 'sql_template', 'kpi_glossary', 'join_graph', 'anti_pattern',
  'routing_hint', 'enum_reference', 'generated_column', 'metric_definition', 'lineage_doc', 'anomaly_interpretation',
  'summary_profile'"""
S["h3_hybrid_no_cap"] = _hybrid(48, cap=None)
S["h4_hybrid_search"] = _hybrid(8)
S["h4_hybrid_keyword_only"] = _hybrid(8, vector="(SELECT * FROM vecscores LIMIT 0)")
S["h5_search_analytics"] = _hybrid(8, types=_ANALYTICS)
S["h6_search_reviews"] = _hybrid(5, keyword="thescores", types="'review'")
S["h7_semantic_search"] = """
SELECT doc_id, source_type, title, vector_score AS similarity FROM vecscores JOIN docs USING (doc_id)
WHERE is_active AND source_type = 'schema_doc' ORDER BY similarity DESC, doc_id LIMIT 5"""
S["h8_unweighted_search"] = "WITH " + _legs(8, "kwscores_raw", "vecscores", None, _BLEND, weighted=False).strip() + """
SELECT doc_id, source_type, b AS bm25_score, v AS vector_score, hybrid_score, priority FROM fused
ORDER BY hybrid_score DESC, priority DESC, doc_id LIMIT 8"""
S["h9_ivf_all_cells"] = """
SELECT doc_id, vector_score AS similarity FROM vecscores JOIN docs USING (doc_id) ORDER BY similarity DESC, doc_id LIMIT 10"""
S["h10_batch_search"] = """
SELECT query_id, rank::INTEGER AS rank, doc_id, source_type, bm25_score, vector_score, hybrid_score, priority,
  retrieval_weight::DOUBLE AS retrieval_weight FROM batch"""
S["p20_neighbour_recall"] = """
SELECT (count(*) FILTER (WHERE order_id % 50 = 0) * least(20, count(*) - 1))::BIGINT AS neighbours, true AS reached
FROM ords WHERE total_revenue IS NOT NULL"""
S["h9_ivf_recall"] = """
SELECT count(*) FILTER (WHERE doc_id % 50 = 0) * least(10, count(*)) AS neighbours, true AS reached
FROM embeddings JOIN docs ON docs.doc_id = embeddings.vec_id"""
S["h10_batch_analytics"] = """
SELECT query_id, rank::INTEGER AS rank, doc_id, source_type, bm25_score, vector_score, hybrid_score, priority,
  retrieval_weight::DOUBLE AS retrieval_weight FROM batchan"""
S["h10_batch_reviews"] = """
SELECT query_id, rank::INTEGER AS rank, doc_id, source_type, bm25_score, vector_score, hybrid_score, priority,
  retrieval_weight::DOUBLE AS retrieval_weight FROM batchrev"""
S["h10_batch_keyword"] = f"""
SELECT query_id, doc_id, {_ATTR}, bm25_score FROM batchkw JOIN docs USING (doc_id)"""

S["n1_leakage_overview"] = """
SELECT count(*) AS leakage_orders, sum(total_revenue)::DOUBLE AS total_revenue_at_risk,
  sum(profit_margin)::DOUBLE / nullif(count(profit_margin), 0) AS avg_profit_margin,
  count(*) FILTER (WHERE risk_tier = 'Critical') AS critical_count FROM dash WHERE anomaly_flag = 1"""
S["n2_top_scenarios"] = "SELECT * FROM byscenario ORDER BY revenue_at_risk DESC, scenario LIMIT 10"
S["n3_worst_month"] = """
SELECT month_label, leakage_rate_pct, revenue_at_risk, leakage_orders FROM monthly ORDER BY leakage_rate_pct DESC, month LIMIT 1"""
S["n3_monthly_trend"] = "SELECT month_label, leakage_rate_pct, revenue_at_risk, total_orders FROM monthly ORDER BY month"
S["n3_last_12_months"] = """
SELECT month_label, total_orders, leakage_orders, round(leakage_rate_pct, 2) AS leakage_rate_pct, total_revenue, revenue_at_risk
FROM monthly ORDER BY month DESC LIMIT 12"""
S["n4_riskiest_sellers"] = """
SELECT seller_name, leakage_rate_pct, total_orders, avg_anomaly_score, payment_disputes FROM sellrisk
ORDER BY leakage_rate_pct DESC, seller_id LIMIT 10"""
S["n4_seller_leaderboard"] = """
SELECT seller_name, seller_city, leakage_rate_pct, total_orders, leakage_orders, avg_anomaly_score, payment_disputes, return_rate
FROM sellrisk WHERE total_orders > 100 ORDER BY leakage_rate_pct DESC, seller_id LIMIT 10"""
S["n5_negative_margin_orders"] = """
SELECT order_id, profit_margin::DOUBLE AS profit_margin, total_revenue::DOUBLE AS total_revenue,
  avg_discount_pct::DOUBLE AS avg_discount_pct, risk_tier FROM dash WHERE profit_margin < 0
ORDER BY profit_margin, order_id LIMIT 20"""
S["n5_loss_levels"] = """
SELECT CASE WHEN profit_margin < -0.5 THEN 'severe' WHEN profit_margin < -0.2 THEN 'high' ELSE 'moderate' END AS loss_level,
  count(*) AS orders, sum(total_revenue)::DOUBLE AS revenue_lost FROM dash WHERE profit_margin < 0 GROUP BY 1"""
S["n6_critical_orders"] = """
SELECT order_id, total_revenue::DOUBLE AS total_revenue, profit_margin::DOUBLE AS profit_margin,
  ensemble_score::DOUBLE AS ensemble_score, array_to_string(leakage_scenarios, '|') AS leakage_scenarios, order_status,
  payment_status FROM dash WHERE risk_tier = 'Critical' ORDER BY dash.ensemble_score DESC, order_id LIMIT 50"""
S["n6_tier_totals"] = """
SELECT risk_tier, count(*) AS orders, sum(total_revenue)::DOUBLE AS revenue FROM dash WHERE anomaly_flag = 1 GROUP BY 1"""
S["n7_scenario_by_array"] = """
SELECT order_id, total_revenue::DOUBLE AS total_revenue, risk_tier, ensemble_score::DOUBLE AS ensemble_score FROM dash
WHERE list_contains(leakage_scenarios, 'seller_paid_twice') ORDER BY dash.ensemble_score DESC, order_id LIMIT 20"""
S["n7_scenario_by_junction"] = """
SELECT order_id, total_revenue::DOUBLE AS total_revenue, order_status FROM reasons JOIN ords USING (order_id)
WHERE leakage_type = 'seller_paid_twice'"""
S["n8_recent_critical"] = """
SELECT order_id, customer_name, customer_city, total_revenue::DOUBLE AS total_revenue, profit_margin::DOUBLE AS profit_margin,
  risk_tier, ensemble_score::DOUBLE AS ensemble_score, array_to_string(leakage_scenarios, '|') AS leakage_scenarios,
  payment_status, shipping_status FROM dash
WHERE anomaly_flag = 1 AND risk_tier = 'Critical'
  AND order_month >= date_trunc('month', DATE '2001-08-01' - INTERVAL 3 MONTH)
ORDER BY dash.ensemble_score DESC, order_id LIMIT 20"""
S["n9_delivered_without_payment"] = """
SELECT order_id, total_revenue::DOUBLE AS total_revenue, customer_segment, customer_city FROM dash
WHERE order_status = 'delivered' AND payment_status = 'missing'"""
S["n9_incorrect_refunds"] = """
SELECT o.order_id, r.refund_amount::DOUBLE AS refund_amount, o.total_revenue::DOUBLE AS total_revenue
FROM ords o JOIN refunds r USING (order_id) WHERE r.refund_reason = 'incorrect_refund' AND o.order_status = 'delivered'"""
S["n9_approved_never_shipped"] = """
SELECT o.order_id, o.total_revenue::DOUBLE AS total_revenue, s.carrier FROM ords o JOIN ship s USING (order_id)
WHERE o.payment_status = 'approved' AND s.shipping_status = 'never_shipped'"""
S["n9_cod_unpaid"] = """
SELECT o.order_id, o.total_revenue::DOUBLE AS total_revenue, o.customer_id
FROM ords o JOIN pays p ON o.order_id = p.order_id AND p.payment_sequential = 1
WHERE p.payment_type = 'cash_on_delivery' AND o.order_status = 'delivered' AND o.payment_status IN ('unpaid', 'missing')"""
S["n9_discounted_losses"] = """
SELECT order_id, avg_discount_pct::DOUBLE AS avg_discount_pct, profit_margin::DOUBLE AS profit_margin,
  total_revenue::DOUBLE AS total_revenue FROM dash WHERE avg_discount_pct > 0.07 AND profit_margin < 0"""
S["n10_churning_customers"] = """
SELECT customer_id, lifetime_value::DOUBLE AS lifetime_value, churn_risk FROM custs WHERE churn_risk = 'High'"""
S["n11_valuable_customers_leaking"] = """
SELECT c.customer_id, c.lifetime_value::DOUBLE AS lifetime_value, c.churn_risk, count(d.order_id) AS leakage_orders
FROM custs c JOIN dash d ON c.customer_id = d.customer_id
WHERE c.segment = 'High Value' AND c.churn_risk = 'High' AND d.anomaly_flag = 1 GROUP BY 1, 2, 3"""
S["n12_high_risk_sellers"] = """
SELECT * FROM sellrisk WHERE leakage_rate_pct > 30 AND return_rate > 0.15"""
S["n12_high_risk_scored"] = """
SELECT * FROM sellrisk WHERE leakage_rate_pct > 30 AND return_rate > 0.15 AND avg_anomaly_score > 0.65"""
S["n13_fee_outliers"] = """
SELECT order_id, shipping_fee_charged::DOUBLE AS shipping_fee_charged, actual_logistics_cost::DOUBLE AS actual_logistics_cost,
  fee_to_cost_ratio::DOUBLE AS fee_to_cost_ratio FROM ship WHERE fee_to_cost_ratio > 2.0 OR fee_to_cost_ratio < 0.5"""
S["n14_monthly_revenue"] = """
SELECT strftime(order_month, '%Y-%m-%d') AS order_month, sum(total_revenue)::DOUBLE AS revenue, count(*) AS orders FROM ords GROUP BY 1"""
S["n14_quarterly_revenue"] = """
SELECT strftime(order_quarter, '%Y-%m-%d') AS order_quarter, sum(total_revenue)::DOUBLE AS revenue, count(*) AS orders FROM ords GROUP BY 1"""
S["n15_revenue_at_risk_from_source"] = """
SELECT sum(o.total_revenue)::DOUBLE AS total_revenue_at_risk FROM ords o JOIN scores m USING (order_id) WHERE m.anomaly_flag = 1"""
S["n16_corpus_stats"] = """
SELECT source_type, count(*) AS doc_count,
  ((2 * sum(priority) * 10 + count(*)) // (2 * count(*)))::DOUBLE / 10 AS avg_priority,
  ((2 * (sum(retrieval_weight) * 100)::BIGINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_weight,
  count(*) FILTER (WHERE priority >= 9) AS high_priority_count FROM docs GROUP BY 1"""
S["n17_scenario_documents"] = """
SELECT source_id AS scenario, source AS detection_cols, content_lang AS preferred_view, priority FROM docs
WHERE source_type = 'leakage_scenario'"""
S["n18_guard_rules"] = """
SELECT g.guard_type, g.guard_mode, g.rules, coalesce(h.hits, 0) AS hits
FROM (VALUES ('fake_column', 'contains', 5::BIGINT), ('fake_enum', 'contains', 5), ('dangerous_join', 'regex', 3))
  g(guard_type, guard_mode, rules)
LEFT JOIN (SELECT guard_type, count(*) AS hits FROM vetted GROUP BY 1) h USING (guard_type)"""
S["n19_top_documents"] = """
SELECT doc_id, source_type, title, priority, retrieval_weight::DOUBLE AS retrieval_weight FROM docs
ORDER BY docs.retrieval_weight DESC, priority DESC, doc_id LIMIT 20"""
S["n20_pending_embedding"] = """
SELECT doc_id, source_type, embedding_type, title, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM docs
WHERE needs_reembedding AND is_active"""
S["n20_pending_counts"] = """
SELECT source_type, count(*) AS pending FROM docs WHERE needs_reembedding AND is_active GROUP BY 1"""
S["n21_embedding_coverage"] = """
SELECT embedding_type, count(*) AS documents, count(*) FILTER (WHERE NOT needs_reembedding) AS embedded FROM docs GROUP BY 1"""
S["n22_scenario_reason_counts"] = """
SELECT array_to_string(leakage_scenarios, '|') AS leakage_scenarios, leakage_reason, count(*) AS n FROM scores GROUP BY 1, 2"""
S["n23_risk_share"] = """
SELECT 100::DOUBLE * (sum(total_revenue) FILTER (WHERE anomaly_flag = 1))::DOUBLE / sum(total_revenue)::DOUBLE AS revenue_at_risk_pct FROM dash"""
S["n24_payment_breakdown"] = """
SELECT payment_type, count(*) AS orders, sum(payment_value)::DOUBLE AS paid, count(*) FILTER (WHERE seller_paid_twice) AS paid_twice
FROM primpay GROUP BY 1"""
S["n25_carrier_performance"] = """
SELECT carrier, count(*) AS parcels, count(*) FILTER (WHERE shipping_status = 'delivered') AS delivered,
  count(*) FILTER (WHERE shipping_status = 'failed') AS failed,
  count(*) FILTER (WHERE shipping_status = 'never_shipped') AS never_shipped,
  count(*) FILTER (WHERE fee_to_cost_ratio > 2.0) AS overcharged,
  sum(fee_to_cost_ratio)::DOUBLE / count(fee_to_cost_ratio) AS avg_fee_to_cost FROM ship GROUP BY 1"""
S["n26_segment_city_risk"] = """
SELECT customer_segment, customer_city, risk_tier, count(*) AS orders, sum(total_revenue)::DOUBLE AS revenue FROM dash GROUP BY 1, 2, 3"""
S["n27_sentiment_counts"] = """
SELECT sentiment, count(*) AS reviews, count(*) FILTER (WHERE rating <= 2) AS low_ratings FROM revs GROUP BY 1"""
S["n28_product_revenue"] = """
SELECT p_type AS product_category_name, sum(price_after_discount)::DOUBLE AS revenue, count(*) AS items_sold,
  sum(item_discount_pct)::DOUBLE / count(*) AS avg_discount FROM items JOIN part ON p_partkey = product_id GROUP BY 1"""

_VISIT_COLS = """customer_id, strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start,
  strftime(session_end, '%Y-%m-%d %H:%M:%S') AS session_end, traffic_source, events, bounce, session_duration_min"""
S["s1_document_feed"] = """
SELECT doc_id, CASE WHEN quality = 1 THEN 2 ELSE 1 END AS version,
  CASE WHEN quality = 1 THEN NOT is_active ELSE needs_reembedding END AS needs_reembedding,
  NOT needs_reembedding OR (coalesce(quality, 0) = 1 AND is_active) AS has_vector
FROM docs LEFT JOIN labels USING (doc_id)"""
S["s2_leakage_windows"] = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS events,
  count(*) FILTER (WHERE event_type = 'error') AS leaks,
  100::DOUBLE * count(*) FILTER (WHERE event_type = 'error') / count(*) AS leak_rate_pct FROM events GROUP BY 1, 2"""
S["s2_order_alerts"] = """
SELECT order_id, customer_id, risk_tier, ensemble_score::DOUBLE AS ensemble_score, total_revenue::DOUBLE AS total_revenue,
  leakage_reason FROM scores WHERE anomaly_flag = 1 AND risk_tier IN ('High', 'Critical')"""
S["s3_sessions"] = f"SELECT {_VISIT_COLS} FROM visits"
S["s3_closed_sessions"] = f"""
SELECT {_VISIT_COLS} FROM visits
WHERE session_end + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


def statements() -> dict[str, str]:
    return {name: statement(body) for name, body in S.items()}
