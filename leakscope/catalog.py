"""Every query of the platform by name, each a function of a session and a source folder.

Names start with the inventory id of the operator they show. All queries read whole tables; a limit
appears only where the operator is a top-k or a sample.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.functions import columns as C
from leakscope.functions import text as X
from leakscope.functions.present import flat
from leakscope.functions.vectors import cosine
from leakscope.operators import guard, ivf, keyed, neighbours, postings, profile, quality, ranking, search, set_join, vector_blocks
from leakscope.operators.anomaly import fit_standard, fitted_scores, neighbour_table, standard_rows
from leakscope.plans import analytics as N
from leakscope.plans import cache as cache_jobs
from leakscope.plans import corpus, embedding, orders, scenarios, sql_functions
from leakscope.plans.platform import VIEWS, Platform, platform
from leakscope.sources import tables
from leakscope.sources.schemas import SCORES_CSV_COLUMNS
from leakscope.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Search requests the registered queries run with.
SEARCH_TEXT = "this was"
REVIEW_TEXT = "the"
AS_OF = dt.date(2001, 8, 1)
STAMP = "timestamp '2025-01-01 00:00:00'"


def query(fn: Callable[[Platform], DataFrame]) -> Callable[[Platform], DataFrame]:
    """Register a function of the platform under its own name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return flat(fn(platform(spark, folder)))

    QUERIES[fn.__name__] = run
    return fn


def _scratch(p: Platform, name: str) -> str:
    """A folder not written before, on the shared storage."""
    return f"{p.root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def _probe_vector(p: Platform) -> list[float]:
    """The query vector of the search queries: the stored vector of document 7."""
    return list(p.star.raw("embeddings").filter("vec_id = 7").select("embedding").first()[0])


def _as_of():
    return F.expr(STAMP)


# ---- sources and sinks -------------------------------------------------------------------------------


@query
def io1_scores_csv(p: Platform) -> DataFrame:
    path = _scratch(p, "scores_csv")
    tables.write_csv(p.published("scores").select(*SCORES_CSV_COLUMNS), path)
    rows = tables.read_scores_csv(p.spark, path)
    return rows.drop("scored_at", "leakage_scenarios")


@query
def io2_scores_scan(p: Platform) -> DataFrame:
    return p.published("scores").select(
        "order_id", "if_score", "lof_score", "ensemble_score", "anomaly_flag", "risk_tier", "leakage_scenarios",
        "leakage_reason", "customer_id", "order_status", "order_purchase_timestamp", "total_revenue",
        "profit_margin", "avg_discount_pct", "shipping_delay_days", "payment_status", "shipping_status", "month")


@query
def io3_documents_jsonl(p: Platform) -> DataFrame:
    path = _scratch(p, "documents_jsonl")
    tables.export_json(p.published("documents").drop("content_tsv"), path)
    return tables.read_documents_jsonl(p.spark, path).select(
        "doc_id", "source_type", "title", F.length("content").alias("chars"), "priority", "retrieval_weight",
        "is_active")


@query
def io4_append_documents(p: Platform) -> DataFrame:
    store = tables.TableStore(p.spark, _scratch(p, "append"))
    store.replace("documents", corpus.new_documents(_review_documents(p), _as_of()))
    out = store.append("documents", corpus.new_documents(_leakage_documents(p), _as_of()))
    return out.groupBy("source_type").agg(
        F.count("*").alias("documents"), F.sum(F.length("content")).alias("chars"), F.sum("priority").alias("priorities"))


@query
def io5_upsert_embeddings(p: Platform) -> DataFrame:
    old = p.published("embeddings")
    urgent = p.published("documents").filter("priority >= 5").select("doc_id")
    new = old.join(urgent, "doc_id", "left_semi").withColumn("embedding", F.reverse("embedding"))
    return keyed.upsert(old, new, ["doc_id"]).select(
        "doc_id", F.size("embedding").alias("dim"), F.get("embedding", F.lit(0)).cast("double").alias("first_value"))


@query
def io6_insert_ignore_reasons(p: Platform) -> DataFrame:
    reasons = p.published("leakage_reasons")
    old = reasons.filter("confidence >= 0.7")
    twice = reasons.unionByName(reasons)
    return keyed.insert_ignore(old, twice, ["order_id", "leakage_type"])


@query
def io7_join_update_scenarios(p: Platform) -> DataFrame:
    """Scenario arrays recomputed from the reason text and set by key."""
    target = p.published("scores").select("order_id", F.lit(None).cast("array<string>").alias("leakage_scenarios"),
                                          "leakage_reason")
    parsed = target.select("order_id", scenarios.reason_scenarios(F.col("leakage_reason")).alias("leakage_scenarios"))
    return keyed.join_update(target, parsed, ["order_id"], ["leakage_scenarios"])


@query
def io9_clear_flags(p: Platform) -> DataFrame:
    docs = p.published("documents").select("doc_id", "needs_reembedding")
    written = p.published("documents").filter("priority >= 5 AND is_active")
    return keyed.set_where_key_in(docs, written, "doc_id", "needs_reembedding", F.lit(False))


@query
def io10_delete_not_in(p: Platform) -> DataFrame:
    """Junction without the rows of customers of the lowest segment, by anti join and by predicate."""
    low = p.published("dashboard").filter("customer_segment = 'Low Value'").select("order_id")
    kept = p.published("leakage_reasons").join(low, "order_id", "left_anti")
    return keyed.delete_where(kept, F.col("confidence") < C.dec("0.65"))


@query
def io11_json_export(p: Platform) -> DataFrame:
    path = _scratch(p, "monthly_json")
    view = p.published("monthly_leakage")
    tables.export_json(view, path)
    return p.spark.read.schema(view.schema).json(path)


@query
def io12_refresh_views(p: Platform) -> DataFrame:
    fresh = p.refresh_views()
    parts = [fresh[v].agg(F.count("*").alias("n")).select(F.lit(v).alias("view_name"), "n") for v in VIEWS]
    return quality.all_checks(parts)


# ---- projections, predicates, functions ----------------------------------------------------------------


@query
def pf3_in_list(p: Platform) -> DataFrame:
    return p.published("shipping").filter(F.col("shipping_status").isin("delivered", "in_transit")).select(
        "order_id", "shipping_status", "carrier")


@query
def pf5_optional_types(p: Platform) -> DataFrame:
    """Documents per type, once with a type list and once with none (which means all)."""
    def count(types: list[str] | None, label: str) -> DataFrame:
        return search._searchable(p.published("documents"), types).groupBy("source_type").agg(
            F.count("*").alias("documents")).withColumn("asked", F.lit(label))

    return count(["review", "schema_doc"], "listed").unionByName(count(None, "all"))


@query
def pf8_pattern_from_column(p: Platform) -> DataFrame:
    """Case-blind LIKE and regex whose pattern is a column: part names by colour and by brand digit."""
    parts = p.star.raw("part").select(
        "p_partkey", "p_name", "p_brand", "p_type",
        F.concat(F.lit("%"), F.substring_index(F.upper("p_name"), " ", 1), F.lit("_%")).alias("pat"),
        F.concat(F.lit("^brand#"), F.substring(F.col("p_size").cast("string"), 1, 1)).alias("rx"))
    return parts.select(
        "p_partkey", F.ilike("p_name", F.col("pat")).alias("name_like"),
        F.regexp_like("p_brand", F.concat(F.lit("(?is)"), F.col("rx"))).alias("brand_matches"))


@query
def pf10_null_predicates(p: Platform) -> DataFrame:
    o = p.published("orders")
    billed = p.star.order_headers().select("order_id", F.col("billed_total").cast("double").alias("billed"))
    return o.join(billed, "order_id").agg(
        F.count_if(F.col("profit_margin").isNull()).alias("no_margin"),
        F.count_if(F.col("profit_margin").isNotNull()).alias("with_margin"),
        F.count_if(~F.col("total_revenue").cast("double").eqNullSafe(F.col("billed"))).alias("distinct_from_billed"))


@query
def pf12_coalesce_nullif(p: Platform) -> DataFrame:
    return p.published("dashboard").select(
        "order_id", F.coalesce("sentiment", F.lit("unknown")).alias("sentiment"),
        F.nullif("payment_status", F.lit("approved")).alias("open_payment"),
        F.coalesce("shipping_delay_days", F.lit(0)).alias("delay"))


@query
def pf14_boolean_flags(p: Platform) -> DataFrame:
    return p.published("dashboard").filter(
        F.col("seller_paid_twice") & ~F.col("invoice_available") & ~F.col("inventory_mismatch")).select(
        "order_id", "customer_id", "total_revenue")


@query
def pf15_calendar_columns(p: Platform) -> DataFrame:
    return p.published("orders").select("order_id", "order_month", "order_quarter", "order_year")


@query
def pf16_ratio_columns(p: Platform) -> DataFrame:
    return p.items().select(
        "order_id", "order_item_id", "product_id", "price", "item_discount_pct", "price_after_discount",
        "freight_value", "logistics_cost")


@query
def f1_concat_nulls(p: Platform) -> DataFrame:
    """Concatenation that skips NULL next to the one that gives NULL."""
    d = p.published("dashboard")
    return d.select(
        "order_id", C.text_or_empty("S: ", F.col("sentiment"), ", M: ", F.col("profit_margin")).alias("skipping"),
        F.concat(F.lit("S: "), F.col("sentiment")).alias("strict"))


@query
def f7_scenario_domain(p: Platform) -> DataFrame:
    return quality.domain_counts(p.published("leakage_reasons"), "leakage_type", "leakage_scenario")


@query
def f9_campaign_interactions(p: Platform) -> DataFrame:
    """Interactions per campaign, the campaign read from the JSON properties."""
    return p.star.interactions().groupBy("campaign_id").agg(
        F.count("*").alias("interactions"), F.sum("value").alias("value"),
        F.count_if(F.col("action_type") == "purchase").alias("purchases"))


@query
def f15_lexemes(p: Platform) -> DataFrame:
    """How often each lexeme occurs and where it first stands, over raw words and stems."""
    words = p.published("documents").select("doc_id", F.posexplode("content_tsv").alias("pos", "word"))
    return words.groupBy("word").agg(F.count("*").alias("n"), F.max("pos").alias("last_pos"))


@query
def f16_text_match(p: Platform) -> DataFrame:
    """All documents; those that match are known from the positions of the terms."""
    found = postings.matches(p.published("postings"), *search.query_terms(SEARCH_TEXT), active=False).select(
        "doc_id", "raw_match", "stem_match")
    return p.published("documents").select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("raw_match", "stem_match")])


@query
def f17_cover_rank(p: Platform) -> DataFrame:
    """Cover density of every matching document, no limit."""
    found = postings.matches(p.published("postings"), *search.query_terms(SEARCH_TEXT), active=False)
    return found.select("doc_id", F.col("bm25_score").alias("rank"))


@query
def f19_shorten(p: Platform) -> DataFrame:
    return p.published("documents").select("doc_id", C.shorten(F.col("content")).alias("cut"))


@query
def f20_trigram_similarity(p: Platform) -> DataFrame:
    return p.star.reviews().select(
        "review_id", F.round(X.trigram_similarity(F.col("review_comment"), F.lit("the order was late")), 6)
        .alias("similarity"))


@query
def f20_similar_reviews(p: Platform) -> DataFrame:
    """Reviews at least so similar to a phrase, the search that a trigram index serves."""
    similarity = F.round(X.trigram_similarity(F.col("review_comment"), F.lit("the order was late")), 6)
    return p.star.reviews().filter(similarity >= 0.1).select("review_id", similarity.alias("similarity"))


@query
def f20_similar_pairs(p: Platform) -> DataFrame:
    """Reviews of an order or document whose id is divisible by 50, against all reviews: the trigram join."""
    reviews = p.star.reviews().select("review_id", "order_id", "review_comment")
    return set_join.similar_texts(reviews.filter("order_id % 50 = 0"), reviews, "review_id", "review_comment", 70)


@query
def f21_review_fulltext(p: Platform) -> DataFrame:
    raw, stem = search.query_terms(SEARCH_TEXT)
    found = p.star.reviews().filter(X.text_matches(F.coalesce("review_comment", F.lit("")), raw, stem))
    return found.select("review_id", "order_id", "sentiment")


# ---- joins ------------------------------------------------------------------------------------------


@query
def j7_latest_review(p: Platform) -> DataFrame:
    newest = orders.latest_review(p.star.reviews())
    return newest.select("order_id", "rating", "sentiment", F.length("review_comment").alias("chars"))


@query
def j9_seller_chain(p: Platform) -> DataFrame:
    """Sellers to items to orders to scores: what each seller sold, per order status and risk tier."""
    items = p.items().groupBy("order_id", "seller_id").agg(F.sum("price_after_discount").alias("sold"))
    return (
        p.published("sellers").select("seller_id", "seller_name")
        .join(items, "seller_id").join(p.published("orders").select("order_id", "order_status"), "order_id")
        .join(p.published("scores").select("order_id", "risk_tier"), "order_id", "left")
        .groupBy("seller_name", "order_status", "risk_tier")
        .agg(F.count("*").alias("orders"), F.sum("sold").alias("sold")))


@query
def j11_scenarios_per_order(p: Platform) -> DataFrame:
    reasons = corpus.scenario_text(p.published("leakage_reasons"), ", ")
    return p.published("orders").select("order_id").join(reasons, "order_id", "left").select(
        "order_id", F.coalesce("scenario_text", F.lit("no_leakage")).alias("scenarios"))


@query
def j12_semi_join(p: Platform) -> DataFrame:
    return p.published("customers").join(
        p.published("dashboard").filter("risk_tier = 'Critical'").select("customer_id"), "customer_id", "left_semi"
    ).select("customer_id", "customer_name", "segment")


@query
def j13_zip_places(p: Platform) -> DataFrame:
    place = N.places_per_zip(p.star.geolocation())
    return p.published("sellers").join(
        place, F.col("seller_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left").select(
        "seller_id", "points", "city", "lat", "lng")


@query
def j14_campaign_attribution(p: Platform) -> DataFrame:
    return N.campaign_results(p.star.attribution(), p.star.campaigns(), p.published("orders"))


@query
def j15_lead_funnel(p: Platform) -> DataFrame:
    return N.lead_funnel(p.star.leads_qualified(), p.star.leads_closed(), p.published("sellers"))


# ---- aggregates and windows -----------------------------------------------------------------------------


@query
def a6_duplicate_keys(p: Platform) -> DataFrame:
    return keyed.duplicate_keys(p.items(), ["order_id", "order_item_id"])


@query
def a7_ordered_text(p: Platform) -> DataFrame:
    """Brands of each product type as one text in name order; a type holds at most all brands."""
    brands = p.star.raw("part").select("p_type", "p_brand").distinct()
    return brands.groupBy("p_type").agg(F.concat_ws(", ", F.array_sort(F.collect_list("p_brand"))).alias("brands"))


@query
def a8_ordered_array(p: Platform) -> DataFrame:
    """Cities of each region as an array ordered by nation key."""
    nation = p.star.raw("nation").join(p.star.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    listed = nation.groupBy("r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("l"))
    return listed.select("r_name", F.transform("l", lambda x: x["n_name"]).alias("cities"))


@query
def a9_keep_first(p: Platform) -> DataFrame:
    items = p.items().select("order_id", "order_item_id", "product_id", "seller_id", "price")
    with_order = items.withColumn("pick", F.struct("price", "product_id", "seller_id"))
    return keyed.keep_first(with_order, ["order_id", "order_item_id"], "pick").drop("pick")


@query
def a14_small_refunds(p: Platform) -> DataFrame:
    return p.refund_summary().filter(F.col("small_refunds") >= p.params.small_refund_count).select(
        "order_id", "small_refunds", "refunded_total")


@query
def a15_duplicate_refunds(p: Platform) -> DataFrame:
    return p.refund_summary().filter("duplicate_refund").select("order_id", "refund_count", "refunded_total")


@query
def a16_customer_rollup(p: Platform) -> DataFrame:
    return p.published("customers")


@query
def a17_sessions_by_source(p: Platform) -> DataFrame:
    return N.sessions_by_source(feeds.visit_sessions(p.star.interactions()))


@query
def a18_session_cost(p: Platform) -> DataFrame:
    return N.session_cost(p.star.query_log())


@query
def a18_chat_quality(p: Platform) -> DataFrame:
    log = p.star.query_log().withColumn("detected_intent", guard.intent(F.col("user_question")))
    return N.chat_quality(log)


@query
def w3_anomaly_rank(p: Platform) -> DataFrame:
    ranked = ranking.percent_rank_by_value(
        p.published("scores").select("order_id", "ensemble_score"), "ensemble_score", "anomaly_rank")
    return ranked.select("order_id", "anomaly_rank")


@query
def w4_last_turns(p: Platform) -> DataFrame:
    chat = p.star.raw("conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    return ranking.last_n(chat, "conv_id", "turn", 3)


@query
def w5_instalments(p: Platform) -> DataFrame:
    numbered = ranking.number_rows(p.star.payments(), ["order_id"], ["pay_order"], "payment_sequential")
    return numbered.select("order_id", "payment_sequential", "payment_type", "payment_value")


@query
def w6_active_versions(p: Platform) -> DataFrame:
    """Sources with more or less than one newest text, the check that one version is active."""
    docs = p.star.raw("documents").select("source", "doc_id", "n_chars")
    longest = docs.groupBy("source").agg(F.max("n_chars").alias("n_chars"))
    return docs.join(longest, ["source", "n_chars"]).groupBy("source").agg(
        F.count("*").alias("active"), (F.count("*") == 1).alias("single"))


@query
def t4_sample(p: Platform) -> DataFrame:
    return p.published("dashboard").filter("anomaly_flag = 1").orderBy("order_id").limit(5).select(
        "order_id", "risk_tier", "leakage_reason")


@query
def so2_dedupe_reasons(p: Platform) -> DataFrame:
    reasons = p.published("leakage_reasons")
    return reasons.unionByName(reasons).dropDuplicates(["order_id", "leakage_type"])


# ---- jobs ---------------------------------------------------------------------------------------------


@query
def p1_normalise_reason(p: Platform) -> DataFrame:
    return p.published("scores").select(
        "order_id", scenarios.normalise_reason(F.col("anomaly_flag"), F.col("raw_reason")).alias("leakage_reason"))


@query
def p2_reason_scenarios(p: Platform) -> DataFrame:
    return p.published("scores").select(
        "order_id", scenarios.reason_scenarios(F.col("leakage_reason")).alias("leakage_scenarios"))


@query
def p3_leakage_reasons(p: Platform) -> DataFrame:
    return p.build("leakage_reasons")


@query
def p4_rule_scenarios(p: Platform) -> DataFrame:
    return scenarios.rule_scenarios(p.rule_inputs(), p.published("scores"), p.params)


@query
def p4_rule_counts(p: Platform) -> DataFrame:
    """Orders and revenue per rule, rules that never fire included."""
    hit = scenarios.rule_scenarios(p.rule_inputs(), p.published("scores"), p.params)
    rows = hit.select("order_id", F.explode("scenarios").alias("scenario"))
    return quality.domain_counts(rows, "scenario", "leakage_scenario")


@query
def p5_order_rollup(p: Platform) -> DataFrame:
    return p.rollup()


@query
def p6_leakage_dashboard(p: Platform) -> DataFrame:
    return p.published("dashboard")


@query
def p7_monthly_leakage(p: Platform) -> DataFrame:
    return p.published("monthly_leakage")


@query
def p8_seller_risk(p: Platform) -> DataFrame:
    return p.published("seller_risk")


@query
def p9_leakage_by_scenario(p: Platform) -> DataFrame:
    return p.published("leakage_by_scenario")


def _review_documents(p: Platform, limit: int | None = None) -> DataFrame:
    return corpus.review_documents(p.star.reviews(), p.published("orders"), p.published("scores"),
                                   p.published("leakage_reasons"), p.published("documents"), limit)


def _leakage_documents(p: Platform) -> DataFrame:
    return corpus.leakage_documents(p.published("scores"), p.published("orders"), p.published("customers"),
                                    p.published("leakage_reasons"))


@query
def p10_review_documents(p: Platform) -> DataFrame:
    return _review_documents(p).drop("metadata")


@query
def t2_top_review_documents(p: Platform) -> DataFrame:
    """The 200 most telling review documents only."""
    return _review_documents(p, 200).drop("metadata")


@query
def p10_review_metadata(p: Platform) -> DataFrame:
    meta = F.from_json("metadata", "order_id bigint, rating string, sentiment string, anomaly_flag int, risk_tier string")
    return _review_documents(p).select(F.inline(F.array(meta)))


@query
def p11_leakage_documents(p: Platform) -> DataFrame:
    return _leakage_documents(p).drop("metadata")


SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations")
# First key columns of each table, for sample rows, and the declared references.
TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}
REFERENCES = {
    "nation": ["n_regionkey → region.r_regionkey"], "customer": ["c_nationkey → nation.n_nationkey"],
    "supplier": ["s_nationkey → nation.n_nationkey"], "orders": ["o_custkey → customer.c_custkey"],
    "lineitem": ["l_orderkey → orders.o_orderkey", "l_partkey → part.p_partkey", "l_suppkey → supplier.s_suppkey"],
    "labels": ["doc_id → documents.doc_id"],
}
COLUMN_NOTES = {
    "orders.o_orderstatus": "F, O or P", "lineitem.l_discount": "share 0.0-1.0",
    "customer.c_acctbal": "account balance",
}


def _catalog(p: Platform) -> DataFrame:
    return corpus.catalog(p.spark, {t: p.star.raw(t).schema for t in SOURCE_TABLES}, COLUMN_NOTES)


@query
def p12_schema_sync(p: Platform) -> DataFrame:
    """Schema documents of the synced tables next to the rest of the corpus, versions counted."""
    documents = p.published("documents")
    fresh = corpus.schema_documents(_catalog(p))
    # the second run finds the documents of the first and updates nothing
    first, _ = corpus.sync_schema_documents(documents, fresh, _as_of())
    again, _ = corpus.sync_schema_documents(first, fresh, _as_of())
    own = again.join(fresh.select("source_id"), "source_id", "left_semi")
    others = again.join(fresh.select("source_id"), "source_id", "left_anti").groupBy("source_type").agg(
        F.count("*").alias("documents"))
    return own.select("source_id", "content", F.col("version").alias("n")).unionByName(
        others.select(F.col("source_type").alias("source_id"), F.lit("").alias("content"),
                      F.col("documents").cast("int").alias("n")))


@query
def p13_table_profile(p: Platform) -> DataFrame:
    return quality.all_checks([quality.column_profile(p.star.raw(t), t) for t in SOURCE_TABLES])


def _profiles(p: Platform) -> DataFrame:
    """Stored sketches per file of all tables, files not profiled before added."""
    kept = p.store.read("profiles") if p.store.exists("profiles") else None
    new = [profile.unseen(p.spark, p.star.raw(t), kept, t) for t in SOURCE_TABLES]
    new = [d for d in new if d is not None]
    if new:
        fresh = profile.union(new)
        return p.store.replace("profiles", fresh if kept is None else kept.unionByName(fresh), ["table_name"])
    return kept


@query
def p13_merged_profile(p: Platform) -> DataFrame:
    """Distinct values, quartiles and frequent values of every column, merged from the sketches of the files."""
    return profile.merged(_profiles(p)).select(
        "table_name", "column_name", "n_rows", "nulls", "n_distinct", "quartiles",
        F.to_json("top").alias("top"))


@query
def p13_profile_accuracy(p: Platform) -> DataFrame:
    """Is the merged estimate of distinct values within 5 % of an exact count?"""
    exact = profile.union([profile.distinct_counts(p.star.raw(t), t) for t in SOURCE_TABLES])
    return profile.merged(_profiles(p)).join(exact, ["table_name", "column_name"]).select(
        "table_name", "column_name", "n_rows", "nulls", "n",
        (F.abs(F.col("n_distinct") - F.col("n")) <= F.ceil(0.05 * F.col("n"))).alias("near"))


def _domains(p: Platform) -> DataFrame:
    return quality.all_checks([quality.column_domains(p.star.raw(t), t) for t in SOURCE_TABLES])


@query
def p13_column_domains(p: Platform) -> DataFrame:
    """Text columns with few values and those values, of all tables, from the data."""
    return _domains(p)


@query
def p13_table_texts(p: Platform) -> DataFrame:
    samples = quality.all_checks([corpus.sample_rows(p.star.raw(t), t, k) for t, k in TABLE_KEYS.items()])
    counts = quality.all_checks([p.star.raw(t).agg(F.count("*").alias("n_rows")).select(
        F.lit(t).alias("table_name"), "n_rows") for t in TABLE_KEYS])
    return corpus.table_texts(_catalog(p), _domains(p), REFERENCES, samples, counts)


EMBED_DIM = 64


@query
def p14_embed_pending(p: Platform) -> DataFrame:
    """New vectors: document, collection, dimension and length (1 for a document with words)."""
    fresh = embedding.embed_pending(p.published("documents"), embedding.hashed_terms(EMBED_DIM), EMBED_DIM)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return fresh.select("doc_id", "collection", F.size("embedding").alias("dim"), F.round(length, 3).alias("length"))


@query
def p14_after_embedding(p: Platform) -> DataFrame:
    """Coverage per type once the pending documents are embedded and their marks cleared."""
    docs = p.published("documents")
    fresh = embedding.embed_pending(docs, embedding.hashed_terms(EMBED_DIM), EMBED_DIM)
    vectors = embedding.store_vectors(p.published("embeddings"), fresh)
    cleared = embedding.clear_pending(docs, fresh)
    left = cleared.groupBy("embedding_type").agg(F.count_if("needs_reembedding").alias("still_pending"))
    return N.embedding_coverage(cleared, vectors).join(left, "embedding_type")


def _changes(p: Platform) -> DataFrame:
    """A batch of edits: good texts get a note, bad ones come back unchanged."""
    edits = p.star.raw("labels").filter("quality IS NOT NULL").select("doc_id", "quality")
    return p.star.raw("documents").join(edits, "doc_id").select(
        "doc_id", F.when(F.col("quality") == 1, F.concat(F.col("text"), F.lit("\nReviewed."))).otherwise(F.col("text"))
        .alias("content"))


@query
def p15_document_update(p: Platform) -> DataFrame:
    current, _ = corpus.apply_changes(p.published("documents"), _changes(p), _as_of())
    return current.select("doc_id", "version", "needs_reembedding", F.length("content").alias("chars"), "updated_at")


@query
def p15_document_history(p: Platform) -> DataFrame:
    _, history = corpus.apply_changes(p.published("documents"), _changes(p), _as_of())
    return history.select("doc_id", "version", F.length("content").alias("chars"), "changed_by")


@query
def w6_version_rows(p: Platform) -> DataFrame:
    """Version rows per document, archived ones included, and whether at most one of them is active."""
    current, history = corpus.apply_changes(p.published("documents"), _changes(p), _as_of())
    return corpus.version_check(current, history)


BATCH_K = 8
BATCH_PARAMS = cache_jobs.search_params(BATCH_K)


def _queries(p: Platform) -> DataFrame:
    """Whole benchmark texts as queries, each with the stored vector of the same number."""
    vectors = p.star.raw("embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return p.star.raw("benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text")).join(vectors, "query_id", "left")


def _stored_cache(p: Platform) -> DataFrame:
    """Earlier results of the longer queries; those over 280 characters are no longer valid."""
    if not p.store.exists("retrieval_cache"):
        texts = _queries(p).filter(F.length("query_text") > 200)
        entry = F.array(F.struct(F.col("query_id").alias("doc_id"), F.lit(0.5).alias("hybrid_score")))
        key = cache_jobs.query_hash(F.col("query_text"), BATCH_PARAMS, F.col("query_vector"))
        age = F.when(F.length("query_text") > 280, F.expr("INTERVAL '-1' HOUR")).otherwise(F.expr("INTERVAL '6' HOUR"))
        p.store.replace("retrieval_cache", texts.select(
            key.alias("cache_key"), key.alias("query_hash"), F.to_json(entry).alias("result_json"),
            F.lit(1).alias("hit_count"), (_as_of() + age).alias("expires_at"),
            (_as_of() - F.expr("INTERVAL '18' HOUR")).alias("created_at")))
    return p.store.read("retrieval_cache")


@query
def p16_cache_invalidation(p: Platform) -> DataFrame:
    _, history = corpus.apply_changes(p.published("documents"), _changes(p), _as_of())
    return cache_jobs.invalidate(_stored_cache(p), history, _as_of()).select("query_hash", "result_json", "hit_count")


def _answer(p: Platform) -> tuple[DataFrame, DataFrame]:
    def run(missing: DataFrame) -> DataFrame:
        return search.batch_search(p.published("documents"), p.published("embeddings"), missing, k=BATCH_K,
                                   postings=p.published("postings"))

    return cache_jobs.answer(_queries(p), _stored_cache(p), run, _as_of(), BATCH_PARAMS)


@query
def p17_answered_queries(p: Platform) -> DataFrame:
    rows = _answer(p)[0]
    ids = F.from_json("result_json", "array<struct<doc_id:bigint>>")
    return rows.select("query_id", "from_cache", F.transform(ids, lambda r: r["doc_id"]).alias("doc_ids"))


@query
def p17_cache_after(p: Platform) -> DataFrame:
    return _answer(p)[1].select("query_hash", "hit_count", "expires_at", "created_at")


@query
def p18_sql_vetting(p: Platform) -> DataFrame:
    return guard.validate_sql(p.star.statements()).select("statement_id", "guard_type", "pattern", "message")


@query
def u1_validate_in_sql(p: Platform) -> DataFrame:
    """The vetting called from SQL text over all statements."""
    sql_functions.register(p.spark)
    p.star.statements().createOrReplaceTempView("asked_statements")
    return p.spark.sql("SELECT statement_id, inline(found) FROM "
                       "(SELECT statement_id, sql_findings(sql_text) AS found FROM asked_statements)")


@query
def p19_scores(p: Platform) -> DataFrame:
    """Scores, tier and relative rank, built from the rule inputs."""
    return p.build("scores").select("order_id", "if_score", "lof_score", "ensemble_score", "risk_tier", "anomaly_flag",
                                    "anomaly_rank")


SCORED = ["profit_margin", "avg_discount_pct", "shipping_delay_days", "log_revenue", "logistics_share"]
NEIGHBOURS = 20


def _order_features(p: Platform) -> DataFrame:
    return p.published("orders").filter(F.col("total_revenue").isNotNull()).select(
        "order_id", "profit_margin", "avg_discount_pct", "shipping_delay_days",
        F.log1p(F.col("total_revenue").cast("double")).alias("log_revenue"),
        C.ratio(F.col("total_logistics"), F.col("total_revenue"), "decimal(12,4)").alias("logistics_share"))


@query
def p20_fitted_scores(p: Platform) -> DataFrame:
    return fitted_scores(_order_features(p), "order_id", SCORED, neighbours=NEIGHBOURS)


@query
def p20_neighbour_recall(p: Platform) -> DataFrame:
    """Every order whose id is divisible by 50, its neighbours among all orders: are nine in ten in the table?"""
    numeric = _order_features(p).select("order_id", *[F.col(c).cast("double").alias(c) for c in SCORED])
    standard = fit_standard(numeric, SCORED)
    rows = standard_rows(numeric, "order_id", standard)
    asked = rows.filter("order_id % 50 = 0")
    got = neighbours.recall(neighbour_table(numeric, "order_id", standard, NEIGHBOURS),
                            neighbours.exact_nearest(rows, asked, "order_id", "v", NEIGHBOURS), "order_id")
    return got.select("neighbours", (F.col("found") >= 0.9 * F.col("neighbours")).alias("reached"))


@query
def p21_retrieval_quality(p: Platform) -> DataFrame:
    return N.retrieval_quality(p.star.retrieval_log())


@query
def p22_intents(p: Platform) -> DataFrame:
    log = p.star.query_log().withColumn("intent", guard.intent(F.col("user_question")))
    return log.select("id", "intent", F.array_join(guard.intent_sources(F.col("intent")), ", ").alias("answered_from"))


@query
def p23_integrity_checks(p: Platform) -> DataFrame:
    o, items = p.published("orders"), p.items()
    return quality.all_checks([
        quality.duplicate_count(o, ["order_id"], "orders.order_id"),
        quality.duplicate_count(items, ["order_id", "order_item_id"], "order_items.item"),
        quality.duplicate_count(p.published("leakage_reasons"), ["order_id", "leakage_type"], "order_leakage_reasons"),
        quality.orphan_count(items, "order_id", o, "order_id", "order_items.order_id"),
        quality.orphan_count(p.star.reviews(), "order_id", o, "order_id", "reviews.order_id"),
        quality.orphan_count(p.star.interactions(), "customer_id", p.published("customers"), "customer_id",
                             "customer_interactions.customer_id"),
        quality.domain_violations(o, "order_status", "order_status"),
        quality.domain_violations(p.published("shipping"), "shipping_status", "shipping_status"),
        quality.domain_violations(p.star.raw("conversations"), "role", "chat_role"),
        quality.domain_violations(p.published("documents"), "embedding_type", "embedding_type"),
        quality.domain_violations(p.published("documents"), "content_lang", "content_lang"),
    ])


# ---- search -------------------------------------------------------------------------------------------


def _hits(df: DataFrame) -> DataFrame:
    return df.drop("content", "metadata")


@query
def h1_keyword_leg(p: Platform) -> DataFrame:
    return search.keyword_hits(p.published("documents"), SEARCH_TEXT, 24, postings=p.published("postings"))


@query
def h2_vector_leg(p: Platform) -> DataFrame:
    return search.vector_hits(p.published("documents"), p.published("embeddings"), _probe_vector(p), 24)


@query
def h3_hybrid_no_cap(p: Platform) -> DataFrame:
    return _hits(search.hybrid_search(p.published("documents"), p.published("embeddings"), SEARCH_TEXT,
                                      _probe_vector(p), k=48, per_type_cap=None, postings=p.published("postings")))


@query
def h4_hybrid_search(p: Platform) -> DataFrame:
    return _hits(search.hybrid_search(p.published("documents"), p.published("embeddings"), SEARCH_TEXT, _probe_vector(p),
                                      postings=p.published("postings")))


@query
def h4_hybrid_keyword_only(p: Platform) -> DataFrame:
    return _hits(search.hybrid_search(p.published("documents"), p.published("embeddings"), SEARCH_TEXT,
                                      postings=p.published("postings")))


@query
def h5_search_analytics(p: Platform) -> DataFrame:
    return _hits(search.search_analytics(p.published("documents"), p.published("embeddings"), SEARCH_TEXT, _probe_vector(p),
                                         postings=p.published("postings")))


@query
def h6_search_reviews(p: Platform) -> DataFrame:
    return _hits(search.search_reviews(p.published("documents"), p.published("embeddings"), REVIEW_TEXT, _probe_vector(p),
                                       postings=p.published("postings")))


@query
def h7_semantic_search(p: Platform) -> DataFrame:
    return search.semantic_search(p.published("documents"), p.published("embeddings"), _probe_vector(p), 5,
                                  ["schema_doc"]).drop("content")


@query
def h8_unweighted_search(p: Platform) -> DataFrame:
    return search.unweighted_search(p.published("documents"), p.published("embeddings"), SEARCH_TEXT, _probe_vector(p),
                                    postings=p.published("postings"))


def _asked(celled: DataFrame, remainder: int) -> DataFrame:
    """One in fifty vectors as queries."""
    return celled.filter(F.col("doc_id") % 50 == remainder).select(
        F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def _celled(p: Platform):
    """Stored cells, their centres, and the probes that find 95 % of ten neighbours of some of the vectors."""
    key = "ivf"
    if not hasattr(p, "_ivf"):
        celled, centres = ivf.build_cells(p.published("embeddings"))
        celled = p.store.replace(key, celled, ["cell"])
        p._ivf = (celled, centres, ivf.probes_for(celled, centres, _asked(celled, 25), 10))
    return p._ivf


@query
def h9_ivf_search(p: Platform) -> DataFrame:
    celled, centres, probes = _celled(p)
    return ivf.probe_search(celled, centres, _probe_vector(p), 10, probes)


@query
def h9_ivf_all_cells(p: Platform) -> DataFrame:
    """All cells probed: must equal the exact search."""
    celled, centres, _ = _celled(p)
    return ivf.probe_search(celled, centres, _probe_vector(p), 10, probes=len(centres))


@query
def h9_ivf_recall(p: Platform) -> DataFrame:
    """Every vector whose id is divisible by 50, its ten nearest among all: are nine in ten found?

    The probes were chosen by other vectors.
    """
    celled, centres, probes = _celled(p)
    asked = _asked(celled, 0)
    got = ivf.recall(ivf.probe_batch(celled, centres, asked, 10, probes), vector_blocks.exact_matches(celled, asked, 10))
    return got.select("neighbours", (F.col("found") >= 0.9 * F.col("neighbours")).alias("reached"))


@query
def h10_batch_search(p: Platform) -> DataFrame:
    return search.batch_search(p.published("documents"), p.published("embeddings"), _queries(p),
                               postings=p.published("postings"))


@query
def h10_batch_analytics(p: Platform) -> DataFrame:
    return search.batch_search_analytics(p.published("documents"), p.published("embeddings"), _queries(p),
                               postings=p.published("postings"))


@query
def h10_batch_reviews(p: Platform) -> DataFrame:
    return search.batch_search_reviews(p.published("documents"), p.published("embeddings"), _queries(p),
                               postings=p.published("postings"))


@query
def h10_batch_keyword(p: Platform) -> DataFrame:
    return search.batch_keyword_hits(p.published("documents"), _queries(p), 24, postings=p.published("postings"))


@query
def f14_cosine_to_label_mean(p: Platform) -> DataFrame:
    """Cosine of each vector with the mean vector of its label."""
    vectors = p.star.raw("embeddings").select("vec_id", "label", F.transform(
        "embedding", lambda x: x.cast("double")).alias("v"))
    parts = vectors.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    means = parts.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))
    return vectors.join(means, "label").select(
        "vec_id", "label", F.round(cosine(F.col("v"), F.col("mean")), 6).alias("similarity"))


# ---- named queries ---------------------------------------------------------------------------------------


@query
def n1_leakage_overview(p: Platform) -> DataFrame:
    return N.leakage_overview(p.published("dashboard"))


@query
def n2_top_scenarios(p: Platform) -> DataFrame:
    return N.top_scenarios(p.published("leakage_by_scenario"))


@query
def n3_worst_month(p: Platform) -> DataFrame:
    return N.worst_month(p.published("monthly_leakage"))


@query
def n3_monthly_trend(p: Platform) -> DataFrame:
    return N.monthly_trend(p.published("monthly_leakage"))


@query
def n3_last_12_months(p: Platform) -> DataFrame:
    return N.last_months(p.published("monthly_leakage"))


@query
def n4_riskiest_sellers(p: Platform) -> DataFrame:
    return N.riskiest_sellers(p.published("seller_risk"))


@query
def n4_seller_leaderboard(p: Platform) -> DataFrame:
    return N.seller_leaderboard(p.published("seller_risk"))


@query
def n5_negative_margin_orders(p: Platform) -> DataFrame:
    return N.negative_margin_orders(p.published("dashboard"))


@query
def n5_loss_levels(p: Platform) -> DataFrame:
    return N.loss_levels(p.published("dashboard"))


@query
def n6_critical_orders(p: Platform) -> DataFrame:
    return N.critical_orders(p.published("dashboard"))


@query
def n6_tier_totals(p: Platform) -> DataFrame:
    return N.tier_totals(p.published("dashboard"))


@query
def n7_scenario_by_array(p: Platform) -> DataFrame:
    return N.scenario_orders_by_array(p.published("dashboard"), "seller_paid_twice")


@query
def n7_scenario_by_junction(p: Platform) -> DataFrame:
    return N.scenario_orders_by_junction(p.published("leakage_reasons"), p.published("orders"), "seller_paid_twice")


@query
def n8_recent_critical(p: Platform) -> DataFrame:
    return N.recent_critical(p.published("dashboard"), AS_OF)


@query
def n9_delivered_without_payment(p: Platform) -> DataFrame:
    return N.delivered_without_payment(p.published("dashboard"))


@query
def n9_incorrect_refunds(p: Platform) -> DataFrame:
    return N.incorrect_refunds(p.published("orders"), p.star.refunds())


@query
def n9_approved_never_shipped(p: Platform) -> DataFrame:
    return N.approved_never_shipped(p.published("orders"), p.published("shipping"))


@query
def n9_cod_unpaid(p: Platform) -> DataFrame:
    return N.cod_unpaid(p.published("orders"), p.published("payment_summary"))


@query
def n9_discounted_losses(p: Platform) -> DataFrame:
    return N.discounted_losses(p.published("dashboard"), p.params)


@query
def n10_churning_customers(p: Platform) -> DataFrame:
    return N.churning_customers(p.published("customers"))


@query
def n11_valuable_customers_leaking(p: Platform) -> DataFrame:
    return N.valuable_customers_leaking(p.published("customers"), p.published("dashboard"))


@query
def n12_high_risk_sellers(p: Platform) -> DataFrame:
    return N.high_risk_sellers(p.published("seller_risk"))


@query
def n12_high_risk_scored(p: Platform) -> DataFrame:
    """With the third condition, a mean anomaly score above 0.65."""
    return N.high_risk_sellers(p.published("seller_risk"), scored=True)


@query
def n13_fee_outliers(p: Platform) -> DataFrame:
    return N.fee_outliers(p.published("shipping"), p.params)


@query
def n14_monthly_revenue(p: Platform) -> DataFrame:
    return N.revenue_by(p.published("orders"), "order_month")


@query
def n14_quarterly_revenue(p: Platform) -> DataFrame:
    return N.revenue_by(p.published("orders"), "order_quarter")


@query
def n15_revenue_at_risk_from_source(p: Platform) -> DataFrame:
    return N.revenue_at_risk_from_source(p.published("orders"), p.published("scores"))


@query
def n16_corpus_stats(p: Platform) -> DataFrame:
    return N.corpus_stats(p.published("documents"))


@query
def n17_scenario_documents(p: Platform) -> DataFrame:
    return N.scenario_documents(p.published("documents"))


@query
def n18_guard_rules(p: Platform) -> DataFrame:
    return guard.rule_usage(p.star.statements())


@query
def n19_top_documents(p: Platform) -> DataFrame:
    return N.top_documents(p.published("documents"))


@query
def n20_pending_embedding(p: Platform) -> DataFrame:
    return N.pending_embedding(p.published("documents")).drop("priority")


@query
def n20_pending_counts(p: Platform) -> DataFrame:
    return N.pending_counts(p.published("documents"))


@query
def n21_embedding_coverage(p: Platform) -> DataFrame:
    return N.embedding_coverage(p.published("documents"), p.published("embeddings"))


@query
def n22_scenario_reason_counts(p: Platform) -> DataFrame:
    return N.scenario_reason_counts(p.published("scores"))


@query
def n23_risk_share(p: Platform) -> DataFrame:
    return N.risk_share(p.published("dashboard"))


@query
def n24_payment_breakdown(p: Platform) -> DataFrame:
    return N.payment_breakdown(p.published("payment_summary"))


@query
def n25_carrier_performance(p: Platform) -> DataFrame:
    return N.carrier_performance(p.published("shipping"), p.params)


@query
def n26_segment_city_risk(p: Platform) -> DataFrame:
    return N.segment_city_risk(p.published("dashboard"))


@query
def n27_sentiment_counts(p: Platform) -> DataFrame:
    return N.sentiment_counts(p.star.reviews())


@query
def n28_product_revenue(p: Platform) -> DataFrame:
    return N.product_revenue(p.items(), p.star.products())


# ---- streams ----------------------------------------------------------------------------------------------


def _event_stream(p: Platform) -> DataFrame:
    return feeds.file_stream(p.spark, f"{p.star.folder}/events.parquet", p.star.raw("events").schema)


@query
def s1_document_feed(p: Platform) -> DataFrame:
    """Corpus after the change feed ran: versions, marks and vectors per document."""
    root = _scratch(p, "feed")
    store = tables.TableStore(p.spark, f"{root}/store")
    store.replace("documents", p.published("documents"))
    store.replace("embeddings", p.published("embeddings"))
    store.replace("retrieval_cache", _stored_cache(p))
    incoming = f"{root}/incoming"
    _changes(p).withColumn("changed_at", _as_of().cast("timestamp_ntz")).write.parquet(incoming)
    schema = "doc_id bigint, content string, changed_at timestamp_ntz"
    changes = feeds.file_stream(p.spark, incoming, schema)
    feed = feeds.DocumentFeed(store, embedding.hashed_terms(EMBED_DIM), EMBED_DIM)
    feed.start(changes, f"{root}/checkpoint").awaitTermination()
    vectors = feed.embeddings().select("doc_id", F.lit(True).alias("has_vector"))
    return feed.documents().join(vectors, "doc_id", "left").select(
        "doc_id", "version", "needs_reembedding", F.coalesce("has_vector", F.lit(False)).alias("has_vector"))


@query
def s2_leakage_windows(p: Platform) -> DataFrame:
    root = _scratch(p, "windows")
    stream = feeds.leakage_windows(_event_stream(p), F.col("event_type") == "error")
    out = feeds.run_to_table(stream, f"{root}/out", f"{root}/checkpoint", mode="update")
    return feeds.newest_per_key(out, ["window_start", "window_end"])


@query
def s2_order_alerts(p: Platform) -> DataFrame:
    root = _scratch(p, "alerts")
    p.published("scores").write.parquet(f"{root}/incoming")
    stream = feeds.file_stream(p.spark, f"{root}/incoming", p.published("scores").schema)
    return feeds.alerts_to_table(feeds.order_alerts(stream), f"{root}/out", f"{root}/checkpoint")


@query
def s3_sessions(p: Platform) -> DataFrame:
    return feeds.visit_sessions(p.star.interactions())


@query
def s3_closed_sessions(p: Platform) -> DataFrame:
    """Sessions the stream has closed: those that ended before the watermark."""
    root = _scratch(p, "sessions")
    events = _event_stream(p).select(
        F.col("event_id").alias("interaction_id"), F.col("user_id").alias("customer_id"),
        F.col("ts").alias("interaction_date"), F.col("event_type").alias("action_type"))
    return feeds.run_to_table(feeds.stream_sessions(events), f"{root}/out", f"{root}/checkpoint")
