"""Platform tables derived from a TPC-H-like star schema.

Every table is a plain projection or aggregation of the given Parquet files, so all jobs downstream
read data that grows with the input. Nothing is read until a job asks for it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.config import DEFAULT_PARAMS
from leakscope.functions import columns as C
from leakscope.functions import text as X
from leakscope.sources.schemas import ENUMS

# Cut-offs that fit the value ranges of the star data; the business defaults never fire on it.
STAR_PARAMS = replace(
    DEFAULT_PARAMS, high_discount="0.07", late_days=1383, small_refund="20000",
    segment_mid="1000000", segment_high="2000000", not_received_pattern=r"(?i)\bwas\b.*\bnot\b",
)

# Lines that a task should hold where those of an order are placed together.
TASK_LINES = 1_500_000

# Carrier names.
CARRIERS = {"1-URGENT": "Aramex EG", "2-HIGH": "Bosta", "3-MEDIUM": "Mylerz", "4-NOT SPECIFIED": "Egypt Post",
            "5-LOW": "Voo"}


def _case(col: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    items = list(mapping.items())
    out = F.when(col == items[0][0], items[0][1])
    for value, label in items[1:]:
        out = out.when(col == value, label)
    return out.otherwise(default)


class Star:
    """The platform's base tables over one folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def by_order(self, rows: DataFrame, key: str = "order_id") -> DataFrame:
        """Rows made of single lines, those of an order in one task; more tasks than usual if they would hold too many."""
        tasks = -(-self.raw("lineitem").count() // TASK_LINES)
        more = tasks > int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(*([tasks] if more else []), key)

    # ---- commerce ---------------------------------------------------------------------------

    def order_items(self) -> DataFrame:
        line = self.raw("lineitem").drop("l_linestatus", "l_shipdate")
        part = self.raw("part").select(F.col("p_partkey").alias("product_id"), "p_retailprice")
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount = F.col("l_discount").cast("decimal(5,3)")
        items = line.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            price.alias("price"),
            F.round(price * F.col("l_tax").cast("decimal(5,3)"), 2).cast("decimal(10,2)").alias("freight_value"),
            discount.alias("item_discount_pct"),
            C.price_after_discount(price, discount).alias("price_after_discount"),
            F.col("l_quantity").cast("decimal(6,2)").alias("quantity"),
            F.col("l_returnflag").alias("return_flag"),
        )
        cost = F.round(F.col("quantity") * F.col("p_retailprice").cast("decimal(10,2)"), 2).cast("decimal(12,2)")
        return items.join(part, "product_id").withColumn("logistics_cost", cost).drop("quantity", "p_retailprice")

    def payments(self, by_order: bool = False) -> DataFrame:
        """One instalment per order line; ``pay_order`` fixes their sequence within the order.

        ``by_order`` places those of an order together, as lines, which are narrower: what sorts the instalments of whole
        orders then does so in tasks of about ``TASK_LINES`` lines, however large the files are that a task reads.
        """
        line = self.raw("lineitem")
        if by_order:
            line = self.by_order(line, "l_orderkey")
        tax = F.col("l_tax").cast("decimal(5,3)")
        net = C.price_after_discount(F.col("l_extendedprice").cast("decimal(12,2)"),
                                     F.col("l_discount").cast("decimal(5,3)"))
        kind = (
            F.when(tax < C.dec("0.02"), "credit_card").when(tax < C.dec("0.04"), "debit_card")
            .when(tax < C.dec("0.06"), "voucher").when(tax < C.dec("0.08"), "cash_on_delivery")
            .otherwise("unknown")
        )
        return line.select(
            F.col("l_orderkey").alias("order_id"),
            F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").alias("pay_order"),
            kind.alias("payment_type"),
            F.round(net * (F.lit(1) + tax).cast("decimal(4,3)"), 2).cast("decimal(12,2)").alias("payment_value"),
            ((F.col("l_discount") >= 0.095) & (F.col("l_linestatus") == "F")).alias("seller_paid_twice"),
        )

    def refunds(self) -> DataFrame:
        quantity = F.col("l_quantity")
        reason = (
            F.when(quantity < 8, "incorrect_refund").when(quantity < 16, "return_request")
            .when(quantity < 24, "early_refund").when(quantity < 32, "late_delivery_compensation")
            .when(quantity < 40, "item_not_as_described").otherwise("customer_request")
        )
        return self.raw("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("order_id"),
            C.price_after_discount(F.col("l_extendedprice").cast("decimal(12,2)"),
                                   F.col("l_discount").cast("decimal(5,3)")).alias("refund_amount"),
            F.col("l_shipdate").alias("refund_date"),
            reason.alias("refund_reason"),
            (F.col("l_linestatus") == "F").alias("processed_before_cancel"),
        )

    def order_headers(self) -> DataFrame:
        """Orders as placed, before any item, payment or parcel is rolled up."""
        status = (
            F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
            .when(F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED"), "canceled").otherwise("processing")
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.col("o_orderdate").alias("order_estimated_delivery_date"),
            (F.col("o_orderpriority") != "1-URGENT").alias("invoice_available"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("billed_total"),
            _case(F.col("o_orderpriority"), CARRIERS).alias("carrier"),
        )

    def parcels(self) -> DataFrame:
        """Dates and open lines of each order's parcels."""
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.min("l_shipdate").alias("shipped_date"),
            F.max("l_shipdate").alias("delivered_date"),
            F.count("*").alias("lines"),
            F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        )

    def sellers(self, items: DataFrame, payments: DataFrame) -> DataFrame:
        """Suppliers with their return rate and the disputes on lines paid twice."""
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("seller_city"))
        base = self.raw("supplier").select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_name"),
            F.least(F.lit(5), F.greatest(F.lit(1), F.floor(F.col("s_acctbal") / 2000)))
            .cast("decimal(3,1)").alias("seller_rating"),
            (F.col("s_acctbal") > 0).alias("is_verified"),
        )
        returned = items.groupBy("seller_id").agg(
            F.round(F.try_divide(F.count_if(F.col("return_flag") == "R"), F.count("*")), 3)
            .cast("decimal(5,3)").alias("return_rate"),
        )
        twice = payments.groupBy(F.col("pay_order.l_suppkey").alias("seller_id")).agg(
            F.count_if("seller_paid_twice").cast("int").alias("payment_disputes"))
        return (
            base.join(nation, base["seller_zip_code_prefix"] == nation["n_nationkey"], "left").drop("n_nationkey")
            .join(returned, "seller_id", "left").join(twice, "seller_id", "left")
        )

    def customer_profiles(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("customer_city"))
        risk = {"HOUSEHOLD": "High", "MACHINERY": "High", "FURNITURE": "Medium"}
        return self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            "customer_city",
            _case(F.col("c_mktsegment"), risk, "Low").alias("churn_risk"),
            (F.col("c_acctbal") > 0).alias("is_verified"),
        )

    def geolocation(self) -> DataFrame:
        """Many coordinate rows per zip: one for each customer living there."""
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("geolocation_city"))
        return self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
            (F.col("c_acctbal").cast("decimal(12,2)") / 200).cast("decimal(9,6)").alias("geolocation_lat"),
            (F.col("c_acctbal").cast("decimal(12,2)") / 100).cast("decimal(9,6)").alias("geolocation_lng"),
            "geolocation_city",
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_length"),
            F.col("p_size").alias("product_weight_g"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price_egp"),
        )

    def reviews(self) -> DataFrame:
        """Long reviews from the documents, short ones (several per order) from user turns."""
        labels = self.raw("labels").select("doc_id", "quality")
        long_form = self.raw("documents").join(labels, "doc_id", "left").select(
            F.concat(F.lit("D"), F.col("doc_id")).alias("review_id"),
            F.col("doc_id").alias("order_id"),
            F.col("text").alias("review_comment"),
            F.when(F.col("quality") == 0, "negative").when(F.col("quality") == 1, "positive")
            .otherwise("unknown").alias("sentiment"),
        )
        turns = self.raw("conversations").filter(F.col("role") == "user").select(
            F.concat(F.lit("C"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("review_id"),
            F.col("conv_id").alias("order_id"),
            F.col("text").alias("review_comment"),
            F.lit("neutral").alias("sentiment"),
        )
        rating = _case(F.col("sentiment"), {"positive": "5", "neutral": "3", "negative": "1"})
        minutes = F.make_dt_interval(mins=F.length("review_comment"))
        return long_form.unionByName(turns).select(
            "review_id", "order_id", "review_comment", "sentiment",
            rating.cast("decimal(3,1)").alias("rating"),
            (F.expr("timestamp_ntz '2001-01-01 00:00:00'") + minutes).alias("review_date"),
            (~F.col("review_comment").rlike(r"\p{L}")).alias("is_emoji_only"),
            F.col("sentiment").alias("rating_group"),
            (F.length(F.trim("review_comment")) > 0).alias("has_comment"),
        )

    # ---- marketing and chat -------------------------------------------------------------------

    def interactions(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("interaction_id"),
            F.col("user_id").alias("customer_id"),
            F.concat(F.lit("Brand#"), F.get_json_object("props", "$.k")).alias("campaign_id"),
            F.col("ts").alias("interaction_date"),
            F.col("event_type").alias("action_type"),
            F.col("value").cast("decimal(12,2)").alias("value"),
        )

    def campaigns(self) -> DataFrame:
        return self.raw("part").groupBy(F.col("p_brand").alias("campaign_id")).agg(
            F.sum(F.col("p_retailprice").cast("decimal(12,2)")).cast("decimal(14,2)").alias("budget"),
            F.min("p_type").alias("channel"),
        )

    def attribution(self) -> DataFrame:
        """Unique (order, campaign) pairs: the brands an order bought."""
        brand = self.raw("part").select(F.col("p_partkey"), F.col("p_brand").alias("campaign_id"))
        return self.raw("lineitem").join(brand, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("order_id"), "campaign_id").distinct()

    def leads_qualified(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("mql_id"), F.col("c_mktsegment").alias("origin"))

    def leads_closed(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("mql_id"), F.col("s_suppkey").alias("seller_id"),
            F.col("s_acctbal").cast("decimal(14,2)").alias("declared_monthly_revenue"))

    def query_log(self) -> DataFrame:
        """Chat questions, one per event, with the tokens they used and how they ended."""
        k = F.get_json_object("props", "$.k").cast("int")
        question = (
            F.when(F.col("event_type") == "click", F.concat(F.lit("Show me order "), F.col("event_id")))
            .when(F.col("event_type") == "view", F.concat(F.lit("Customer feedback on order "), F.col("event_id")))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("Total and AVERAGE value of customer "), F.col("user_id")))
            .when(F.col("event_type") == "signup", F.concat(F.lit("Monthly trend for customer "), F.col("user_id")))
            .otherwise(F.concat(F.lit("Any critical anomaly for customer "), F.col("user_id"), F.lit("?")))
        )
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("session_id"),
            question.alias("user_question"),
            (F.col("value") * 10).cast("int").alias("execution_ms"),
            F.col("event_type").isin("purchase", "signup").alias("was_helpful"),
            F.when(F.col("event_type") == "error", "statement failed").alias("error_message"),
            (k * 20).alias("input_tokens"),
            (k * 3).alias("output_tokens"),
            F.col("ts").alias("created_at"),
        )

    def retrieval_log(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            F.col("event_id").alias("log_id"),
            F.col("event_type").alias("query_intent"),
            F.when(k > 90, "no such column").alias("execution_error"),
            (k < 5).alias("hallucination_flag"),
            (F.col("value") * 10).cast("int").alias("latency_ms"),
        )

    def statements(self) -> DataFrame:
        """Generated SQL, one statement per order; some of it breaks the vetting rules."""
        key = F.col("o_orderkey").cast("string")
        sql = (
            F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(
                F.lit("SELECT SUM(orders.amount) FROM ecommerce.payments WHERE order_id = '"), key, F.lit("'")))
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat(
                F.lit("select oi.price from ecommerce.order_items oi\njoin ecommerce.orders o using (order_id)\nwhere price > 10 and order_id = "),
                key))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(
                F.lit("SELECT payment_type FROM ecommerce.payments WHERE payment_sequential = 1 AND order_id = "), key))
            .when(F.col("o_orderstatus") == "F", F.concat(
                F.lit("SELECT * FROM orders WHERE order_status = 'Complete' AND risk_tier = 'severe' AND order_id = "), key))
            .otherwise(F.concat(
                F.lit("SELECT order_itemsXfinal_price, order_items.final_price FROM reviews r JOIN orders o JOIN payments p JOIN shipping s -- "),
                key))
        )
        return self.raw("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").select(
            F.col("o_orderkey").alias("statement_id"), sql.alias("sql_text"))

    # ---- retrieval corpus -----------------------------------------------------------------------

    def documents(self) -> DataFrame:
        """The corpus: one document per text, typed by its source, with stored lexemes."""
        return self.plain_documents().withColumn("content_tsv", X.lexemes(F.col("content")))

    def plain_documents(self) -> DataFrame:
        """The corpus without its lexemes."""
        labels = self.raw("labels").select("doc_id", "toxic")
        embedded = self.raw("embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("embedded"))
        kinds = F.array(*[F.lit(v) for v in ENUMS["rag_source"]])
        number = F.substring("source", 4, 9).cast("int")
        source_type = F.coalesce(F.get(kinds, number), F.lit("review"))
        docs = (
            self.raw("documents").join(labels, "doc_id", "left").join(embedded, "doc_id", "left")
            .withColumn("source_type", source_type)
        )
        return docs.select(
            "doc_id", "source_type",
            F.when(source_type == "review", F.col("doc_id").cast("string"))
            .otherwise(F.concat_ws("-", "source", "doc_id")).alias("source_id"),
            F.concat(F.lit("Document "), F.col("doc_id"), F.lit(" ("), F.col("lang"), F.lit(")")).alias("title"),
            F.col("text").alias("content"),
            F.col("lang").alias("content_lang"),
            F.to_json(F.struct(
                F.col("source").alias("detection_columns"), F.col("lang").alias("preferred_view"),
                F.col("n_chars"))).alias("metadata"),
            _case(F.col("source_type"), SOURCE_EMBEDDING, "schema").alias("embedding_type"),
            F.least(F.lit(10), F.lit(1) + F.floor(F.col("n_chars") / 500)).cast("smallint").alias("priority"),
            _case(F.col("lang"), {"en": "2.0", "de": "1.5", "fr": "1.3"}, "1.0").cast("decimal(4,2)")
            .alias("retrieval_weight"),
            F.lit(1).alias("version"),
            (F.coalesce(F.col("toxic"), F.lit(0)) == 0).alias("is_active"),
            F.col("embedded").isNull().alias("needs_reembedding"),
            F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("created_at"),
            (F.expr("timestamp_ntz '2024-01-01 00:00:00'") + F.make_dt_interval(mins=F.col("n_chars").cast("int")))
            .alias("updated_at"),
        )

    def embeddings(self, documents: DataFrame) -> DataFrame:
        kinds = documents.select("doc_id", "source_type", "embedding_type")
        return self.raw("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding").join(kinds, "doc_id")


# Vector collection of each document type.
SOURCE_EMBEDDING = {
    "schema_doc": "schema", "business_rule": "business_rule", "leakage_scenario": "business_rule",
    "sql_template": "sql_template", "review": "review", "leakage_reason": "business_rule",
    "kpi_glossary": "metric", "join_graph": "schema", "anti_pattern": "schema", "routing_hint": "routing",
    "enum_reference": "schema", "generated_column": "schema", "metric_definition": "metric",
    "lineage_doc": "lineage", "anomaly_interpretation": "metric", "summary_profile": "metric",
    "temporal_context": "glossary",
}
