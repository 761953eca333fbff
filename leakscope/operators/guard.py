"""Vetting of generated SQL against text rules, and intent tagging of user questions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GuardRule:
    guard_type: str
    guard_mode: str
    pattern: str
    message: str


# The vetting rules. A ``contains`` pattern is a case-blind LIKE in which ``_`` and ``%``
# stay wildcards; a ``regex`` is case-blind and ``.`` also matches line ends.
GUARD_RULES: tuple[GuardRule, ...] = (
    GuardRule("fake_column", "contains", "orders.status", "Column does not exist. Use orders.order_status"),
    GuardRule("fake_column", "contains", "orders.amount", "Column does not exist. Use orders.total_revenue"),
    GuardRule("fake_column", "contains", "customers.name",
              "Column does not exist. Use customers.customer_unique_id or customer_city"),
    GuardRule("fake_column", "contains", "payments.amount", "Column does not exist. Use payments.payment_value"),
    GuardRule("fake_column", "contains", "order_items.final_price",
              "Column does not exist. Use order_items.price_after_discount"),
    GuardRule("fake_enum", "contains", "'complete'", "Invalid order_status value. Use 'delivered' or 'processing'"),
    GuardRule("fake_enum", "contains", "'success'", "Invalid payment_status value. Use 'approved'"),
    GuardRule("fake_enum", "contains", "'pending_payment'", "Invalid status. Use payment_status = 'unpaid'"),
    GuardRule("fake_enum", "contains", "'Extreme'", "Invalid risk_tier. Valid values: Low, Medium, High, Critical"),
    GuardRule("fake_enum", "contains", "'Severe'", "Invalid risk_tier. Valid values: Low, Medium, High, Critical"),
    GuardRule("dangerous_join", "regex",
              r"reviews\s+.*JOIN\s+.*orders\s+.*JOIN\s+.*payments\s+.*JOIN\s+.*shipping",
              "Too many JOINs — use ml_output.mv_leakage_dashboard instead"),
    GuardRule("dangerous_join", "regex",
              r"order_items\s+.*JOIN\s+.*orders\s+.*WHERE\s+.*\bprice\b(?!_after_discount)",
              "Use price_after_discount instead of price for revenue calculations"),
    GuardRule("dangerous_join", "regex", r"FROM\s+ecommerce\.payments(?!.*payment_sequential)",
              "Missing payment_sequential = 1 filter — will return duplicate rows"),
)

# Question words per intent; the first intent with a matching word wins.
INTENT_WORDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("simple_lookup", ("كم عدد", "أظهر", "show me", "how many", "list")),
    ("aggregation", ("إجمالي", "متوسط", "نسبة", "total", "average", "percentage")),
    ("trend_analysis", ("شهري", "ربعي", "اتجاه", "trend", "monthly", "over time")),
    ("anomaly_investigation", ("خطر", "مشبوه", "leakage", "critical", "fraud", "anomaly")),
    ("sentiment_analysis", ("تقييم", "رأي", "شكوى", "review", "sentiment", "feedback")),
    ("schema_discovery", ("جدول", "عمود", "schema", "table", "column")),
)
# The sources each intent is answered from.
INTENT_SOURCES = {
    "simple_lookup": ("mv_leakage_dashboard",),
    "aggregation": ("mv_monthly_leakage", "mv_leakage_by_scenario", "mv_seller_risk"),
    "trend_analysis": ("mv_monthly_leakage",),
    "anomaly_investigation": ("mv_leakage_dashboard", "order_leakage_reasons"),
    "sentiment_analysis": ("ecommerce.reviews",),
    "schema_discovery": ("rag.documents",),
}


def rule_frame(spark: SparkSession, rules: Sequence[GuardRule] = GUARD_RULES) -> DataFrame:
    rows = [(i, r.guard_type, r.pattern, r.message, r.guard_mode) for i, r in enumerate(rules, 1)]
    return spark.createDataFrame(
        rows, "guard_id int, guard_type string, pattern string, message string, guard_mode string")


def breaks(sql: Column, rule: GuardRule) -> Column:
    if rule.guard_mode == "exact":
        return sql == rule.pattern
    if rule.guard_mode == "contains":
        return F.ilike(sql, F.lit(f"%{rule.pattern}%"))
    if rule.guard_mode == "regex":
        return sql.rlike(f"(?is){rule.pattern}")
    raise ValueError(f"unknown guard mode {rule.guard_mode}")


def validate_sql(statements: DataFrame, text: str = "sql_text", rules: Sequence[GuardRule] = GUARD_RULES) -> DataFrame:
    """One row per broken rule of every statement.

    Rules are constants of the plan: each statement is tested in place and only its hits are
    exploded, so there is no join and no row for a rule that holds.
    """
    hits = F.array_compact(F.array(*[
        F.when(breaks(F.col(text), r), F.struct(
            F.lit(r.guard_type).alias("guard_type"), F.lit(r.guard_mode).alias("guard_mode"),
            F.lit(r.pattern).alias("pattern"), F.lit(r.message).alias("message")))
        for r in rules]))
    return statements.withColumn("_hit", F.explode(hits)).select("*", "_hit.*").drop("_hit")


def rule_usage(statements: DataFrame, text: str = "sql_text", rules: Sequence[GuardRule] = GUARD_RULES) -> DataFrame:
    """Rules and statement hits per guard type and mode, unused kinds included."""
    spark = statements.sparkSession
    hits = validate_sql(statements, text, rules).groupBy("guard_type", "guard_mode").agg(F.count("*").alias("hits"))
    kinds = rule_frame(spark, rules).groupBy("guard_type", "guard_mode").agg(F.count("*").alias("rules"))
    return kinds.join(hits, ["guard_type", "guard_mode"], "left").withColumn(
        "hits", F.coalesce("hits", F.lit(0).cast("bigint")))


def intent(question: Column) -> Column:
    """First intent one of whose words occurs in the question, NULL for none."""
    low = F.lower(question)
    out: Column | None = None
    for name, words in INTENT_WORDS:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(low, F.lit(word))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def intent_sources(intent_col: Column) -> Column:
    """Sources an intent is answered from, as an array; NULL for an unknown one."""
    pairs = [c for name, sources in INTENT_SOURCES.items() for c in (F.lit(name), F.array(*map(F.lit, sources)))]
    return F.try_element_at(F.create_map(*pairs), intent_col)
