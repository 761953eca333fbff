"""Leakage scenarios: from raw reason text, and from business rules over the joined order row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.config import DEFAULT_PARAMS, RuleParams
from leakscope.functions import columns as C
from leakscope.operators.ranking import percent_rank_by_value

# Text found in a normalised reason -> scenario, in result order. A tuple entry lists
# alternatives of which the first match wins.
REASON_TOKENS: tuple[tuple[tuple[str, str], ...], ...] = (
    (("cod_unpaid", "cod_unpaid_after_delivery"),),
    (("inventory_mismatch", "inventory_mismatch"),),
    (("high_discount", "high_discount_negative_profit"),),
    (("negative_profit", "negative_profit_margin"), ("negative_margin", "negative_profit_margin")),
    (("logistics>revenue", "logistics_exceeds_revenue"),),
    (("never_shipped", "payment_approved_never_shipped"),),
    (("no_invoice", "no_invoice_on_completion"),),
    (("partial_payment", "partial_payment_only"),),
    (("seller_paid_twice", "seller_paid_twice"),),
    (("wrong_shipping_fee", "wrong_shipping_fee"),),
    (("statistical_outlier", "statistical_outlier"),),
    (("contradicting_review", "review_contradicts_cancelled"),
     ("shipping_failed", "shipping_failed_review_exists")),
    # No column tells it, so no rule can; a reason text that names it is believed.
    (("returned_product_kept", "returned_product_kept"),),
)


def normalise_reason(flag: Column, reason: Column) -> Column:
    """``no_leakage`` for unflagged orders, else the reason in lower case with underscores."""
    return F.when(flag == 0, "no_leakage").otherwise(F.lower(F.replace(reason, F.lit(" "), F.lit("_"))))


def reason_scenarios(reason: Column) -> Column:
    """Scenario array of a normalised reason text."""
    slots = []
    for alternatives in REASON_TOKENS:
        (token, label), *rest = alternatives
        slot = F.when(F.contains(reason, F.lit(token)), label)
        for token, label in rest:
            slot = slot.when(F.contains(reason, F.lit(token)), label)
        slots.append(slot)
    slots.append(F.when(reason == "no_leakage", "no_leakage"))
    return F.array_compact(F.array(*slots))


def junction(scores: DataFrame) -> DataFrame:
    """One row per (order, scenario) with the score as confidence.

    ``scores`` has one row per order and its scenarios are distinct, so no dedupe shuffle is needed.
    """
    real = scores.filter(
        F.col("leakage_scenarios").isNotNull()
        & (F.size("leakage_scenarios") > 0)
        & ~F.array_contains("leakage_scenarios", "no_leakage"))
    return real.select(
        "order_id",
        F.explode(F.array_distinct("leakage_scenarios")).alias("leakage_type"),
        F.col("ensemble_score").cast("decimal(5,4)").alias("confidence"),
    )


def rule_inputs(orders: DataFrame, payments: DataFrame, shipping: DataFrame, refunds: DataFrame,
                reviews: DataFrame) -> DataFrame:
    """Orders with the one-row-per-order facts every rule may look at."""
    return (
        orders.join(payments.select("order_id", "payment_type", "any_paid_twice"), "order_id", "left")
        .join(shipping.select("order_id", "shipping_status", "fee_calculation_error", "fee_to_cost_ratio"),
              "order_id", "left")
        .join(refunds, "order_id", "left")
        .join(reviews, "order_id", "left")
    )


def rule_conditions(params: RuleParams = DEFAULT_PARAMS) -> dict[str, Column]:
    """Scenario -> predicate over :func:`rule_inputs`, without the two score-based labels."""
    c = F.col
    delivered = c("order_status") == "delivered"
    canceled = c("order_status") == "canceled"
    loss = c("profit_margin") < 0
    return {
        "delivered_no_payment": delivered & (c("payment_status") == "missing"),
        "shipped_then_cancelled": c("shipping_status").isin("delivered", "in_transit") & canceled,
        "incorrect_refund_on_delivery": c("has_incorrect_refund") & delivered,
        "duplicate_refund": c("duplicate_refund"),
        "payment_approved_never_shipped":
            (c("payment_status") == "approved") & (c("shipping_status") == "never_shipped"),
        "logistics_exceeds_revenue": c("total_logistics") > c("total_revenue"),
        "cod_unpaid_after_delivery":
            (c("payment_type") == "cash_on_delivery") & delivered & c("payment_status").isin("unpaid", "missing"),
        "high_discount_negative_profit":
            (c("avg_discount_pct") > C.dec(params.high_discount)) & loss,
        "no_invoice_on_completion": delivered & ~c("invoice_available"),
        "partial_payment_only": c("payment_status") == "partial",
        "refund_before_cancellation": c("refunded_before_cancel") & canceled,
        "inventory_mismatch": c("inventory_mismatch"),
        "seller_paid_twice": c("any_paid_twice"),
        "wrong_shipping_fee":
            c("fee_calculation_error") | (c("fee_to_cost_ratio") > C.dec(params.fee_ratio_error)),
        "review_contradicts_cancelled": canceled & c("has_commented_review"),
        "delayed_delivery_compensation":
            (c("shipping_delay_days") > params.late_days) & c("has_late_compensation"),
        "shipping_failed_review_exists": (c("shipping_status") == "failed") & c("has_positive_review"),
        "repeated_small_refunds": c("small_refunds") >= params.small_refund_count,
        "fake_delivery_success": delivered & c("says_not_received"),
        "negative_profit_margin": loss,
    }


def rule_scenarios(inputs: DataFrame, flags: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """Scenario array per order from the business rules.

    An order with flag 0 and no fired rule is ``no_leakage``; a flagged order that fires none is a
    ``statistical_outlier``.
    """
    fired = F.array_compact(F.array(*[F.when(cond, name) for name, cond in rule_conditions(params).items()]))
    flag = F.coalesce(F.col("anomaly_flag"), F.lit(0))
    return (
        inputs.join(flags.select("order_id", "anomaly_flag"), "order_id", "left")
        .select("order_id", flag.alias("anomaly_flag"), fired.alias("fired"))
        .select(
            "order_id", "anomaly_flag",
            F.when(F.size("fired") > 0, F.col("fired"))
            .when(F.col("anomaly_flag") == 1, F.array(F.lit("statistical_outlier")))
            .otherwise(F.array(F.lit("no_leakage"))).alias("scenarios"),
        )
    )


def raw_reason(params: RuleParams = DEFAULT_PARAMS) -> Column:
    """Reason text as a scoring model exports it: fired checks joined by ``|``, mixed case, blanks."""
    rules = rule_conditions(params)
    words = {
        "COD unpaid": rules["cod_unpaid_after_delivery"],
        "Inventory mismatch": rules["inventory_mismatch"],
        "High discount": rules["high_discount_negative_profit"],
        "Negative margin": rules["negative_profit_margin"],
        "Logistics>revenue": rules["logistics_exceeds_revenue"],
        "Never shipped": rules["payment_approved_never_shipped"],
        "No invoice": rules["no_invoice_on_completion"],
        "Partial payment": rules["partial_payment_only"],
        "Seller paid twice": rules["seller_paid_twice"],
        "Wrong shipping fee": rules["wrong_shipping_fee"],
        "Contradicting review": rules["review_contradicts_cancelled"],
        "Shipping failed": rules["shipping_failed_review_exists"],
    }
    text = F.concat_ws("|", *[F.when(cond, word) for word, cond in words.items()])
    return F.when(text == "", "Statistical outlier").otherwise(text)


def stand_in_scores(inputs: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """Scores of each order as closed formulas of its margin and delay.

    Where the fitted detectors of ``operators.anomaly`` are not run, these give every job a
    repeatable score table: ``if = clip(0.9 - margin)`` and ``lof = clip(|delay| * 0.0005)``.
    """
    def clip(x: Column) -> Column:
        return F.least(F.lit(1), F.greatest(F.lit(0), x)).cast("decimal(8,6)")

    margin = F.coalesce("profit_margin", F.lit(0).cast("decimal(7,4)"))
    delay = F.coalesce(F.abs("shipping_delay_days"), F.lit(0)).cast("decimal(8,0)")
    return (
        inputs.withColumn("if_score", clip(C.dec("0.9") - margin))
        .withColumn("lof_score", clip(delay * C.dec("0.0005")))
        .withColumn("ensemble_score", C.ensemble_score(F.col("if_score"), F.col("lof_score"), params))
        .withColumn("anomaly_flag", ((F.col("ensemble_score") >= C.dec("0.6")) | (margin < 0)).cast("int"))
    )


def labelled_scores(inputs: DataFrame, params: RuleParams = DEFAULT_PARAMS) -> DataFrame:
    """The anomaly score table but for its rank: scores, tier, normalised reason and its scenarios."""
    scored = stand_in_scores(inputs, params)
    return (
        scored.withColumn("risk_tier", C.risk_tier(F.col("ensemble_score"), params))
        .withColumn("raw_reason", raw_reason(params))
        .withColumn("leakage_reason", normalise_reason(F.col("anomaly_flag"), F.col("raw_reason")))
        .withColumn("leakage_scenarios", reason_scenarios(F.col("leakage_reason")))
        .select(
            "order_id", "if_score", "lof_score", "ensemble_score", "anomaly_flag", "risk_tier",
            "leakage_scenarios", "leakage_reason", "raw_reason", "customer_id", "order_status",
            "order_purchase_timestamp", "total_revenue", "profit_margin", "avg_discount_pct",
            "shipping_delay_days", "payment_status", "shipping_status",
            F.date_format("order_month", "yyyy-MM").alias("month"),
        )
    )


def ranked_scores(labelled: DataFrame) -> DataFrame:
    """The anomaly score table. ``labelled`` is read twice, so it should be a stored table."""
    return percent_rank_by_value(labelled, "ensemble_score", "anomaly_rank")
