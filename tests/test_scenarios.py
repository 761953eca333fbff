from pyspark.sql import functions as F

from leakscope.plans import scenarios


def parse(spark, flag, reason):
    df = spark.createDataFrame([(flag, reason)], "f int, r string").select(
        scenarios.normalise_reason(F.col("f"), F.col("r")).alias("n"))
    return df.select(scenarios.reason_scenarios(F.col("n")).alias("s")).first().s


def test_reason_text_to_scenarios(spark):
    assert parse(spark, 1, "COD unpaid|Logistics>revenue") == ["cod_unpaid_after_delivery", "logistics_exceeds_revenue"]
    assert parse(spark, 0, "COD unpaid") == ["no_leakage"]
    assert parse(spark, 1, "Negative margin and negative profit") == ["negative_profit_margin"]
    assert parse(spark, 1, "nothing known") == []


def test_contradicting_review_beats_failed_shipping(spark):
    assert parse(spark, 1, "shipping failed; contradicting review") == ["review_contradicts_cancelled"]
    assert parse(spark, 1, "shipping failed") == ["shipping_failed_review_exists"]


def test_result_keeps_slot_order(spark):
    text = "no invoice|high discount|inventory mismatch"
    assert parse(spark, 1, text) == ["inventory_mismatch", "high_discount_negative_profit", "no_invoice_on_completion"]


def test_junction_drops_clean_orders(spark):
    df = spark.createDataFrame(
        [(1, ["a", "a", "b"], 0.123456), (2, ["no_leakage"], 0.5), (3, [], 0.5), (4, None, 0.5)],
        "order_id int, leakage_scenarios array<string>, ensemble_score double")
    got = sorted((r.order_id, r.leakage_type, str(r.confidence)) for r in scenarios.junction(df).collect())
    assert got == [(1, "a", "0.1235"), (1, "b", "0.1235")]


def test_null_facts_fire_no_rule(spark):
    cols = ("order_id int, order_status string, payment_status string, shipping_status string, has_incorrect_refund boolean, "
            "duplicate_refund boolean, total_logistics decimal(14,2), total_revenue decimal(14,2), payment_type string, "
            "avg_discount_pct decimal(5,3), profit_margin decimal(7,4), invoice_available boolean, refunded_before_cancel boolean, "
            "inventory_mismatch boolean, any_paid_twice boolean, fee_calculation_error boolean, fee_to_cost_ratio decimal(10,4), "
            "has_commented_review boolean, shipping_delay_days int, has_late_compensation boolean, has_positive_review boolean, "
            "small_refunds bigint, says_not_received boolean")
    n = len(cols.split(", "))
    inputs = spark.createDataFrame([(1, *[None] * (n - 1)), (2, *[None] * (n - 1))], cols)
    flags = spark.createDataFrame([(1, 1)], "order_id int, anomaly_flag int")
    got = {r.order_id: r.scenarios for r in scenarios.rule_scenarios(inputs, flags).collect()}
    assert got == {1: ["statistical_outlier"], 2: ["no_leakage"]}


def test_a_reason_text_that_names_a_kept_return_is_believed(spark):
    from pyspark.sql import functions as F

    from leakscope.plans import scenarios

    rows = spark.createDataFrame([(1, "Returned product kept|Never shipped"), (1, "No invoice"), (0, "Returned product kept")], "flag int, raw string")
    got = rows.select(scenarios.reason_scenarios(scenarios.normalise_reason(F.col("flag"), F.col("raw"))).alias("s")).collect()
    assert [r.s for r in got] == [["payment_approved_never_shipped", "returned_product_kept"], ["no_invoice_on_completion"], ["no_leakage"]]
