import numpy as np
import pytest
from pyspark.sql import functions as F

from leakscope.operators.anomaly import fitted_scores
from leakscope.plans import analytics as N
from leakscope.sources.schemas import DASHBOARD_COLUMNS, ENUMS, MONTHLY_COLUMNS, SCENARIO_COLUMNS, SELLER_RISK_COLUMNS
from leakscope.sources.tables import TableStore, read_documents_jsonl, read_table


def test_views_have_their_published_columns(plat):
    for name, columns in (("monthly_leakage", MONTHLY_COLUMNS), ("seller_risk", SELLER_RISK_COLUMNS),
                          ("leakage_by_scenario", SCENARIO_COLUMNS)):
        assert tuple(plat.published(name).columns) == columns
    assert set(plat.published("dashboard").columns) == set(DASHBOARD_COLUMNS) and len(DASHBOARD_COLUMNS) == 35
    assert tuple(plat.build("dashboard").columns) == DASHBOARD_COLUMNS


def test_dashboard_has_one_row_per_order(plat):
    dash = plat.published("dashboard")
    assert dash.count() == plat.published("orders").count() == dash.select("order_id").distinct().count()


def test_revenue_at_risk_agrees_everywhere(plat):
    dash, monthly = plat.published("dashboard"), plat.published("monthly_leakage")
    total = N.leakage_overview(dash).first().total_revenue_at_risk
    assert total == N.revenue_at_risk_from_source(plat.published("orders"), plat.published("scores")).first()[0]
    assert total == monthly.agg(F.sum("revenue_at_risk")).first()[0]
    assert monthly.agg(F.sum("total_orders")).first()[0] == dash.count()


def test_array_and_junction_forms_agree(plat):
    for scenario in ("seller_paid_twice", "negative_profit_margin"):
        a = N.scenario_orders_by_array(plat.published("dashboard"), scenario, k=None)
        b = N.scenario_orders_by_junction(plat.published("leakage_reasons"), plat.published("orders"), scenario)
        assert {r.order_id for r in a.collect()} == {r.order_id for r in b.collect()} != set()


def test_scenarios_stay_in_their_domain(plat):
    used = {r.leakage_type for r in plat.published("leakage_reasons").select("leakage_type").distinct().collect()}
    assert used and used <= set(ENUMS["leakage_scenario"])


def test_table_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("t")
    store.replace("t", spark.range(3))
    reader = store.read("t")
    store.replace("t", spark.range(5))
    assert reader.count() == 3 and store.read("t").count() == 5  # an open reader keeps its version
    store.append("t", spark.range(2))
    assert store.read("t").count() == 7
    with_parts = store.replace("p", spark.range(10).withColumn("g", F.col("id") % 2), ["g"])
    assert with_parts.filter("g = 1").count() == 5


def test_declared_read_and_jsonl(spark, tmp_path):
    spark.createDataFrame([("o", "seller_paid_twice")], "order_id string, leakage_type string").write.parquet(
        f"{tmp_path}/ml_output.order_leakage_reasons")
    row = read_table(spark, str(tmp_path), "ml_output.order_leakage_reasons").first()
    assert row.leakage_type == "seller_paid_twice" and row.confidence is None
    (tmp_path / "d.jsonl").write_text('{"doc_id": 1, "content": "status = \'\'delivered\'\'", "priority": 9}\n')
    doc = read_documents_jsonl(spark, f"{tmp_path}/d.jsonl").first()
    assert doc.content == "status = 'delivered'" and doc.priority == 9


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(1500, 2)))]
    rows += [(10_000 + i, 9.0 + i, -9.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "k bigint, a double, b double")
    return df, fitted_scores(df, "k", ["a", "b"], trees=30, contamination=0.02).collect()


def test_fitted_scores_find_the_planted_outliers(scored):
    _, rows = scored
    top = sorted(rows, key=lambda r: -r.ensemble_score)[:5]
    assert {r.k for r in top} == set(range(10_000, 10_005))
    assert all(r.anomaly_flag == 1 for r in top)
    assert all(0 <= r.if_score <= 1 and 0 <= r.lof_score <= 1 for r in rows) and len(rows) == 1505
    assert 0.015 < sum(r.anomaly_flag for r in rows) / len(rows) < 0.03


def test_fitted_scores_repeat_under_another_layout(scored):
    df, rows = scored
    again = fitted_scores(df.repartition(13), "k", ["a", "b"], trees=30, contamination=0.02).collect()
    assert {r.k: r.if_score for r in again} == {r.k: r.if_score for r in rows}


def test_profile_compares_values_in_their_own_type(spark):
    from leakscope.operators import quality

    table = spark.createDataFrame([(9, 100.5, "b"), (1499, 99.25, None)], "k int, price double, t string")
    got = {r.column_name: (r.least, r.greatest, r.nulls) for r in quality.column_profile(table, "t").collect()}
    assert got == {"k": ("9", "1499", 0), "price": ("99.25", "100.5", 0), "t": ("b", "b", 1)}


def test_folders_of_like_names_have_tables_of_their_own(spark):
    from leakscope.plans.platform import Platform

    assert Platform(spark, "/data/a-b").root != Platform(spark, "/data/a_b").root


def test_published_tables_have_names_in_sql(spark, plat):
    plat.register_views()
    assert spark.sql("SELECT count(*) FROM mv_leakage_dashboard").first()[0] == plat.published("dashboard").count()
    assert spark.sql("SELECT count(*) FROM order_leakage_reasons r JOIN orders o USING (order_id)").first()[0] > 0


def test_derived_columns_are_not_shuffled(spark, tmp_path):
    """Columns made of others are made where rows are written; the table and the session's settings stay as they were."""
    from pyspark.sql import functions as F

    from leakscope.sources.tables import DERIVED_SIZE, TableStore

    store, before = TableStore(spark, str(tmp_path)), spark.conf.get(DERIVED_SIZE[0])
    df = spark.range(300).select("id", (F.col("id") % 3).alias("kind"), F.lit("some words").alias("text"))
    words = F.split("text", " ")
    plain = store.replace("plain", df.withColumn("words", words), ["kind"])
    derived = store.replace("derived", df, ["kind"], derived={"words": words})
    assert derived.columns == plain.columns and derived.exceptAll(plain).isEmpty() and derived.count() == 300
    assert spark.conf.get(DERIVED_SIZE[0]) == before
