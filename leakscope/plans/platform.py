"""The platform's tables over one source folder: base tables on demand, published ones on disk.

Published tables (orders, scores, the four views, the corpus) are written once per refresh to the
shared folder, as the views of a warehouse are, and analytic queries read those files. Base tables
stay lazy.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.config import RuleParams
from leakscope.functions import text as X
from leakscope.operators import postings
from leakscope.plans import marts, orders, scenarios
from leakscope.session import shared_dir, tune
from leakscope.sources.star import STAR_PARAMS, Star
from leakscope.sources.tables import TableStore

PARTITIONED = {
    "dashboard": ["order_month"],
    "leakage_reasons": ["leakage_type"],
    "documents": ["source_type"],
    "embeddings": ["source_type"],
    "postings": [postings.PARTITION],
}
SORTED = {"postings": list(postings.ORDER)}
# Published tables in an order in which each finds the ones it reads already written.
PUBLISHED = ("payment_summary", "orders", "shipping", "scores", "customers", "sellers", "leakage_reasons", "dashboard",
             "monthly_leakage", "seller_risk", "leakage_by_scenario", "documents", "embeddings", "postings")
VIEWS = ("dashboard", "monthly_leakage", "seller_risk", "leakage_by_scenario")
# The names that vetted SQL uses.
VIEW_NAMES = {
    "dashboard": "mv_leakage_dashboard",
    "monthly_leakage": "mv_monthly_leakage",
    "seller_risk": "mv_seller_risk",
    "leakage_by_scenario": "mv_leakage_by_scenario",
    "leakage_reasons": "order_leakage_reasons",
}


class Platform:
    """Lazy access to every table of the platform by name."""

    def __init__(self, spark: SparkSession, folder: str, params: RuleParams = STAR_PARAMS, root: str | None = None):
        tune(spark)
        self.spark = spark
        self.params = params
        self.star = Star(spark, folder)
        # The whole path counts: two folders never share their tables.
        label = f"{folder.rstrip('/').rsplit('/', 1)[-1]}-{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
        self.root = root or f"{shared_dir(spark)}/{label}"
        self.store = TableStore(spark, self.root)
        self._published: dict[str, DataFrame] = {}

    def published(self, name: str) -> DataFrame:
        """A table read from its newest written version; written first if there is none."""
        if name not in self._published:
            if self.store.exists(name):
                self._published[name] = self.store.read(name)
            else:
                self.refresh(name)
        return self._published[name]

    def refresh(self, name: str) -> DataFrame:
        """Compute a table anew and publish it as the next version. Word positions follow their documents."""
        if name == "documents":
            # Lexemes are several times the text, so rows are placed without them.
            self._published[name] = self.store.replace(name, self.star.plain_documents(), PARTITIONED.get(name),
                                                       derived={"content_tsv": X.lexemes(F.col("content"))})
        elif name == "postings":
            self._published[name] = self.store.replace(
                name, postings.packed(self.published("documents")), PARTITIONED[name], SORTED[name], unpack=postings.spread)
        else:
            self._published[name] = self.store.replace(name, self.build(name), PARTITIONED.get(name), SORTED.get(name))
        if name == "documents" and self.store.exists("postings"):
            self.refresh("postings")
        return self._published[name]

    def refresh_views(self) -> dict[str, DataFrame]:
        """Refresh the four views, the dashboard first because the monthly view reads it."""
        fresh = {}
        for name in VIEWS:
            fresh[name] = self.refresh(name)
        self.register_views()
        return fresh

    def register_views(self) -> None:
        """All published tables as views that SQL can name: the four views under ``mv_``, the others plainly."""
        for name in PUBLISHED:
            self.published(name).createOrReplaceTempView(VIEW_NAMES.get(name, name))

    # ---- lazily derived, one row per order ------------------------------------------------------

    def items(self) -> DataFrame:
        return self.star.order_items()

    def rollup(self) -> DataFrame:
        return orders.order_rollup(self.items(), self.params)

    def payment_summary(self) -> DataFrame:
        return orders.payment_summary(self.star.payments(by_order=True))

    def refund_summary(self) -> DataFrame:
        return orders.refund_summary(self.star.refunds(), self.params)

    def rule_inputs(self) -> DataFrame:
        return scenarios.rule_inputs(
            self.published("orders"), self.published("payment_summary"), self.published("shipping"),
            self.refund_summary(), orders.review_signals(self.star.reviews(), self.params))

    def build(self, name: str) -> DataFrame:
        """The plan that computes a published table."""
        return getattr(self, f"_build_{name}")()

    def _build_payment_summary(self) -> DataFrame:
        return self.payment_summary()

    def _build_orders(self) -> DataFrame:
        return orders.orders(self.star.order_headers(), self.rollup(), self.published("payment_summary"),
                             self.star.parcels())

    def _build_shipping(self) -> DataFrame:
        return orders.shipping(self.star.order_headers(), self.star.parcels(), self.published("orders"), self.params)

    def _build_scores(self) -> DataFrame:
        # Kept before it is ranked: ranking reads it twice, and the rules behind it should run once.
        labelled = self.store.replace("labelled_scores", scenarios.labelled_scores(self.rule_inputs(), self.params))
        return scenarios.ranked_scores(labelled)

    def _build_customers(self) -> DataFrame:
        return orders.customers(self.star.customer_profiles(), self.published("orders"), self.params)

    def _build_sellers(self) -> DataFrame:
        return self.star.sellers(self.items(), self.star.payments())

    def _build_leakage_reasons(self) -> DataFrame:
        return scenarios.junction(self.published("scores"))

    def _build_dashboard(self) -> DataFrame:
        return marts.dashboard(
            self.published("orders"), self.published("customers"), self.published("payment_summary"),
            self.published("shipping"), orders.latest_review(self.star.reviews()), self.published("scores"))

    def _build_monthly_leakage(self) -> DataFrame:
        return marts.monthly_leakage(self.published("dashboard"))

    def _build_seller_risk(self) -> DataFrame:
        lines = self.star.by_order(self.items().select("order_id", "seller_id", "price_after_discount"))
        return marts.seller_risk(self.published("sellers"), lines, self.published("scores"))

    def _build_leakage_by_scenario(self) -> DataFrame:
        return marts.leakage_by_scenario(
            self.published("leakage_reasons"), self.published("orders"), self.published("scores"))

    def _build_documents(self) -> DataFrame:
        return self.star.documents()

    def _build_embeddings(self) -> DataFrame:
        return self.star.embeddings(self.published("documents"))

    def _build_postings(self) -> DataFrame:
        return postings.build(self.published("documents"))


_platforms: dict[tuple[str, str, str | None], Platform] = {}


def platform(spark: SparkSession, folder: str, root: str | None = None) -> Platform:
    """The platform of a source folder, shared by all queries of one application.

    Published tables lie below ``root``. One that is named outlives the application: the next one reads what is
    published there and refreshes on demand. By default they are the application's own.
    """
    key = (spark.sparkContext.applicationId, folder, root)
    if key not in _platforms:
        _platforms[key] = Platform(spark, folder, root=root)
    return _platforms[key]
