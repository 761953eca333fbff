"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Published tables are refreshed first and timed one by one; each query then runs once to warm up and
``$BENCH_RUNS`` times in full, and its median counts. ``BENCH_ONLY=all`` times every registered query,
``BENCH_ONLY=h4,n1`` those whose name contains a part.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leakscope.catalog import QUERIES  # noqa: E402
from leakscope.plans.platform import PUBLISHED, platform  # noqa: E402
from leakscope.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
ONLY = [w for w in os.environ.get("BENCH_ONLY", "").split(",") if w]
# All named queries, and the heaviest operator of each family.
HEADLINE = ("p4_rule_scenarios", "p5_order_rollup", "p10_review_documents", "p11_leakage_documents", "p14_embed_pending",
            "p15_document_update", "p17_answered_queries", "p18_sql_vetting", "p19_scores", "p20_fitted_scores",
            "h1_keyword_leg", "h2_vector_leg", "h4_hybrid_search", "h5_search_analytics", "h6_search_reviews",
            "h7_semantic_search", "h9_ivf_search", "h10_batch_search", "f15_lexemes", "f20_trigram_similarity",
            "j9_seller_chain", "j14_campaign_attribution", "w3_anomaly_rank", "w5_instalments", "s2_leakage_windows",
            "s3_sessions")


def chosen(name: str) -> bool:
    if ONLY == ["all"]:
        return True
    if ONLY:
        return any(w in name for w in ONLY)
    return name in HEADLINE or (name[0] == "n" and name[1].isdigit())


def run(name: str, spark) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")
    spark = build_session("bench", f"local[{CPUS}]", int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    p = platform(spark, FOLDER)
    seconds: dict[str, float] = {}
    start = time.perf_counter()
    for name in PUBLISHED:
        at = time.perf_counter()
        p.refresh(name)
        seconds[f"refresh_{name}"] = round(time.perf_counter() - at, 3)
    seconds["refresh_all"] = round(time.perf_counter() - start, 3)
    for name in QUERIES:
        if not chosen(name):
            continue
        run(name, spark)
        seconds[name] = round(statistics.median(run(name, spark) for _ in range(RUNS)), 3)
    total = round(sum(v for k, v in seconds.items() if not k.startswith("refresh_")), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": FOLDER}))
    spark.stop()


if __name__ == "__main__":
    main()
