"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. The session is warmed up by two queries, then each query is timed once."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from custlens.plans import catalog  # noqa: E402
from custlens.runtime import local_session  # noqa: E402

HEADLINE = [
    "clean_lines", "rfm_full_history", "customer_features", "churn_labels", "supervised_frame", "cleaning_audit", "monthly_revenue", "top_products",
    "pareto_curve", "popular_items", "itemsets_apriori", "itemsets_fpgrowth", "rules_all_measures", "segment_rules", "stratified_split",
    "auc_exact", "reliability_curve", "k_distance", "silhouette_squared", "davies_bouldin", "kmeans_segments", "pca_anomalies",
    "decision_table",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, "custlens-bench")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    seconds: dict[str, float] = {}
    for name in ("customer_features", "rules_all_measures"):
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
