"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from trolley.plans.registry import REGISTRY
from trolley.session import build_session, release

HEADLINE = [
    "ranking_metrics", "user_item_features", "user_item_features_orders", "user_features", "item_features_orders",
    "causal_sequences_orders", "inference_state", "repeat_purchase", "repeat_purchase_orders", "item_similarity",
    "item_similarity_orders", "item_knn", "vector_topk", "rrf_blend", "candidate_pool", "feature_frame",
    "source_contribution", "batch_slate", "tfidf_weights", "tfidf_search", "governance_summary",
    "latency_percentiles", "als_topk", "two_stage_ranker",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", max(cpus, 2), {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # class loading and worker start are no part of any one query
    REGISTRY["ranking_metrics"][0](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
