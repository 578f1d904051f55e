"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every result is
computed in full and discarded (noop sink).
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vecspark.plans.workload import registry  # noqa: E402

HEADLINE = (
    "knn_euclidean", "knn_cosine", "knn_payload", "knn_filtered_or", "filter_events_json", "filter_candidate_counts",
    "get_by_ids", "delete_by_ids", "upsert_merge", "latest_per_id", "validate_items", "ivf_assign", "ivf_probe_search",
    "greedy_search", "kmeans_train", "pq_encode", "pq_search", "pq_search_rerank", "recall_at_k", "mmr_search",
    "text_embed", "text_search", "pack_unpack_documents", "seal_roundtrip", "collection_changes", "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    queries["knn_euclidean"](spark, sf_dir).write.format("noop").mode("overwrite").save()   # start the workers
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
