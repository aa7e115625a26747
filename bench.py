"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "topk_count",
    "topk_driver_rate",
    "topk_hour_ratio",
    "topk_ratio_by_key",
    "ols_line",
    "gd_line_trace",
    "gd_multi_trace",
    "word_count",
    "vocab_topf",
    "tfidf",
    "class_df_share",
    "knn_vote",
    "linear_score",
    "class_report",
    "logit_l2_gd",
    "svm_hinge",
    "logit_lbfgs",
    "naive_bayes",
    "mixture_draw",
    "gibbs_step",
    "cluster_purity",
    "review_word_counts",
]


def main() -> None:
    from tidemark.catalog.queries import QUERIES
    from tidemark.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, name="bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
