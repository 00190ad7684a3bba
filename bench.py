"""Headline-query timings: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Every query runs to
completion through Spark's no-op sink, so the whole plan executes (no collect to driver).
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "vocabulary", "encode_padded", "labelled_pairs", "split_pairs", "prepare_pairs", "jaccard_score",
    "evaluate_models", "class_report", "qualitative_examples", "training_history", "plateau_keras_rule",
    "lr_schedule", "model_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from simpairs.session import local_session
    from simpairs.plans.queries import QUERIES
    spark = local_session(cpus, max(8, 2 * cpus), "simpairs-bench")
    # JVM / JIT warm-up on the raw input (scan + text cleaning), not timed
    from simpairs.functions.text import clean_text, null_to_nan
    (spark.read.parquet(f"{sf_dir}/documents.parquet").select(clean_text(null_to_nan("text")).alias("c"))
     .write.format("noop").mode("overwrite").save())
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
