"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "entity_table",          # entry point A: violation log -> entity table
    "raw_clean",             # scan + cleaning
    "explorer_filter",       # filter report
    "missing_profile",       # profiling
    "class_metrics",         # evaluation
    "knn_grade_predict",     # cosine KNN
    "tfidf_vectors",         # char n-gram TF-IDF
    "entity_match",          # request x entity text match
    "tree_fit_grades",       # distributed Gini tree
    "grade_reward_grid",     # reward grid + blur + proximity
    "area_search_grades",    # full area search (value iteration + walk)
    "direct_ranking",        # direct ranking
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("PLUMBLINE_PARTITIONS", str(max(8, int(cpus) * 2)))
    from plumbline.plans.catalog import load_all
    from plumbline.session import get_session

    spark = get_session(master=f"local[{cpus}]", app="plumbline-bench")
    reg = load_all()
    only = [q for q in sys.argv[1:] if q in reg]
    names = only or HEADLINE
    # JVM / reader warm-up (not timed)
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        fn, _sql = reg[name]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
