"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is forced to full evaluation with the ``noop`` sink (no collect).
wall-clock seconds per query, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from classbench.plans.registry import QUERIES  # noqa: E402
from classbench.session import local_session  # noqa: E402

HEADLINE = [
    "describe",              # A10 exact quantiles over lineitem
    "histogram_by_class",    # A13
    "label_encode",          # E1
    "split_stratified",      # L1 exact stratified split
    "kfold_shuffled",        # L3
    "roc_curve",             # V7 two-level running sums
    "classification_report",  # V5
    "fold_summary",          # T4 scoring + T5
    "forest_test_metrics",   # flagship: encode, split, forest, test metrics
    "svm_ring",              # M3 vs M4 kernel map
    "network_history",       # M9-M15
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
