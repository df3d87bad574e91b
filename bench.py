"""Benchmark: wall-clock of the headline queries on one scale factor.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full with the ``noop`` sink (no collect to the
driver). Environment: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_QUERIES (comma list, optional).
"""

from __future__ import annotations

import json
import os
import platform
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ringwatch.plans.catalog import queries  # noqa: E402
from ringwatch.session import get_spark  # noqa: E402

HEADLINE = [
    "q_account_history",        # flagship: E1-E9
    "q_account_history_plain",  # same plan, one id block
    "q_account_history_skewed",  # one payer holds a third of all rows, ids scattered
    "q_basic_features",
    "q_summary",
    "q_split_manifest",
    "q_load_split_validation",
    "q_evaluate_amount",
    "q_evaluate_random",
    "q_degree_summary",
    "q_node_features_by_day",
    "q_neighbor_mean_2hop",
    "q_edge_inputs",
    "q_neg_subsample",
    "q_psi",
    "q_alert_queue",
    "q_feature_by_class",
]
# The heaviest plans: timed, but not run in the warm-up.
HEAVY = [
    "q_neighbor_mean_2hop_by_day",
    "q_leak_audit",
    "q_feature_gain",
    "q_model_comparison",
    "q_stream_history",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE + HEAVY
    spark = get_spark(f"local[{cpus}]", app="ringwatch-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", cpus * 2)),
                      extra={"spark.driver.memory": "16g"})
    qs = queries()
    # Warm-up (untimed): JIT, whole-stage codegen caches, Python workers, on the
    # smallest tables so it costs little; then one scan of the benchmark tables.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            if name in HEAVY:
                continue
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    qs["q_load"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_wall_clock", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "machine": f"local[{cpus}] {platform.machine()} {os.cpu_count()} cpus"}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
