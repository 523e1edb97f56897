"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit",
"queries": {name: seconds}, "sf", ...}. Each query is run to completion
with the no-op sink (every row computed, nothing collected to the
driver). The receipt table is derived and written once ("stage_receipts");
the other queries read it, as they would read the stored table on a
cluster.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_receipts", "peak_receipt_day", "receipts_by_distance", "redeem_rate_by_distance",
    "received_redeemed_by_rate", "received_redeemed_by_weekday", "coupon_type_share", "redeemed_type_share",
    "label_share", "report_long", "missing_distance", "received_left_join_redeemed",
    "features_entity_join", "features_pair_join", "features_wide", "train_set", "fit_trees", "score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from couponlens.session import build_session
    from couponlens.plans.registry import QUERIES
    from couponlens.sources import receipts as S

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), extra={
        "spark.driver.memory": "16g",
    })
    # Written tables go to the session's spark.checkpoint.dir; only a
    # session without one gets a fresh scratch folder (couponlens.shared_dir).

    # Warm the JVM on the smoke tables so start-up cost is not charged to a query.
    smoke = "/root/testdata/sf0.001"
    if os.path.isdir(smoke):
        QUERIES["daily_receipts"](spark, smoke).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    S.receipts(spark, sf_dir)
    times["stage_receipts"] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
