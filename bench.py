"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is built and fully executed with the ``noop`` sink (the whole
plan runs, nothing is collected to the driver).  Queries keep nothing for one
another, so the times are those of each query alone; one query runs untimed
first, as a warm-up.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotline.plans.queries import registry  # noqa: E402
from lotline.session import local_session  # noqa: E402

HEADLINE = (
    "fact_profit", "profit_summary", "fact_purchase", "fact_repair", "fact_sale", "dim_vehicle",
    "fact_vehicle_lifecycle", "stage_history_events", "stage_history_vehicles", "vehicle_stage_sync",
    "extracted_event", "fact_review_queue", "listings", "scd2_user_versions", "contract_violations",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    scratch = tempfile.mkdtemp(prefix="lotline-bench-")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="lotline-bench",
                          extra={"spark.driver.memory": "16g",
                                 "spark.local.dir": scratch})
    reg = registry()
    timings = {}
    reg["dim_vehicle"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for n in names:
        t = time.time()
        reg[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[n] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
