"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the local cores (default 8). A query is
timed from the call to the last row, written to the ``noop`` sink. Queries without a fit run three times, the fastest run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from clickcast.session import local_session  # noqa: E402

REPEATED = [
    "click_features",
    "click_features_join",
    "click_features_window",
    "click_features_hot_ip",
    "click_features_counts_from_train",
    "count_ip_h_app",
    "string_index_ip",
    "index_join",
    "feature_rows",
    "held_out_features",
    "auroc_score",
    "nb_predict",
]
ONCE = ["dt_predict", "rf_predict", "gbt_predict", "lr_predict", "boosted_predict", "tune_nb", "tune_lr", "job_chain"]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: min(seconds(spark, name, sf_dir) for _ in range(3)) for name in REPEATED}
    times |= {name: seconds(spark, name, sf_dir) for name in ONCE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "click_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
