"""Times the headline queries, each from the supplied parquet files up, and the whole written mart.

One build of the mart warms up; then every query runs BENCH_RUNS times into a sink that drops the rows
(the median counts) and the mart is built once more. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from starmart.plans.mart import build_mart
from starmart.plans.queries import PARAMS, QUERIES
from starmart.session import local_session, shared_folder
from starmart.sources.supplied import SuppliedTables

HEADLINES = (
    "stg_sales",
    "fact_sales",
    "agg_growth_daily",
    "agg_campaign_performance",
    "agg_customer_segment",
    "agg_customer_cohort",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    target = shared_folder(spark, fallback="") or tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def build() -> None:
        build_mart(spark, SuppliedTables(spark, folder), f"{target}/starmart_bench_{os.getpid()}", PARAMS)

    def query(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    build()  # warms up the code all queries share
    seconds = {
        name: round(statistics.median(timed(lambda: query(name)) for _ in range(runs)), 3) for name in HEADLINES
    }
    seconds["whole_mart"] = round(timed(build), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries and the whole written mart, warm, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
