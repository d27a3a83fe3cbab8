"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs that a real run would find stored (messy upload, ground truth, saved runs) are
written before the clock starts. Each query is timed from building its plan to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tablepact import session
from tablepact.workload import fixtures as fx
from tablepact.workload.catalog import QUERIES

HEADLINE = [
    "clean_orders", "row_accounting", "validate_run", "profile_reference", "check_cln03_text_rules",
    "check_cln08_ground_truth", "check_sem02_per_key_ratio", "check_sem05_categoricals", "check_cln07_sorted",
    "run_fingerprint", "cell_diff", "asof_upload", "agg_quantile", "agg_duplicate_count", "contract_lineitem",
    "endpoint_summary", "predict_output_S5", "win_keep_first",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    for stored in (fx.messy, fx.truth, fx.runs):
        stored(spark, sf)
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
