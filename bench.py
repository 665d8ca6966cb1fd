"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is forced to completion with the no-op sink (full computation,
no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerline.plans.catalog import queries  # noqa: E402

HEADLINE = [
    "medallion_spend", "spend_by_category_month", "fact_build", "map_resolve",
    "bridge_new_rows", "dedupe_keep_first", "header_issue", "call_tree", "date_dimension",
    "account_lookup", "unprocessable_rows", "coerce_types",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("ledgerline-bench")
             .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-bench-"))
    qs = queries()
    timings: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
