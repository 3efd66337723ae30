"""Benchmark: build the warehouse over the test tables and serve the marts.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints ONE JSON line.  Timings per key:

* raw_landing: the 14 raw extracts derived from the test tables, written once;
* reference layer: each dimension and fact table is built once and written
  (as the modelled warehouse materializes its REF tables), staging included;
* marts: each mart computed from the written REF tables (noop sink);
* operators: a set of operator queries run from the raw tables, and the declared data tests
  run over the built warehouse.

``value`` is the sum of all timings (one untimed warm-up job runs first).
Set ``BENCH_EVENT_LOG_DIR`` to a scratch folder to record Spark's event log;
``tools/event_log_report.py`` then attributes stage time to each key.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from indicatormart import get_spark  # noqa: E402
from indicatormart.plans.entries import all_queries  # noqa: E402
from indicatormart.plans.warehouse import MARTS, REFERENCE  # noqa: E402
from indicatormart.sources.standins import landed_sources, standin_warehouse  # noqa: E402

OPERATOR_KEYS = ("prefer_finer_grain", "dedupe_grain", "stack_headers", "pivot_metrics", "best_match",
                 "month_spine", "resolve_key_name", "unpivot_drop_nulls", "check_unique_combination",
                 "declared_checks_staging", "declared_checks_reference")


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")   # optional: a scratch folder for the event log
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), extra=extra)
    timings: dict[str, float] = {}
    # untimed warm-up: JVM class loading and code generation of the first job
    spark.range(1000).selectExpr("sum(id)").collect()

    sc = spark.sparkContext
    t0 = time.perf_counter()
    sc.setJobDescription("raw_landing")
    landed_sources(spark, sf_dir)  # RAW layer: the 14 extracts derived from the test tables
    timings["raw_landing"] = round(time.perf_counter() - t0, 3)

    wh = standin_warehouse(spark, sf_dir, materialize_dims=True, materialize_facts=True)
    for name in REFERENCE:
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        _run(wh.model(name))
        timings[name] = round(time.perf_counter() - t0, 3)
    for name in MARTS:
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        _run(wh.model(name))
        timings[name] = round(time.perf_counter() - t0, 3)

    qs = all_queries()
    for name in OPERATOR_KEYS:
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        _run(qs[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    subtotal = lambda keys: round(sum(timings[k] for k in keys), 3)
    print(json.dumps({"metric": "warehouse_build_and_serve_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus,
                      "harness_seconds": subtotal(["raw_landing"]),
                      "model_seconds": subtotal(list(REFERENCE) + list(MARTS)),
                      "operator_seconds": subtotal(OPERATOR_KEYS)}))
    spark.stop()


if __name__ == "__main__":
    main()
