"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores.  A query is timed from building its
frame, including any table it writes on the way, to having computed every row.  Each
runs once untimed before, so that the figures do not measure class loading.

Arguments name other queries to time.  ``--recompute`` instead times the whole run beside
the same run with every count and every table computed from the raw records again,
as a plan without the staging table and the shared partial sums would.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from sluicegate.operators import quarantined_rows, reason_breakdown, run_quality  # noqa: E402
from sluicegate.plans import (  # noqa: E402
    PRODUCTS,
    Roots,
    latest_accepted,
    process_run,
    validate,
)
from sluicegate.plans.bronze_to_silver import counts_frame  # noqa: E402
from sluicegate.plans.silver_to_gold import brand_summary, grade_summary  # noqa: E402
from sluicegate.session import build_session, shared_scratch  # noqa: E402
from sluicegate.sources import land_bronze, read_json, read_run, write_run  # noqa: E402
from sluicegate.workload.inputs import products  # noqa: E402
from sluicegate.workload.registry import RUN, queries  # noqa: E402

HEADLINE = (
    "json_scan",
    "page_flatten",
    "completeness_score",
    "rejection_reason",
    "route_quarantine",
    "dedup_latest",
    "brand_summary",
    "brand_summary_canonical",
    "grade_summary",
    "run_quality",
    "stage_counts",
    "quarantine_breakdown",
    "partition_pruned_scan",
    "bronze_to_silver",
    "silver_to_gold",
    "run_report",
)
REPEATS = 2


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def _staged(spark, landed: str, base: str) -> None:
    process_run(
        spark, landed, RUN, Roots.under(base), source="s", category="c", multi_line=False
    )


def _recomputed(spark, landed: str, base: str) -> None:
    bronze = read_json(spark, landed, PRODUCTS.bronze, multi_line=False)
    rows = validate(bronze, PRODUCTS, RUN)
    rejected = quarantined_rows(rows, PRODUCTS.rules)
    kept = latest_accepted(rows, PRODUCTS)
    source, _, quarantined = bronze.count(), kept.count(), rejected.count()
    roots = Roots.under(base)
    write_run(kept, roots.silver, RUN)
    write_run(rejected, roots.quarantine, RUN)
    silver = read_run(spark, roots.silver, RUN)
    silver.count()
    brands = brand_summary(silver, key="barcode").orderBy(F.desc("product_count"), "brand")
    grades = grade_summary(silver, key="barcode").orderBy("nutrition_grade")
    quality = run_quality(silver, counts_frame(spark, source, quarantined))
    for name, table in (("brands", brands), ("grades", grades), ("quality", quality)):
        write_run(table, f"{roots.gold}/{name}", RUN)
    brands.count()
    grades.count()
    reason_breakdown(read_run(spark, roots.quarantine, RUN)).collect()


def compare_recomputing(spark, sf_dir: str) -> dict[str, float]:
    base = shared_scratch(spark, "compare")
    landed = land_bronze(products(spark, sf_dir), f"{base}/bronze", RUN)
    times: dict[str, list[float]] = {"staged": [], "recomputed": []}
    for _ in range(REPEATS + 2):
        for name, flow in (("staged", _staged), ("recomputed", _recomputed)):
            start = time.perf_counter()
            flow(spark, landed, f"{base}/{name}")
            times[name].append(time.perf_counter() - start)
    return {name: round(min(values), 3) for name, values in times.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=8, conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    if "--recompute" in sys.argv:
        print(json.dumps(compare_recomputing(spark, sf_dir)))
        return
    wanted = sys.argv[1:] or HEADLINE
    registered = queries()
    times = {}
    for name in wanted:
        seconds(registered[name], spark, sf_dir)
        times[name] = round(
            min(seconds(registered[name], spark, sf_dir) for _ in range(REPEATS)), 3
        )
        print(name, times[name], file=sys.stderr)
    spark.stop()
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
