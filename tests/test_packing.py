"""How much is written on the way: packed lines, narrow exchanges and small staged files."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import functions as F

from sluicegate.plans import PRODUCTS
from sluicegate.sources import land_bronze, land_lines, read_json, run_tables
from sluicegate.workload import registry
from sluicegate.workload.inputs import product_pages
from tests.conftest import plan_of, record

# The package has a function of the module's name.
silver_plan = sys.modules["sluicegate.plans.bronze_to_silver"]


def test_landed_lines_are_packed_into_bounded_files(spark, bronze, run, tmp_path, monkeypatch):
    monkeypatch.setattr(run_tables, "PACKED_LINES", {**run_tables.PACKED_LINES, "maxRecordsPerFile": 300})
    rows = bronze(*(record(code=str(i)) for i in range(1000))).coalesce(1)
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    for name, landed in (
        ("lines", land_lines(lines, f"{tmp_path}/lines", run)),
        ("records", land_bronze(rows, f"{tmp_path}/records", run)),
    ):
        files = list(Path(landed).glob("part-*"))
        assert len(files) == 4 and all(f.suffix == ".gz" for f in files), name
        text = sum(len(r.value) + 1 for r in spark.read.text(landed).collect())
        assert 4 * sum(f.stat().st_size for f in files) < text, name
        found = read_json(spark, landed, PRODUCTS.bronze, multi_line=False)
        assert sorted(found.collect()) == sorted(rows.collect()), name


def test_pages_are_dealt_out_before_their_records_are_derived(spark):
    plan = plan_of(product_pages(spark, "/root/testdata/sf0.001", extra=True))
    assert plan.count("Exchange hashpartitioning") == 1
    # What is made of the tables' columns stands above the exchange.
    assert plan.index("cocoa, sugar") < plan.index("Exchange hashpartitioning")


def test_files_of_raw_records_are_packed(spark, monkeypatch):
    for name, label in (("json_scan", "json-scan"), ("page_flatten", "pages"), ("pages_to_report", "pages-to-report")):
        places = []
        scratch = registry.shared_scratch
        monkeypatch.setattr(registry, "shared_scratch", lambda *a, s=scratch: places.append(s(*a)) or places[-1])
        registry.queries()[name](spark, "/root/testdata/sf0.001")
        monkeypatch.undo()
        folder = Path(places[0].removeprefix("file:"))
        files = [f for f in folder.rglob("part-*.json*")]
        landed = [f for f in files if "reports" not in f.parts]
        assert landed and all(f.suffix == ".gz" for f in landed), name


def test_staged_rows_come_in_small_files(spark, bronze, run, tmp_path, monkeypatch):
    staged = []
    discard = silver_plan.discard_scratch

    def looked_at(session, path):
        files = Path(path.removeprefix("file:")).rglob("*.parquet")
        staged.extend(spark.read.parquet(str(f)).count() for f in files)
        discard(session, path)

    monkeypatch.setattr(silver_plan, "STAGED_ROWS", 100)
    monkeypatch.setattr(silver_plan, "discard_scratch", looked_at)
    rows = bronze(*(record(code=str(i % 200)) for i in range(450))).coalesce(1)
    result = silver_plan.bronze_to_silver(rows, PRODUCTS, run, f"{tmp_path}/silver", f"{tmp_path}/quarantine")
    assert (result.source_count, result.valid_count) == (450, 200)
    assert sorted(staged) == [50, 100, 100, 100, 100]
