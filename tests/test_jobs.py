from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluicegate import Run, session, shared_scratch, shuffle_partitions_for
from sluicegate.jobs import bronze_to_silver as silver_job
from sluicegate.jobs import land_pages as land_job
from sluicegate.jobs import process_run as whole_job
from sluicegate.jobs import silver_to_gold as gold_job
from sluicegate.plans import (
    PRODUCTS,
    Roots,
    bronze_to_silver,
    process_run,
    run_metadata,
)
from sluicegate.sources import (
    land_bronze,
    read_json,
    read_run,
    read_table_run,
    register_table,
    write_run,
)
from tests.conftest import plan_of, record

RECORDS = (
    record(code="1", last_modified_t=1, brands="Acme"),
    record(code="1", last_modified_t=2, brands="acme "),
    record(code="2", nutrition_grades=None),
    record(code=None, _id=None, sugars_100g=120.0),
    record(code="3", sugars_100g=120.0),
)


@pytest.fixture
def roots(tmp_path):
    return Roots.under(str(tmp_path))


def _counts(result):
    return (
        result.source_count,
        result.valid_count,
        result.quarantined_count,
        result.duplicate_count,
    )


def test_silver_job(spark, bronze, run, roots):
    result = bronze_to_silver(bronze(*RECORDS), PRODUCTS, run, roots.silver, roots.quarantine)
    assert _counts(result) == (5, 2, 2, 1)
    silver = spark.read.parquet(result.silver_path)
    assert {(r.barcode, r.brand) for r in silver.collect()} == {("1", "acme"), ("2", "Acme")}
    assert "rejection_reason" not in silver.columns
    rejected = read_run(spark, roots.quarantine, run).collect()
    reasons = {r.barcode: r.rejection_reason for r in rejected}
    assert reasons == {
        None: "missing_barcode; invalid_sugars_100g",
        "3": "invalid_sugars_100g",
    }


def test_a_third_on_one_key_and_a_third_rejected(spark, run, roots):
    i = F.col("id")
    text = {f.name: F.lit("x") for f in PRODUCTS.bronze if f.dataType.simpleString() == "string"}
    text["code"] = F.when(i % 3 == 0, "hot").when(i % 3 == 1, " ").otherwise(i.cast("string"))
    skewed = spark.range(0, 6000, 1, 8).select(
        *(value.alias(name) for name, value in text.items()),
        i.alias("last_modified_t"),
        F.lit(None).cast(PRODUCTS.bronze["nutriments"].dataType).alias("nutriments"),
    )
    result = bronze_to_silver(skewed, PRODUCTS, run, roots.silver, roots.quarantine)
    assert _counts(result) == (6000, 2001, 2000, 1999)
    hot = read_run(spark, roots.silver, run).where("barcode = 'hot'").collect()
    assert [r.source_last_modified_timestamp for r in hot] == [5997]


def test_the_two_tables_need_different_roots(bronze, run, roots):
    with pytest.raises(ValueError, match="different roots"):
        bronze_to_silver(bronze(RECORDS[0]), PRODUCTS, run, roots.silver, f"{roots.silver}/")


def test_no_staging_table_is_left(spark, bronze, run, roots):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    pattern = f"sluicegate/validated-{run.run_id}-*"
    bronze_to_silver(bronze(RECORDS[0]), PRODUCTS, run, roots.silver, roots.quarantine)
    assert not list(shared.glob(pattern))
    unreadable = bronze(RECORDS[0]).withColumn("code", F.raise_error(F.lit("broken")))
    with pytest.raises(PySparkException, match="broken"):
        bronze_to_silver(unreadable, PRODUCTS, run, roots.silver, roots.quarantine)
    assert not list(shared.glob(pattern))
    with pytest.raises(ValueError, match="not a scratch path"):
        session.discard_scratch(spark, roots.silver)
    assert read_run(spark, roots.silver, run).count() == 1


def test_a_re_run_replaces_its_own_rows_only(spark, bronze, run, roots):
    other = Run("other", run.processing_date, run.processed_at)
    for r in (other, run):
        bronze_to_silver(bronze(*RECORDS), PRODUCTS, r, roots.silver, roots.quarantine)
    before = read_run(spark, roots.silver, run).collect()
    again = bronze_to_silver(bronze(*RECORDS), PRODUCTS, run, roots.silver, roots.quarantine)
    assert _counts(again) == (5, 2, 2, 1)
    assert sorted(read_run(spark, roots.silver, run).collect()) == sorted(before)

    # With nothing left to reject, the old rejected rows must go.
    clean = bronze_to_silver(bronze(RECORDS[0]), PRODUCTS, run, roots.silver, roots.quarantine)
    assert _counts(clean) == (1, 1, 0, 0)
    assert read_run(spark, roots.quarantine, run).count() == 0
    assert read_run(spark, roots.quarantine, other).count() == 2
    assert read_run(spark, roots.silver, other).count() == 2


def test_empty_and_fully_rejected_input(spark, bronze, run, roots):
    nothing = bronze_to_silver(
        bronze(RECORDS[0]).where("false"), PRODUCTS, run, roots.silver, roots.quarantine
    )
    assert _counts(nothing) == (0, 0, 0, 0)
    rejected = bronze_to_silver(bronze(RECORDS[3]), PRODUCTS, run, roots.silver, roots.quarantine)
    assert _counts(rejected) == (1, 0, 1, 0)
    assert spark.read.parquet(rejected.silver_path).columns[0] == "barcode"


def test_whole_run_and_report(spark, bronze, run, roots, tmp_path):
    path = tmp_path / "records.json"
    path.write_text(json.dumps([dict(r) for r in RECORDS]))
    report = process_run(
        spark, str(path), run, roots, source="test", category="sweets"
    ).first().asDict(recursive=True)
    assert report["quarantine_breakdown"] == {
        "missing_barcode; invalid_sugars_100g": 1,
        "invalid_sugars_100g": 1,
    }
    assert (report["status"], report["run_id"]) == ("success", "test-run")
    numbers = {k: v for k, v in report.items() if k.endswith("count") or k.endswith("rate")}
    assert numbers == {
        "extracted_record_count": 5,
        "silver_record_count": 2,
        "quarantined_record_count": 2,
        "duplicate_record_count": 1,
        "brand_summary_count": 2,
        "nutrition_grade_summary_count": 2,
        "gold_table_count": 3,
        "acceptance_rate": 0.4,
    }
    quality = read_run(spark, f"{roots.gold}/pipeline_quality_summary", run).first()
    assert (quality.acceptance_rate, quality.quarantine_rate) == (0.4, 0.4)
    assert quality.generated_at.astimezone(timezone.utc) == run.processed_at


def test_catalog_scan_reads_one_partition(spark, bronze, run, roots):
    other = Run("other", "2024-03-02", run.processed_at)
    for r, rows in ((run, RECORDS[:1]), (other, RECORDS)):
        frame = bronze(*rows)
        write_run(frame, roots.silver, r)
        register_table(spark, "catalog_scan", roots.silver, frame.schema, r)
    found = read_table_run(spark, "catalog_scan", run)
    assert [(r.processing_date, r.run_id) for r in found.collect()] == [("2024-03-01", "test-run")]
    assert spark.table("catalog_scan").count() == 6
    filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "processing_date" in filters
    assert "run_id" in filters


def test_mains(spark, bronze, run, tmp_path, capsys):
    base = str(tmp_path)
    landed = land_bronze(bronze(*RECORDS), f"{base}/bronze", run)
    identity = ["--run-id", run.run_id, "--processing-date", run.processing_date]
    silver_job.main(
        [*identity, "--bronze-path", landed, "--silver-root", f"{base}/silver",
         "--quarantine-root", f"{base}/quarantine"]
    )
    assert "silver rows: 2" in capsys.readouterr().out
    schema = spark.read.parquet(run.directory(f"{base}/silver")).schema
    register_table(spark, "silver_of_mains", f"{base}/silver", schema, run)
    result = gold_job.main(
        [*identity, "--silver-table", "silver_of_mains", "--gold-root", f"{base}/gold",
         "--source-count", "5", "--quarantined-count", "2"]
    )
    assert result.row_counts == {
        "brand_summary": 2,
        "brand_summary_canonical": 1,
        "nutrition_grade_summary": 2,
        "pipeline_quality_summary": 1,
    }
    whole_job.main(
        [*identity, "--bronze-path", landed, "--base", f"{base}/whole", "--source", "s",
         "--category", "c"]
    )
    assert '"silver_record_count":2' in capsys.readouterr().out


def test_run_metadata_without_pages(bronze, run):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    row = run_metadata(
        bronze(*RECORDS).selectExpr(
            "count(*) AS record_count", "cast(null AS long) AS page_count", "cast(null AS long) AS empty_envelope_count"
        ).coalesce(1),
        run,
        source="s",
        category="c",
        page_size=50,
        pages_requested=2,
        started_at=start,
        completed_at=start.replace(second=3, microsecond=456_000),
        product_path="p",
    ).first()
    assert (row.record_count, row.pages_requested, row.page_count) == (5, 2, None)
    assert row.duration_seconds == 3.46


def test_pages_are_landed_and_counted(spark, run, tmp_path, capsys):
    pages = tmp_path / "pages"
    pages.mkdir()
    contents = ({"products": list(RECORDS[:3])}, {}, {"products": list(RECORDS[3:])})
    for i, content in enumerate(contents):
        (pages / f"{i}.json").write_text(json.dumps(content))
    land_job.main(
        ["--run-id", run.run_id, "--processing-date", run.processing_date,
         "--pages-path", str(pages), "--bronze-root", f"{tmp_path}/bronze",
         "--metadata-root", f"{tmp_path}/runs", "--source", "s", "--category", "c",
         "--page-size", "3", "--pages-requested", "3"]
    )
    printed = json.loads(capsys.readouterr().out)
    row = read_run(spark, f"{tmp_path}/runs", run).first()
    assert (row.page_count, row.empty_envelope_count, row.record_count) == (3, 1, 5)
    assert printed["record_count"] == 5
    landed = read_json(spark, row.product_path, PRODUCTS.bronze, multi_line=False)
    assert sorted(r.code or "" for r in landed.collect()) == ["", "1", "1", "2", "3"]


def test_shuffle_width_follows_the_input():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(2**40) == 8192
    assert shuffle_partitions_for(100 * 10**12) == 100_000


class _Session:
    """Stands in for a session on a cluster."""

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app"

    class conf:
        values: dict = {}

        @classmethod
        def get(cls, key, default=None):
            return cls.values.get(key, default)


def test_scratch_is_in_the_shared_folder(spark, monkeypatch, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_scratch(spark, "x").startswith(f"{configured}/")
    assert shared_scratch(spark, "x") != shared_scratch(spark, "x")
    # A cluster must name the folder; a local session may do without.
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_scratch(_Session, "x")
    monkeypatch.setattr(_Session.sparkContext, "master", "local[2]")
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    assert shared_scratch(_Session, "x").startswith(str(tmp_path))
