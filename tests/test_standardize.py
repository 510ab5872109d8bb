from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import Run
from sluicegate.functions import (
    as_type,
    canonical_label,
    completeness,
    from_epoch_seconds,
    label_or,
    lowered_label,
)
from sluicegate.operators import Field, standardize
from sluicegate.plans import PRODUCTS, validate
from tests.conftest import record


@pytest.fixture
def rows(bronze, run):
    """Validated rows of records, given as changes to a good one."""

    def of(*changes: dict) -> list:
        frame = bronze(*(record(**c) for c in changes)).coalesce(1)
        return validate(frame, PRODUCTS, run).collect()

    return of


def test_silver_columns_and_types(bronze, run):
    schema = validate(bronze(record()), PRODUCTS, run).schema
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("barcode", "string"),
        ("product_name", "string"),
        ("brand", "string"),
        ("categories", "string"),
        ("countries", "string"),
        ("ingredients_text", "string"),
        ("allergens", "string"),
        ("nutrition_grade", "string"),
        ("source_last_modified_timestamp", "bigint"),
        ("energy_kcal_100g", "double"),
        ("fat_100g", "double"),
        ("proteins_100g", "double"),
        ("salt_100g", "double"),
        ("sugars_100g", "double"),
        ("source_last_modified_at", "timestamp"),
        ("pipeline_run_id", "string"),
        ("processed_at", "timestamp"),
        ("completeness_score", "double"),
    ]


def test_values_are_cleaned(rows, run):
    spaced, tabbed, keyed, blank, bare = rows(
        {"product_name": "  a b ", "nutrition_grades": " B ", "code": " 1"},
        {"product_name": "\ta "},
        {"code": None, "_id": "z"},
        {"code": ""},
        {"nutriments": None},
    )
    # Only spaces are trimmed, and the key not even of those.
    assert (spaced.product_name, spaced.nutrition_grade, spaced.barcode) == ("a b", "b", " 1")
    assert tabbed.product_name == "\ta"
    assert keyed.barcode == "z"
    assert blank.barcode == ""
    assert (bare.fat_100g, bare.energy_kcal_100g) == (None, None)
    assert spaced.pipeline_run_id == run.run_id
    assert spaced.processed_at.astimezone(timezone.utc) == run.processed_at


def test_epoch_is_an_instant_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        rows = spark.createDataFrame([(86_400,), (-1,), (None,)], "t long")
        found = rows.select(F.unix_seconds(from_epoch_seconds(F.col("t"))).alias("t")).collect()
        assert [r.t for r in found] == [86_400, -1, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_an_absurd_epoch_does_not_fail_the_job(spark):
    rows = spark.createDataFrame([(2**62,), (-(2**62),), (9_223_372_036_854,)], "t long")
    found = rows.select(F.isnull(from_epoch_seconds(F.col("t"))).alias("n")).collect()
    assert [r.n for r in found] == [True, True, False]


def test_bad_text_casts_to_null(spark):
    rows = spark.createDataFrame([("7",), ("x",), ("",), (None,)], "s string")
    fields = [Field("n", ("s",), (as_type("long"),)), Field("d", ("s",), (as_type("double"),))]
    found = standardize(rows, fields).collect()
    assert [tuple(r) for r in found] == [(7, 7.0), (None, None), (None, None), (None, None)]


def test_score_counts_populated_columns(rows):
    found = rows(
        {},
        {"brands": "   "},
        {"allergens": None},
        {"nutriments": None},
        {"nutriments": None, "brands": None},
    )
    assert [r.completeness_score for r in found] == [1.0, 0.9167, 1.0, 0.5833, 0.5]


def test_numbers_and_dates_count_as_populated_when_not_null(spark):
    rows = spark.sql(
        "SELECT 0 AS i, DATE'2024-01-01' AS d, CAST(NULL AS double) AS n, ' ' AS s, "
        "array() AS a, CAST('' AS binary) AS b"
    )
    names = ["i", "d", "n", "s", "a", "b"]
    assert rows.select(completeness(rows.schema, names).alias("c")).first().c == 0.5


def test_labels(spark):
    rows = spark.createDataFrame(
        [(None,), ("",), ("  ",), (" mixed CASE-name o'neil ",)], "s string"
    )
    value = F.col("s")
    found = rows.select(
        label_or(value, "Unknown").alias("kept"),
        lowered_label(value, "unknown").alias("lowered"),
        canonical_label(value, "Unknown").alias("canonical"),
    ).collect()
    assert [tuple(r) for r in found[:3]] == [("Unknown", "unknown", "Unknown")] * 3
    assert tuple(found[3]) == (
        " mixed CASE-name o'neil ",
        " mixed case-name o'neil ",
        "Mixed Case-name O'neil",
    )


def test_columns_to_keep_come_first(spark):
    rows = spark.createDataFrame([(1, "a")], "id int, s string")
    out = standardize(rows, [Field("t", ("s",))], keep=["id"])
    assert out.schema == T.StructType().add("id", T.IntegerType()).add("t", T.StringType())


def test_run_checks_its_values():
    now = datetime(2024, 3, 1, 23, 59, tzinfo=timezone.utc)
    run = Run.start(run_id="r1", now=now)
    assert run.directory("s3a://b/t/") == "s3a://b/t/processing_date=2024-03-01/run_id=r1"
    assert Run.start(now=now).run_id != Run.start(now=now.replace(microsecond=1)).run_id
    with pytest.raises(ValueError, match="plain name"):
        Run.start(run_id="../r")
    with pytest.raises(ValueError, match="isoformat"):
        Run.start(run_id="r", processing_date="03/01/2024")
    with pytest.raises(ValueError, match="time zone"):
        Run("r", "2024-03-01", datetime(2024, 3, 1))
