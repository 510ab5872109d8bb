from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluicegate.functions import (
    Between,
    Required,
    failure_mask,
    passes_all,
    reasons_in,
    rejection_reason,
)
from sluicegate.operators import (
    accepted_rows,
    failure_breakdown,
    quarantined_rows,
    reason_breakdown,
    with_route,
)
from sluicegate.plans import PRODUCTS, validate
from sluicegate.workload.registry import queries
from tests.conftest import plan_of, record

ALL_LABELS = (
    "missing_barcode; missing_product_name; invalid_sugars_100g; invalid_fat_100g; "
    "invalid_proteins_100g; invalid_salt_100g; invalid_energy_kcal_100g"
)


@pytest.fixture
def reasons(bronze, run):
    """The reason of each record, given as changes to a good one."""

    def of(*changes: dict) -> list[str]:
        rows = validate(bronze(*(record(**c) for c in changes)), PRODUCTS, run)
        found = rows.coalesce(1).select(
            rejection_reason(PRODUCTS.rules).alias("reason"),
            passes_all(PRODUCTS.rules).alias("passes"),
        )
        collected = found.collect()
        assert all(row.passes is (row.reason == "") for row in collected)
        return [row.reason for row in collected]

    return of


def test_missing_values(reasons):
    assert reasons(
        {},
        {"code": None, "_id": None},
        {"product_name": None},
        {"product_name": " "},
        # A null key falls back, a blank one does not.
        {"code": None, "_id": "x"},
        {"code": "  ", "_id": "x"},
        # Optional fields never reject.
        {"brands": None, "categories": None, "nutriments": None, "last_modified_t": None},
    ) == [
        "",
        "missing_barcode",
        "missing_product_name",
        "missing_product_name",
        "",
        "missing_barcode",
        "",
    ]


def test_bounds_are_inclusive_and_null_passes(reasons):
    highest = {
        "sugars_100g": 100.0,
        "fat_100g": 100.0,
        "proteins_100g": 100.0,
        "salt_100g": 100.0,
        "energy_kcal_100g": 1000.0,
    }
    changes, expected = [], []
    for column, high in highest.items():
        inside = (0.0, high, None)
        outside = (-0.01, high + 0.01, float("nan"), float("inf"))
        changes += [{column: value} for value in (*inside, *outside)]
        expected += [""] * len(inside) + [f"invalid_{column}"] * len(outside)
    assert reasons(*changes) == expected


def test_all_reasons_come_in_rule_order(reasons):
    bad = {
        "energy_kcal_100g": 1001.0,
        "salt_100g": -1.0,
        "proteins_100g": 101.0,
        "fat_100g": 101.0,
        "sugars_100g": 150.0,
    }
    assert reasons({"code": " ", "product_name": "", **bad}) == [ALL_LABELS]


def test_routes_split_all_rows(bronze, run):
    rows = validate(bronze(record(), record(code=None, _id=None), record(fat_100g=200.0)),
                    PRODUCTS, run)
    accepted = accepted_rows(rows, PRODUCTS.rules)
    rejected = quarantined_rows(rows, PRODUCTS.rules)
    assert (accepted.count(), rejected.count()) == (1, 2)
    assert "rejection_reason" not in accepted.columns
    routed = with_route(rows, PRODUCTS.rules)
    sides = {r.route: r["count"] for r in routed.groupBy("route").count().collect()}
    assert sides == {"accepted": 1, "quarantined": 2}


def test_rejected_rows_keep_their_score(bronze, run):
    rows = validate(bronze(record(code=None, _id=None)), PRODUCTS, run)
    assert quarantined_rows(rows, PRODUCTS.rules).first().completeness_score == 0.9167


def test_rules_serve_any_table(spark):
    rows = spark.createDataFrame([(1, "x"), (9, None)], "n int, name string")
    rules = (Required("name", "no_name"), Between("n", 0, 5, "n_out"))
    found = rows.select(rejection_reason(rules).alias("reason")).collect()
    assert [r.reason for r in found] == ["", "no_name; n_out"]


def test_a_rule_needs_a_label(spark):
    with pytest.raises(ValueError, match="label"):
        rejection_reason((Required("name", ""),))


def test_fails_is_never_null(spark):
    rows = spark.createDataFrame([(None, None)], "n double, name string")
    rules = (Required("name", "a"), Between("n", 0, 5, "b"))
    flags = rows.select(*(F.isnull(r.fails()).alias(r.label) for r in rules)).first()
    assert tuple(flags) == (False, False)


def test_reasons_of_a_mask_equal_the_reasons(spark, bronze, run):
    changes = [{}, {"code": " "}, {"product_name": None, "fat_100g": 500.0}, {"energy_kcal_100g": -1.0, "sugars_100g": 101.0}]
    rows = validate(bronze(*(record(**c) for c in changes)), PRODUCTS, run)
    mask = failure_mask(PRODUCTS.rules)
    for row in rows.select(rejection_reason(PRODUCTS.rules), reasons_in(mask, PRODUCTS.rules), mask).collect():
        assert row[0] == row[1] and (row[2] == 0) == (row[0] == "")
    with pytest.raises(ValueError, match="63"):
        failure_mask([Required("x", "y")] * 64)
    with pytest.raises(ValueError, match="label"):
        failure_mask([Required("x", "")])


def test_breakdown_of_masks_equals_that_of_reasons(spark):
    rows = spark.createDataFrame([(1, "x"), (9, None), (9, "y"), (None, " "), (2, None)], "n int, name string")
    rules = (Required("name", "same"), Between("n", 0, 5, "out"), Between("n", 0, 1, "same"))
    found = {tuple(r) for r in failure_breakdown(rows, rules).collect()}
    assert found == {tuple(r) for r in reason_breakdown(quarantined_rows(rows, rules)).collect()}
    assert ("same; out; same", 1) in found and ("same", 1) in found


def _evaluations(frame) -> int:
    """How often the plan works out the rule on sugars."""
    return plan_of(frame).count("> 100.0") // 4


@pytest.mark.parametrize("name", ["route_quarantine", "route_accepted", "rejection_reason", "quarantine_breakdown", "dedup_latest"])
def test_each_rule_is_worked_out_once(spark, name):
    assert _evaluations(queries()[name](spark, "/root/testdata/sf0.001")) == 1


def test_both_routes_work_a_rule_out_once(spark, bronze, run):
    assert _evaluations(with_route(validate(bronze(record()), PRODUCTS, run), PRODUCTS.rules)) == 1
