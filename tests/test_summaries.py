from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from sluicegate.functions import Average
from sluicegate.operators import (
    rates,
    reason_breakdown,
    run_quality,
    summary_of_facts,
    top_groups,
)
from sluicegate.operators.summaries import quality_of_facts
from sluicegate.plans.bronze_to_silver import counts_frame
from sluicegate.plans.record_plan import (
    BRAND_AVERAGES,
    CANONICAL_BRAND_AVERAGES,
    GRADE_AVERAGES,
)
from sluicegate.plans.silver_to_gold import (
    brand_summary,
    brand_summary_of_runs,
    canonical_brand_label,
    canonical_brand_summary,
    grade_summary,
    grade_summary_of_runs,
    product_facts,
)
from tests.conftest import plan_of

SCHEMA = (
    "barcode string, brand string, nutrition_grade string, energy_kcal_100g double, "
    "fat_100g double, proteins_100g double, salt_100g double, sugars_100g double, "
    "completeness_score double"
)


def _half_up(values: list, digits: int) -> float | None:
    present = [Decimal(repr(v)) for v in values if v is not None]
    if not present:
        return None
    mean = (sum(present) / len(present)).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
    return float(mean.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def data():
    """Silver rows of which a third share the unknown brand."""
    rng = random.Random(3)

    def number(high):
        return None if rng.random() < 0.2 else round(rng.uniform(0, high), 3)

    return [
        (
            f"k{i}",
            rng.choice([None, "", " "]) if i % 3 == 0 else rng.choice(["Acme", "acme", "B co"]),
            rng.choice([None, " ", "a", "B", "b", "e"]),
            number(1000),
            number(100),
            number(100),
            number(100),
            number(100),
            rng.choice([0.3333, 0.4167, 0.5, 0.5833, 1.0]),
        )
        for i in range(3000)
    ]


@pytest.fixture(scope="module")
def silver(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def _expected(data, label, averages) -> dict:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    groups = defaultdict(list)
    for row in data:
        groups[label(dict(zip(names, row)))].append(dict(zip(names, row)))
    return {
        name: (
            len(rows),
            *(_half_up([r[a.column] for r in rows], a.digits) for a in averages),
        )
        for name, rows in groups.items()
    }


def _found(frame) -> dict:
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


def _brand(row):
    return row["brand"] if (row["brand"] or "").strip() else "Unknown"


def _canonical(row):
    return " ".join(w[:1].upper() + w[1:].lower() for w in _brand(row).strip().split(" "))


def _grade(row):
    return (row["nutrition_grade"] or "").strip(" ").lower() or "unknown"


def test_summaries_match_brute_force(silver, data):
    assert _found(brand_summary(silver)) == _expected(data, _brand, BRAND_AVERAGES)
    assert _found(brand_summary(silver, key="barcode")) == _found(brand_summary(silver))
    assert _found(canonical_brand_summary(silver)) == _expected(
        data, _canonical, CANONICAL_BRAND_AVERAGES
    )
    assert _found(grade_summary(silver)) == _expected(data, _grade, GRADE_AVERAGES)


def test_keys_are_counted_once(spark, data):
    twice = spark.createDataFrame(data[:50] * 2, SCHEMA)
    once = _expected(data[:50], _brand, BRAND_AVERAGES)
    assert _found(brand_summary(twice, key="barcode")) == once


def test_facts_roll_up_to_the_same_summaries(spark, silver):
    facts = product_facts(silver).persist()
    rolled = {
        "brand": summary_of_facts(facts, F.col("brand"), "brand", BRAND_AVERAGES),
        "canonical": summary_of_facts(
            facts, canonical_brand_label(), "brand", CANONICAL_BRAND_AVERAGES
        ),
        "grade": summary_of_facts(
            facts, F.col("nutrition_grade"), "nutrition_grade", GRADE_AVERAGES
        ),
    }
    direct = {
        "brand": brand_summary(silver),
        "canonical": canonical_brand_summary(silver),
        "grade": grade_summary(silver),
    }
    for name, frame in rolled.items():
        assert frame.schema.names == direct[name].schema.names
        assert _found(frame) == _found(direct[name]), name
    counts = counts_frame(spark, 4000, 700)
    from_facts, from_rows = quality_of_facts(facts, counts), run_quality(silver, counts)
    assert from_facts.schema == from_rows.schema
    assert from_facts.collect() == from_rows.collect()
    facts.unpersist()


def test_run_quality(spark, silver, data):
    row = run_quality(silver, counts_frame(spark, 4000, 700)).first()
    scores = [r[-1] for r in data]
    assert row.asDict() == {
        "source_record_count": 4000,
        "valid_record_count": 3000,
        "quarantined_record_count": 700,
        "duplicate_record_count": 300,
        "acceptance_rate": 0.75,
        "quarantine_rate": 0.175,
        "average_completeness_score": _half_up(scores, 4),
        "minimum_completeness_score": 0.3333,
        "maximum_completeness_score": 1.0,
        # Exactly one half is not low.
        "low_completeness_count": sum(s < 0.5 for s in scores),
    }


def test_run_quality_of_nothing(spark, silver):
    none = silver.where("false")
    row = run_quality(none, counts_frame(spark, 0, 0)).first()
    assert row.acceptance_rate == row.quarantine_rate == 0.0
    assert row.average_completeness_score is None
    assert row.low_completeness_count is None
    rejected = run_quality(none, counts_frame(spark, 8, 8)).first()
    assert (rejected.acceptance_rate, rejected.quarantine_rate) == (0.0, 1.0)
    assert quality_of_facts(product_facts(none), counts_frame(spark, 0, 0)).first() == row


def test_rates_round_half_up(spark):
    counts = counts_frame(spark, 20_000, 3).withColumn("valid_record_count", F.lit(1))
    row = rates(counts).first()
    assert (row.acceptance_rate, row.quarantine_rate) == (0.0001, 0.0002)


def test_an_average_ignores_the_order_of_its_rows(spark):
    values = [0.1, 1e9, 0.2, -1e9, 0.3, 0.00005] * 500
    means = set()
    for parts in (1, 3, 7):
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        means.add(frame.agg(Average("x", 4).of_rows()).first()[0])
    assert means == {_half_up(values, 4)}


@pytest.mark.parametrize(
    ("values", "average", "expected"),
    [
        ([float("nan"), 1.0], Average("x", 4), "nan"),
        ([float("inf"), 1.0, None], Average("x", 4), "nan"),
        ([1e15, 1e15, None], Average("x", 4), "1000000000000000.0"),
        ([4e-7] * 3, Average("x", 7, scale=8), "4e-07"),
        ([None], Average("x", 2), "None"),
    ],
)
def test_averages_of_extreme_values(spark, values, average, expected):
    frame = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, x double")
    assert str(frame.agg(average.of_rows()).first()[0]) == expected
    assert str(frame.groupBy("g").agg(*average.partials()).agg(average.of_partials()).first()[0]) == expected


def test_an_average_needs_its_digits_within_its_scale():
    with pytest.raises(ValueError, match="scale"):
        Average("x", 7)


def test_breakdown_counts_exact_combinations(spark):
    rows = spark.createDataFrame([("a",), ("a; b",), ("a",)], "rejection_reason string")
    assert _found(reason_breakdown(rows)) == {"a": (2,), "a; b": (1,)}
    assert reason_breakdown(rows.where("false")).count() == 0


def test_top_groups_break_ties_by_name(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "brand string, product_count int")
    assert [r.brand for r in top_groups(rows, "brand", 2).collect()] == ["c", "a"]


@pytest.mark.parametrize(("sign", "expected"), [(1, 0.1234), (-1, -0.1234)])
def test_a_mean_just_below_a_tie_is_rounded_down(spark, sign, expected):
    # 99,999 values at the tie and one a millionth below: the mean lies 10^-11 below it.
    frame = spark.range(100_000).selectExpr(f"{sign} * if(id = 0, 0.123449D, 0.12345D) AS x")
    assert frame.agg(Average("x", 4).of_rows()).first()[0] == expected
    tie = spark.range(100_000).selectExpr(f"{sign} * 0.12345D AS x")
    assert tie.agg(Average("x", 4).of_rows()).first()[0] == sign * 0.1235


@pytest.mark.parametrize(("scale", "digits"), [(6, 0), (6, 2), (6, 6), (10, 4), (10, 10)])
def test_means_are_rounded_once(spark, scale, digits):
    rng = random.Random(scale + digits)
    unit = Decimal(1).scaleb(-scale)
    for size in (1, 3, 7, 640):
        values = [Decimal(rng.randrange(-(10**8), 10**8)) * unit for _ in range(size)]
        frame = spark.createDataFrame([(v,) for v in values], f"x decimal(20,{scale})")
        exact = (sum(values) / size).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
        assert frame.agg(Average("x", digits, scale=scale).of_rows()).first()[0] == float(exact)


def test_distinct_keys_of_several_runs(spark, data):
    """Keys stand in two runs, some under another brand or grade there."""
    rng = random.Random(9)
    again = [(row[0], rng.choice([row[1], "Other"]), rng.choice([row[2], "z"]), *row[3:]) for row in data[:2000]]
    both = spark.createDataFrame([*data, *again], SCHEMA).repartition(3)
    assert _found(brand_summary_of_runs(both, "barcode")) == _found(brand_summary(both, key="barcode"))
    assert _found(grade_summary_of_runs(both, "barcode")) == _found(grade_summary(both, key="barcode"))
    plan = plan_of(brand_summary_of_runs(both.select("*"), "barcode"))
    keyed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "barcode" in line]
    assert len(keyed) == 1
