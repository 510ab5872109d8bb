"""Silver to the summary tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import Average, canonical_label, label_or, lowered_label
from sluicegate.operators import group_facts, group_summary, quality_of_facts, summary_of_facts
from sluicegate.plans.record_plan import (
    BRAND_AVERAGES,
    CANONICAL_BRAND_AVERAGES,
    GRADE_AVERAGES,
    UNKNOWN_BRAND,
    UNKNOWN_GRADE,
)
from sluicegate.run import Run
from sluicegate.sources import write_runs

# Names of the gold tables.
BRAND_TABLE = "brand_summary"
CANONICAL_BRAND_TABLE = "brand_summary_canonical"
GRADE_TABLE = "nutrition_grade_summary"
QUALITY_TABLE = "pipeline_quality_summary"


@dataclass(frozen=True)
class GoldResult:
    """Paths and row counts of the gold tables written, by table name."""

    paths: dict[str, str]
    row_counts: dict[str, int]


def brand_label() -> Column:
    return label_or(F.col("brand"), UNKNOWN_BRAND)


def canonical_brand_label() -> Column:
    return canonical_label(F.col("brand"), UNKNOWN_BRAND)


def grade_label() -> Column:
    return lowered_label(F.col("nutrition_grade"), UNKNOWN_GRADE)


def brand_summary(silver: DataFrame, key: str | None = None) -> DataFrame:
    """Per brand, case-sensitive."""
    return group_summary(silver, brand_label(), "brand", BRAND_AVERAGES, key)


def canonical_brand_summary(silver: DataFrame) -> DataFrame:
    """Per brand with spelling folded; counts rows."""
    return group_summary(silver, canonical_brand_label(), "brand", CANONICAL_BRAND_AVERAGES)


def grade_summary(silver: DataFrame, key: str | None = None) -> DataFrame:
    """Per nutrition grade."""
    return group_summary(silver, grade_label(), "nutrition_grade", GRADE_AVERAGES, key)


def product_facts(silver: DataFrame, key: str | None = None) -> DataFrame:
    """Partial aggregates by brand and grade, enough for every gold table; see ``group_facts`` for ``key``."""
    averages = {a.column: a for a in (*BRAND_AVERAGES, *CANONICAL_BRAND_AVERAGES, *GRADE_AVERAGES)}
    labels = {"brand": brand_label(), "nutrition_grade": grade_label()}
    return group_facts(silver, labels, [Average(c, a.digits) for c, a in averages.items()], key)


def brand_summary_of_runs(silver: DataFrame, key: str) -> DataFrame:
    """Per brand over the silver of several runs, with the number of distinct keys.

    A key may stand in every run, under different brands; it counts once for each of its brands.
    """
    facts = product_facts(silver, key)
    return summary_of_facts(facts, F.col("brand"), "brand", BRAND_AVERAGES, keys_of="brand")


def grade_summary_of_runs(silver: DataFrame, key: str) -> DataFrame:
    """Per nutrition grade over the silver of several runs, with the number of distinct keys."""
    facts = product_facts(silver, key)
    return summary_of_facts(facts, F.col("nutrition_grade"), "nutrition_grade", GRADE_AVERAGES, keys_of="nutrition_grade")


def silver_to_gold(
    silver: DataFrame,
    run: Run,
    gold_root: str,
    counts: DataFrame | None = None,
    canonical_brands: bool = False,
) -> GoldResult:
    """Write the gold tables of one run of silver.

    ``silver`` must be one run's rows, which are one per key.  It is scanned and shuffled
    once, into partial sums by brand and grade; the tables roll up from those.  The sums
    are exact, so the result equals an aggregation of the rows themselves.

    ``counts`` (one row, see ``route_counts``) is needed for the quality table.  Every table carries the run's
    id and its clock.
    """
    facts = product_facts(silver).persist()
    try:
        tables = {
            BRAND_TABLE: summary_of_facts(facts, F.col("brand"), "brand", BRAND_AVERAGES),
            GRADE_TABLE: summary_of_facts(
                facts, F.col("nutrition_grade"), "nutrition_grade", GRADE_AVERAGES
            ),
        }
        if canonical_brands:
            # The default label is its own canonical form, so folding it again is safe.
            tables[CANONICAL_BRAND_TABLE] = summary_of_facts(
                facts, canonical_brand_label(), "brand", CANONICAL_BRAND_AVERAGES
            )
        if counts is not None:
            tables[QUALITY_TABLE] = quality_of_facts(facts, counts)
        lineage = {"run_id": F.lit(run.run_id), "generated_at": F.lit(run.processed_at)}
        tables = {name: rows.withColumns(lineage) for name, rows in tables.items()}
        roots = {f"{gold_root.rstrip('/')}/{name}": name for name in tables}
        written = write_runs({root: tables[name] for root, name in roots.items()}, run)
    finally:
        facts.unpersist()
    return GoldResult(
        paths={name: run.directory(root) for root, name in roots.items()},
        row_counts={name: written[root] for root, name in roots.items()},
    )
