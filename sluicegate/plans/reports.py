"""One-row records of a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import share
from sluicegate.operators import reason_breakdown
from sluicegate.operators.routing import REASON
from sluicegate.plans.bronze_to_silver import SilverResult
from sluicegate.plans.silver_to_gold import BRAND_TABLE, GRADE_TABLE, GoldResult
from sluicegate.run import Run


def run_metadata(
    counts: DataFrame,
    run: Run,
    *,
    source: str,
    category: str,
    page_size: int,
    started_at: datetime,
    completed_at: datetime,
    product_path: str,
    pages_requested: int | None = None,
) -> DataFrame:
    """What a run landed, from where and how long it took; ``counts`` has one row."""
    seconds = round((completed_at - started_at).total_seconds(), 2)
    return counts.select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(source).alias("source"),
        F.lit(category).alias("category"),
        F.lit(page_size).alias("page_size"),
        F.lit(pages_requested).cast("int").alias("pages_requested"),
        "page_count",
        "empty_envelope_count",
        "record_count",
        F.lit(started_at).alias("started_at"),
        F.lit(completed_at).alias("completed_at"),
        F.lit(seconds).alias("duration_seconds"),
        F.lit(product_path).alias("product_path"),
    )


def breakdown_map(quarantined: DataFrame) -> DataFrame:
    """One row: the reason breakdown as a map, sorted by reason; empty if none.

    Its size is bounded by the combinations of rule labels, not by the data.
    """
    entries = F.collect_list(F.struct(REASON, "record_count"))
    return reason_breakdown(quarantined).agg(
        F.map_from_entries(F.array_sort(entries)).alias("quarantine_breakdown")
    )


def run_report(
    silver: SilverResult,
    gold: GoldResult,
    quarantined: DataFrame,
    *,
    source: str,
    category: str,
    bronze_path: str,
    gold_root: str,
) -> DataFrame:
    """One row about a finished run."""
    facts = {
        "run_id": silver.run.run_id,
        "status": "success",
        "generated_at": silver.run.processed_at,
        "source": source,
        "category": category,
        "bronze_product_path": bronze_path,
        "silver_path": silver.silver_path,
        "quarantine_path": silver.quarantine_path,
        "gold_path": gold_root,
    }
    counts = {
        "extracted_record_count": silver.source_count,
        "silver_record_count": silver.valid_count,
        "quarantined_record_count": silver.quarantined_count,
        "duplicate_record_count": silver.duplicate_count,
        "brand_summary_count": gold.row_counts[BRAND_TABLE],
        "nutrition_grade_summary_count": gold.row_counts[GRADE_TABLE],
        "gold_table_count": len(gold.paths),
    }
    return breakdown_map(quarantined).select(
        *(F.lit(value).alias(name) for name, value in facts.items()),
        *(F.lit(n).cast("long").alias(name) for name, n in counts.items()),
        share(F.lit(silver.valid_count), F.lit(silver.source_count)).alias("acceptance_rate"),
        "quarantine_breakdown",
    )
