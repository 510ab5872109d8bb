"""The jobs: pages to bronze, bronze to silver, silver to gold, and the run report."""

from sluicegate.plans.bronze_to_silver import (
    SilverResult,
    bronze_to_silver,
    latest_accepted,
    validate,
)
from sluicegate.plans.landing import DocumentCounts, land_documents, land_pages
from sluicegate.plans.record_plan import PRODUCTS, RecordPlan
from sluicegate.plans.reports import run_metadata, run_report
from sluicegate.plans.silver_to_gold import GoldResult, silver_to_gold
from sluicegate.plans.whole_run import Roots, process_pages, process_run

__all__ = [
    "PRODUCTS",
    "DocumentCounts",
    "GoldResult",
    "RecordPlan",
    "Roots",
    "SilverResult",
    "bronze_to_silver",
    "land_documents",
    "land_pages",
    "latest_accepted",
    "process_pages",
    "process_run",
    "run_metadata",
    "run_report",
    "silver_to_gold",
    "validate",
]
