"""Table operators: standardize, route, deduplicate and summarize."""

from sluicegate.operators.counting import (
    failure_breakdown,
    rates,
    reason_breakdown,
    route_counts,
    stage_counts,
)
from sluicegate.operators.dedup import Order, latest_and_counts, latest_per_key
from sluicegate.operators.routing import (
    ACCEPTED,
    QUARANTINED,
    accepted_rows,
    flag_reasons,
    mark_failures,
    quarantined_rows,
    with_route,
)
from sluicegate.operators.standardize import Field, add_completeness, stamp_run, standardize
from sluicegate.operators.summaries import (
    group_facts,
    group_summary,
    quality_of_facts,
    run_quality,
    run_quality_in_one_pass,
    summary_of_facts,
    top_groups,
)

__all__ = [
    "ACCEPTED",
    "QUARANTINED",
    "Field",
    "Order",
    "accepted_rows",
    "add_completeness",
    "failure_breakdown",
    "flag_reasons",
    "group_facts",
    "group_summary",
    "latest_and_counts",
    "latest_per_key",
    "mark_failures",
    "quality_of_facts",
    "quarantined_rows",
    "rates",
    "reason_breakdown",
    "route_counts",
    "run_quality",
    "run_quality_in_one_pass",
    "stage_counts",
    "stamp_run",
    "standardize",
    "summary_of_facts",
    "top_groups",
    "with_route",
]
