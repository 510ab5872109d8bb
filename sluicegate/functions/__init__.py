"""Column expressions: cleaning, labels, quality rules and exact averages."""

from sluicegate.functions.averages import Average, decimal_total, exact_mean
from sluicegate.functions.rules import (
    Between,
    Required,
    Rule,
    failure_mask,
    passes_all,
    reasons_in,
    rejection_reason,
)
from sluicegate.functions.values import (
    as_type,
    canonical_label,
    completeness,
    from_epoch_seconds,
    is_blank,
    label_or,
    lowered_label,
    share,
)

__all__ = [
    "Average",
    "Between",
    "Required",
    "Rule",
    "as_type",
    "canonical_label",
    "completeness",
    "decimal_total",
    "exact_mean",
    "failure_mask",
    "from_epoch_seconds",
    "is_blank",
    "label_or",
    "lowered_label",
    "passes_all",
    "reasons_in",
    "rejection_reason",
    "share",
]
