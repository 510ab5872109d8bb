"""Row accounting: where every input row went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import Rule, passes_all, reasons_in, share
from sluicegate.operators.dedup import KEPT, N_ROWS, Order, latest_and_counts
from sluicegate.operators.routing import MASK, REASON, mark_failures

SOURCE_COUNT = "source_record_count"
VALID_COUNT = "valid_record_count"
QUARANTINED_COUNT = "quarantined_record_count"
DUPLICATE_COUNT = "duplicate_record_count"


def route_counts(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: input rows and rejected rows, without a shuffle of either."""
    return rows.agg(
        F.count("*").alias(SOURCE_COUNT),
        F.count_if(~passes_all(rules)).alias(QUARANTINED_COUNT),
    )


def count_columns() -> list[Column]:
    """Aggregates over ``latest_and_counts``: input rows, rows kept, rejected rows and duplicates."""
    accepted = F.coalesce(F.sum(F.when(F.col(KEPT), F.col(N_ROWS))), F.lit(0))
    kept = F.count_if(F.col(KEPT))
    source = F.coalesce(F.sum(N_ROWS), F.lit(0))
    return [
        source.alias(SOURCE_COUNT),
        kept.alias(VALID_COUNT),
        (source - accepted).alias(QUARANTINED_COUNT),
        (accepted - kept).alias(DUPLICATE_COUNT),
    ]


def stage_counts(rows: DataFrame, rules: Sequence[Rule], key: Sequence[str]) -> DataFrame:
    """One row: input rows, rows kept per key, rejected rows and dropped duplicates.

    The rows kept are counted as distinct keys among the accepted rows, so one
    aggregate gives all four numbers and only keys are shuffled, not rows.
    """
    return latest_and_counts(rows, rules, key).agg(*count_columns())


def rates(counts: DataFrame) -> DataFrame:
    """Add the accepted and quarantined shares of the source, 0.0 for an empty source."""
    return counts.withColumns(
        {
            "acceptance_rate": share(F.col(VALID_COUNT), F.col(SOURCE_COUNT)),
            "quarantine_rate": share(F.col(QUARANTINED_COUNT), F.col(SOURCE_COUNT)),
        }
    )


def failure_breakdown(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``reason_breakdown`` of rows not yet checked; masks are counted, and text made of the few sums."""
    masks = mark_failures(rows, rules).where(F.col(MASK) != 0).groupBy(MASK)
    counted = masks.agg(F.count("*").alias("record_count"))
    # Rules may share a label, so different masks may read alike.
    reason = reasons_in(F.col(MASK), rules).alias(REASON)
    return counted.groupBy(reason).agg(F.sum("record_count").alias("record_count"))


def reason_breakdown(quarantined: DataFrame) -> DataFrame:
    """Rows per exact combination of reasons; no rows if nothing was rejected."""
    return quarantined.groupBy(REASON).agg(F.count("*").alias("record_count"))
