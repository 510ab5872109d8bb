"""Send each row to the accepted or the quarantine side.

The rules are checked once per row, into a bit mask; sides, reasons and counts all come from the mask.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import Rule, failure_mask, reasons_in, rejection_reason

REASON = "rejection_reason"
ROUTE = "route"
MASK = "_failed_rules"
ACCEPTED = "accepted"
QUARANTINED = "quarantined"


def flag_reasons(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the text that lists every failing rule of a row."""
    return rows.withColumn(REASON, rejection_reason(rules))


def mark_failures(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the mask of failing rules as ``MASK``.

    A filter on a plain column expression moves below it and takes along a copy of all rules and of
    everything that their columns are derived from.  No filter moves below an exploded array, so
    with one of a single element each rule is worked out once, whatever is made of it later.
    """
    return rows.select("*", F.explode(F.array(failure_mask(rules))).alias(MASK))


def quarantined_rows(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail a rule, with their reasons."""
    failed = mark_failures(rows, rules).where(F.col(MASK) != 0)
    return failed.withColumn(REASON, reasons_in(F.col(MASK), rules)).drop(MASK)


def accepted_rows(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail no rule."""
    return mark_failures(rows, rules).where(F.col(MASK) == 0).drop(MASK)


def with_route(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep every row and name its side, for writing both sides in one pass."""
    side = F.when(F.col(MASK) == 0, F.lit(ACCEPTED)).otherwise(F.lit(QUARANTINED))
    columns = {REASON: reasons_in(F.col(MASK), rules), ROUTE: side}
    return mark_failures(rows, rules).withColumns(columns).drop(MASK)
