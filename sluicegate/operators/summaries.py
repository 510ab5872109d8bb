"""Summary tables by group and for the whole run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.functions import Average, Rule
from sluicegate.operators.counting import (
    DUPLICATE_COUNT,
    QUARANTINED_COUNT,
    SOURCE_COUNT,
    VALID_COUNT,
    count_columns,
    rates,
)
from sluicegate.operators.dedup import LATEST, Order, latest_and_counts

LOW_SCORE = 0.5
SCORE = "completeness_score"
_SCORE_AVERAGE = Average(SCORE, 4)


def group_summary(
    rows: DataFrame,
    label: Column,
    name: str,
    averages: Sequence[Average],
    key: str | None = None,
) -> DataFrame:
    """Count and averages per group; the label may derive from the column it replaces.

    With ``key`` the count is of distinct keys, otherwise of rows.  On rows that are
    already one per key the two agree and counting rows spares a shuffle of every key.
    """
    counted = F.count_distinct(F.col(key)) if key else F.count("*")
    return rows.groupBy(label.alias(name)).agg(
        counted.alias("product_count"), *(a.of_rows() for a in averages)
    )


def top_groups(summary: DataFrame, name: str, n: int) -> DataFrame:
    """The ``n`` largest groups, ties by name."""
    return summary.orderBy(F.desc("product_count"), F.asc(name)).limit(n)


def _quality_columns(
    n: Column, average: Column, lowest: Column, highest: Column, low_count: Column
) -> list[Column]:
    return [
        n.alias(VALID_COUNT),
        average,
        lowest.alias("minimum_completeness_score"),
        highest.alias("maximum_completeness_score"),
        low_count.alias("low_completeness_count"),
    ]


def _low() -> Column:
    return F.when(F.col(SCORE) < LOW_SCORE, F.lit(1)).otherwise(F.lit(0))


def _with_counts(quality: DataFrame, counts: DataFrame) -> DataFrame:
    """Put two one-row frames side by side (each fills the other's columns with NULL)."""
    known = counts.select(SOURCE_COUNT, QUARANTINED_COUNT)
    stacked = quality.unionByName(known, allowMissingColumns=True)
    merged = stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
    duplicates = F.col(SOURCE_COUNT) - F.col(VALID_COUNT) - F.col(QUARANTINED_COUNT)
    return rates(merged).select(
        SOURCE_COUNT,
        VALID_COUNT,
        QUARANTINED_COUNT,
        duplicates.alias(DUPLICATE_COUNT),
        "acceptance_rate",
        "quarantine_rate",
        *(c for c in quality.columns if c != VALID_COUNT),
    )


def run_quality(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: score statistics of the accepted rows beside the run's counts.

    ``counts`` has the source and the quarantined rows, see ``route_counts``.
    With no accepted row the statistics are NULL; the rates are 0.0 only if there was no
    source row either.
    """
    quality = rows.agg(
        *_quality_columns(
            F.count("*"), _SCORE_AVERAGE.of_rows(), F.min(SCORE), F.max(SCORE), F.sum(_low())
        )
    )
    return _with_counts(quality, counts)


def run_quality_in_one_pass(
    rows: DataFrame, rules: Sequence[Rule], key: Sequence[str], order: Sequence[Order]
) -> DataFrame:
    """``run_quality`` of rows not yet checked: one scan and one exchange by key give scores and counts."""
    keyed = latest_and_counts(rows, rules, key, order, [SCORE])
    # Only a key's kept row has a score here, so rejected rows take no part.
    keyed = keyed.withColumn(SCORE, F.col(LATEST)[SCORE])
    *statistics, low = _quality_columns(
        F.lit(0), _SCORE_AVERAGE.of_rows(), F.min(SCORE), F.max(SCORE), F.sum(F.when(F.col(SCORE).isNotNull(), _low()))
    )[1:]
    return rates(keyed.agg(*count_columns(), *statistics, low)).select(
        SOURCE_COUNT,
        VALID_COUNT,
        QUARANTINED_COUNT,
        DUPLICATE_COUNT,
        "acceptance_rate",
        "quarantine_rate",
        _SCORE_AVERAGE.name,
        "minimum_completeness_score",
        "maximum_completeness_score",
        "low_completeness_count",
    )


def group_facts(
    rows: DataFrame,
    labels: Mapping[str, Column],
    averages: Sequence[Average],
    key: str | None = None,
) -> DataFrame:
    """Partial aggregates by all labels at once, from which summaries roll up.

    One scan and one shuffle serve every summary.  Without ``key`` counts are of rows, which must then be one per
    key.  With it, as for the rows of several runs, each label's distinct keys are counted as well: rows meet by key
    in the one shuffle, a key is marked once per label there, and the marks add up to exact counts.
    """
    named = rows.withColumns(dict(labels)) if key else rows
    found = [
        F.count("*").alias("row_count"),
        *(partial for a in averages for partial in a.partials()),
        F.min(SCORE).alias("score_min"),
        F.max(SCORE).alias("score_max"),
        F.sum(_low()).alias("score_low"),
    ]
    if not key:
        return named.groupBy(*(label.alias(name) for name, label in labels.items())).agg(*found)
    # A key has a row a run, so none is hot.  Grouping and marking need no other exchange than this one.
    by_key = named.repartition(key).groupBy(key, *labels).agg(*found)
    once = {
        _keys(name): (F.row_number().over(Window.partitionBy(key, name).orderBy(*(n for n in labels if n != name))) == 1)
        .cast("long")
        for name in labels
    }
    marked = by_key.withColumns(once)
    sums = ["row_count", "score_low", *(_keys(name) for name in labels)]
    return marked.groupBy(*labels).agg(
        *(F.sum(c).alias(c) for c in sums),
        *(again for a in averages for again in a.merged()),
        F.min("score_min").alias("score_min"),
        F.max("score_max").alias("score_max"),
    )


def _keys(name: str) -> str:
    return f"{name}_keys"


def summary_of_facts(
    facts: DataFrame, label: Column, name: str, averages: Sequence[Average], keys_of: str | None = None
) -> DataFrame:
    """``group_summary`` rolled up from ``group_facts``.

    ``keys_of`` names the label whose distinct keys are counted; ``label`` must then be that label itself.
    """
    counted = F.sum(_keys(keys_of) if keys_of else "row_count")
    return facts.groupBy(label.alias(name)).agg(counted.alias("product_count"), *(a.of_partials() for a in averages))


def quality_of_facts(facts: DataFrame, counts: DataFrame) -> DataFrame:
    """``run_quality`` rolled up from ``group_facts``."""
    quality = facts.agg(
        *_quality_columns(
            F.coalesce(F.sum("row_count"), F.lit(0)),
            _SCORE_AVERAGE.of_partials(),
            F.min("score_min"),
            F.max("score_max"),
            F.sum("score_low"),
        )
    )
    return _with_counts(quality, counts)
