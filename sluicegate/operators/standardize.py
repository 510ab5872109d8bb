"""From raw records to flat, typed, scored rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import completeness
from sluicegate.run import Run


@dataclass(frozen=True)
class Field:
    """One output column.

    ``sources`` are column paths in Spark's notation (nested names dotted, unusual ones
    in backticks); the first that is not null counts.  ``steps`` then apply in order.
    """

    target: str
    sources: tuple[str, ...]
    steps: tuple[Callable[[Column], Column], ...] = ()

    def column(self) -> Column:
        value = F.col(self.sources[0])
        if len(self.sources) > 1:
            value = F.coalesce(*(F.col(path) for path in self.sources))
        for step in self.steps:
            value = step(value)
        return value.alias(self.target)


def standardize(records: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Apply all fields in one projection; ``keep`` names columns to pass through."""
    return records.select(*keep, *(field.column() for field in fields))


def stamp_run(rows: DataFrame, run: Run) -> DataFrame:
    """Add the run id and the run's clock as constants."""
    return rows.withColumns(
        {
            "pipeline_run_id": F.lit(run.run_id),
            "processed_at": F.lit(run.processed_at),
        }
    )


def add_completeness(
    rows: DataFrame, columns: Sequence[str], digits: int = 4, name: str = "completeness_score"
) -> DataFrame:
    """Add the share of ``columns`` that are populated."""
    return rows.withColumn(name, completeness(rows.schema, columns, digits))
