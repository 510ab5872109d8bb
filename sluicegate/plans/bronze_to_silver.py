"""Raw records to the silver and quarantine tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators import (
    ACCEPTED,
    QUARANTINED,
    accepted_rows,
    add_completeness,
    latest_per_key,
    stamp_run,
    standardize,
    with_route,
)
from sluicegate.operators.counting import QUARANTINED_COUNT, SOURCE_COUNT
from sluicegate.operators.routing import REASON, ROUTE
from sluicegate.plans.record_plan import RecordPlan
from sluicegate.run import Run
from sluicegate.session import discard_scratch, shared_scratch
from sluicegate.sources import write_runs

# Rows of a staged file.  A task that finds the latest rows sorts what it reads; columns pack so well that the 128 MB of
# a split would be gigabytes of rows.  Spark counts each file as its bytes and 4 MB, so a split holds 32 of them at most.
STAGED_ROWS = 50_000


@dataclass(frozen=True)
class SilverResult:
    """Where a run's rows are and how many there are."""

    run: Run
    silver_path: str
    quarantine_path: str
    source_count: int
    valid_count: int
    quarantined_count: int

    @property
    def duplicate_count(self) -> int:
        return self.source_count - self.valid_count - self.quarantined_count

    def counts(self, spark: SparkSession) -> DataFrame:
        return counts_frame(spark, self.source_count, self.quarantined_count)


def validate(bronze: DataFrame, plan: RecordPlan, run: Run) -> DataFrame:
    """Silver columns of every raw record, valid or not."""
    rows = stamp_run(standardize(bronze, plan.fields), run)
    return add_completeness(rows, plan.scored)


def latest_accepted(rows: DataFrame, plan: RecordPlan) -> DataFrame:
    """Silver: the latest valid row of each key.

    Invalid rows leave first.  Thus a newer but invalid row hides no older valid one, and
    blank keys, often the hottest, are never shuffled.
    """
    return latest_per_key(accepted_rows(rows, plan.rules), plan.key, plan.latest)


def bronze_to_silver(
    bronze: DataFrame, plan: RecordPlan, run: Run, silver_root: str, quarantine_root: str
) -> SilverResult:
    """Write both tables of a run and count its rows.

    The raw records are parsed once: one pass writes all validated rows, split by side,
    to a staging table in the cluster's shared folder.  Both outputs come from there, so
    losing executors during the deduplication repeats a columnar read and not the
    parsing.  Staged files are small, which bounds the rows that a task of the deduplication sorts.  All counts come from Parquet footers.
    """
    if silver_root.rstrip("/") == quarantine_root.rstrip("/"):
        raise ValueError("silver and quarantine need different roots")
    spark = bronze.sparkSession
    stage_path = shared_scratch(spark, f"validated-{run.run_id}")
    routed = with_route(validate(bronze, plan, run), plan.rules)
    try:
        routed.write.option("maxRecordsPerFile", STAGED_ROWS).partitionBy(ROUTE).parquet(stage_path)

        # The staged columns are known, so no file is opened to find them, and a side
        # without rows is simply empty.
        stage = spark.read.schema(routed.schema).parquet(stage_path)
        quarantined = stage.where(F.col(ROUTE) == QUARANTINED).drop(ROUTE)
        accepted = stage.where(F.col(ROUTE) == ACCEPTED).drop(ROUTE, REASON)

        silver = latest_per_key(accepted, plan.key, plan.latest)
        written = write_runs({quarantine_root: quarantined, silver_root: silver}, run)
        source_count = stage.count()
    finally:
        discard_scratch(spark, stage_path)

    return SilverResult(
        run=run,
        silver_path=run.directory(silver_root),
        quarantine_path=run.directory(quarantine_root),
        source_count=source_count,
        valid_count=written[silver_root],
        quarantined_count=written[quarantine_root],
    )


def counts_frame(spark: SparkSession, source: int, quarantined: int) -> DataFrame:
    """Known counts of a run as a one-row frame, like ``route_counts``."""
    counts = {SOURCE_COUNT: source, QUARANTINED_COUNT: quarantined}
    return spark.range(1).select(*(F.lit(n).cast("long").alias(c) for c, n in counts.items()))
