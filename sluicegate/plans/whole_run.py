"""All stages of a run in one application."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.plans.bronze_to_silver import SilverResult, bronze_to_silver
from sluicegate.plans.landing import land_pages
from sluicegate.plans.record_plan import PRODUCTS, RecordPlan
from sluicegate.plans.reports import run_report
from sluicegate.plans.silver_to_gold import GoldResult, silver_to_gold
from sluicegate.run import Run
from sluicegate.sources import drop_run, read_json, read_run, run_exists, write_run


@dataclass(frozen=True)
class Roots:
    """Table roots; any URI scheme Spark can write."""

    silver: str
    quarantine: str
    gold: str
    report: str
    bronze: str
    metadata: str
    stages: str

    @classmethod
    def under(cls, base: str) -> Roots:
        base = base.rstrip("/")
        parts = ("silver", "quarantine", "gold", "reports", "bronze", "runs", "stages")
        return cls(*(f"{base}/{part}" for part in parts))


class StageLog:
    """Markers of a run's finished stages: what each has counted, written when its tables are in place."""

    def __init__(self, spark: SparkSession, root: str, run: Run):
        self._spark, self._root, self._run = spark, root.rstrip("/"), run

    def _at(self, stage: str) -> str:
        return f"{self._root}/{stage}"

    def forget(self, *stages: str) -> None:
        for stage in reversed(stages):
            drop_run(self._spark, self._at(stage), self._run)

    def once(self, stage: str, work: Callable[[], dict]) -> dict:
        """The facts of a finished stage, or those of the work, which is done now."""
        at = self._at(stage)
        if run_exists(self._spark, at, self._run):
            return json.loads(self._spark.read.text(self._run.directory(at)).first()[0])
        facts = work()
        line = self._spark.range(1).select(F.lit(json.dumps(facts)).alias("value"))
        write_run(line, at, self._run, fmt="text")
        return facts


def _silver_facts(result: SilverResult) -> dict:
    facts = asdict(result)
    del facts["run"]
    return facts


def _to_gold(spark: SparkSession, silver: SilverResult, run: Run, roots: Roots) -> GoldResult:
    rows = read_run(spark, roots.silver, run)
    return silver_to_gold(rows, run, roots.gold, silver.counts(spark))


def _report(
    spark: SparkSession, silver: SilverResult, gold: GoldResult, roots: Roots, bronze_path: str, source: str, category: str
) -> DataFrame:
    run = silver.run
    report = run_report(
        silver,
        gold,
        read_run(spark, roots.quarantine, run),
        source=source,
        category=category,
        bronze_path=bronze_path,
        gold_root=roots.gold,
    )
    write_run(report, roots.report, run, fmt="json")
    return spark.read.schema(report.schema).json(run.directory(roots.report))


def process_run(
    spark: SparkSession,
    bronze_path: str,
    run: Run,
    roots: Roots,
    *,
    source: str,
    category: str,
    plan: RecordPlan = PRODUCTS,
    multi_line: bool = True,
) -> DataFrame:
    """Landed JSON to silver, gold and the report; returns the report."""
    bronze = read_json(spark, bronze_path, plan.bronze, multi_line=multi_line)
    silver = bronze_to_silver(bronze, plan, run, roots.silver, roots.quarantine)
    gold = _to_gold(spark, silver, run, roots)
    return _report(spark, silver, gold, roots, bronze_path, source, category)


def process_pages(
    spark: SparkSession,
    pages_path: str,
    run: Run,
    roots: Roots,
    *,
    source: str,
    category: str,
    page_size: int,
    pages_requested: int | None = None,
    plan: RecordPlan = PRODUCTS,
    multi_line: bool = True,
    resume: bool = False,
) -> DataFrame:
    """Fetched pages to bronze, silver, gold and the report; returns the report.

    A stage's tables are moved into place when they are complete, and then its marker is written.  With ``resume`` a
    run that broke off goes on behind its last finished stage, whose counts the marker has; the
    pages must be the same.  Without it all stages run again.
    """
    log = StageLog(spark, roots.stages, run)
    if not resume:
        log.forget("landing", "silver", "gold")

    def landing() -> dict:
        metadata = land_pages(
            spark,
            pages_path,
            run,
            roots.bronze,
            roots.metadata,
            source=source,
            category=category,
            page_size=page_size,
            pages_requested=pages_requested,
            multi_line=multi_line,
        )
        return {"path": metadata.first()["product_path"]}

    def to_silver() -> dict:
        # Landed records are lines, whatever the pages were.
        bronze = read_json(spark, landed["path"], plan.bronze, multi_line=False)
        return _silver_facts(bronze_to_silver(bronze, plan, run, roots.silver, roots.quarantine))

    landed = log.once("landing", landing)
    silver = SilverResult(run=run, **log.once("silver", to_silver))
    gold = GoldResult(**log.once("gold", lambda: asdict(_to_gold(spark, silver, run, roots))))
    return _report(spark, silver, gold, roots, landed["path"], source, category)
