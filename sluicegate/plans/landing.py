"""Fetched pages and documents to landed bronze records."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import closing
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.plans.reports import run_metadata
from sluicegate.run import Run
from sluicegate.session import discard_scratch, shared_scratch
from sluicegate.sources import (
    FileGroup,
    file_groups,
    land_lines,
    page_count_columns,
    page_lines,
    read_pages,
    read_with_source,
    refuse_lists,
    small_files,
    sound_files,
    write_run,
    write_runs_in_parts,
    write_together,
)
from sluicegate.sources.json_records import EMPTY_ROW, SOURCE_FILE, texts_of


def _now() -> datetime:
    return datetime.now(timezone.utc)


def land_pages(
    spark: SparkSession,
    pages_path: str,
    run: Run,
    bronze_root: str,
    metadata_root: str,
    *,
    source: str,
    category: str,
    page_size: int,
    pages_requested: int | None = None,
    multi_line: bool = True,
    clock: Callable[[], datetime] = _now,
) -> DataFrame:
    """Flatten fetched pages, land their records and return the run's metadata row.

    Records are landed in their own text, so what no schema names yet is kept; they get types when they
    are read.  Pages and records are counted while they are written.  Nothing is shuffled on the
    way, and Spark counts each finished output partition once even if its task is
    repeated, so the counts are exact.

    The pages are read once.  Only if some had no envelope are their files read again, to refuse pages that are lists,
    before the landed lines take the place of older ones.
    """
    started_at = clock()
    of_pages, of_records = Observation("pages"), Observation("records")
    pages = read_pages(spark, pages_path, multi_line=multi_line, checked=False)
    pages = pages.observe(of_pages, *page_count_columns())
    lines = page_lines(pages)
    lines = lines.observe(of_records, F.count("*").alias("record_count"))

    def check() -> None:
        if of_pages.get["empty_envelope_count"]:
            refuse_lists(spark, pages_path, multi_line=multi_line)

    path = land_lines(lines, bronze_root, run, check)

    counts = {**of_pages.get, **of_records.get}
    metadata = run_metadata(
        spark.range(1).select(*(F.lit(n).cast("long").alias(c) for c, n in counts.items())),
        run,
        source=source,
        category=category,
        page_size=page_size,
        pages_requested=pages_requested,
        started_at=started_at,
        completed_at=clock(),
        product_path=path,
    )
    write_run(metadata, metadata_root, run)
    return metadata


@dataclass(frozen=True)
class DocumentCounts:
    """Records read from documents, and documents that lost something."""

    record_count: int
    dead_letter_count: int


def land_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    run: Run,
    records_root: str,
    dead_letter_root: str,
) -> DocumentCounts:
    """Split documents, each a file with a list of records, into typed records and a dead-letter table.

    A document that lost anything in the reading is a dead letter: its file, its whole text, how many rows
    it gave and how many of them hold nothing.  Those leave the records; what could be read of the
    others stays, with NULL for values of the wrong shape.  Documents are read twice, for their rows and for the files
    that lost nothing, and the text of damaged ones once more, by file.

    That is done for one group of files after another, so the driver's memory does not grow with their number.
    """
    roots = records_root, dead_letter_root

    def parts() -> Iterator[dict[str, DataFrame]]:
        for group in file_groups(spark, path):
            for part in _split(spark, group, schema, run):
                yield dict(zip(roots, part, strict=True))
                del part
            # The JVM's frames, and with them their listings, are held by Python objects that refer to each other.
            gc.collect()

    with small_files(spark), closing(parts()) as tables:
        counts = write_runs_in_parts(spark, roots, tables, run)
    return DocumentCounts(counts[records_root], counts[dead_letter_root])


def _split(
    spark: SparkSession, group: FileGroup, schema: T.StructType, run: Run
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The records and the dead letters of some documents, readable until the next is asked for."""
    stage_path = shared_scratch(spark, f"documents-{run.run_id}")

    def staged(**frames: DataFrame) -> list[DataFrame]:
        write_together({f"{stage_path}/{name}": frame for name, frame in frames.items()})
        return [spark.read.schema(frame.schema).parquet(f"{stage_path}/{name}") for name, frame in frames.items()]

    try:
        rows, sound = staged(rows=read_with_source(spark, group, schema), sound=sound_files(spark, group, schema))
        damaged = (
            rows.groupBy(SOURCE_FILE)
            .agg(F.count("*").alias("row_count"), F.count_if(F.col(EMPTY_ROW)).alias("lost_row_count"))
            .join(sound, SOURCE_FILE, "left_anti")
        )
        (damaged,) = staged(damaged=damaged)
        columns = [F.col(f"`{name}`") for name in schema.names]
        # A row that holds nothing is a record where its document lost nothing.
        empty = rows.where(EMPTY_ROW).join(sound, SOURCE_FILE, "left_semi")
        records = rows.where(~F.col(EMPTY_ROW)).select(*columns).unionAll(empty.select(*columns))
        texts = texts_of(spark, group, damaged).withColumnRenamed("value", "document_text")
        yield records, damaged.join(texts, SOURCE_FILE)
    finally:
        discard_scratch(spark, stage_path)
