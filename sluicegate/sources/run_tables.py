"""Tables laid out by run.

A run owns one partition directory and replaces it as a whole.  Writing to that
directory, rather than overwriting partitions dynamically, also replaces rows when the
re-run has none: a dynamic overwrite of an empty result would leave the old rows.

The new partition is written to a hidden folder beside it, which no reader lists, and moved into place when it is
complete; the partitions of tables that belong together are moved when all of them are.  A run that
fails while it writes leaves the old rows of every table readable.  Moving is a rename for each partition,
undone if one of them fails.  On an object store a rename copies, and lasts as long as that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluicegate.run import Run

# Readers skip folders whose names begin with a dot.
_HIDDEN = ".incoming"
_REPLACED = ".replaced"

# How lines of JSON are written.  Compressed they take a tenth of their size, most of which is the names of fields.  Such
# a file is not split, so its lines are few: a task takes up to 32 files, and one that writes several partitions sorts them.
PACKED_LINES = {"compression": "gzip", "maxRecordsPerFile": 50_000}


@dataclass(frozen=True)
class _Aside:
    """A partition written but not in place yet."""

    incoming: str
    replaced: str
    final: str


def _aside(root: str, run: Run, date_column: str = "processing_date") -> _Aside:
    base, token = root.rstrip("/"), uuid.uuid4().hex
    hidden = (f"{base}/{name}-{token}" for name in (_HIDDEN, _REPLACED))
    return _Aside(*hidden, run.directory(root, date_column))


class Files:
    """Renames and deletions on whatever file system a path is on."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        location = self._path(path)
        return location.getFileSystem(self._conf), location

    def move(self, source: str, target: str) -> None:
        files, place = self._at(target)
        files.mkdirs(place.getParent())
        if not files.rename(self._path(source), place):
            raise OSError(f"could not move {source} to {target}")

    def exists(self, path: str) -> bool:
        files, place = self._at(path)
        return files.exists(place)

    def delete(self, path: str) -> None:
        files, place = self._at(path)
        files.delete(place, True)


def _swap(spark: SparkSession, written: Sequence[_Aside]) -> None:
    """Put all written partitions in place of the old ones, or none."""
    files = Files(spark)
    moves: list[tuple[str, str]] = []
    try:
        for one in written:
            steps = [(one.final, one.replaced)] if files.exists(one.final) else []
            for source, target in [*steps, (one.incoming, one.final)]:
                files.move(source, target)
                moves.append((source, target))
    except BaseException:
        for source, target in reversed(moves):
            files.move(target, source)
        raise
    for one in written:
        files.delete(one.replaced)


def _discard(spark: SparkSession, asides: Sequence[_Aside]) -> None:
    files = Files(spark)
    for one in asides:
        files.delete(one.incoming)


def _replace(
    rows: DataFrame,
    aside: _Aside,
    fmt: str,
    check: Callable[[], None] | None = None,
    options: Mapping[str, str | int] | None = None,
) -> str:
    spark = rows.sparkSession
    try:
        rows.write.format(fmt).options(**(options or {})).save(aside.incoming)
        if check:
            check()
        _swap(spark, [aside])
    except BaseException:
        _discard(spark, [aside])
        raise
    return aside.final


def write_run(rows: DataFrame, root: str, run: Run, fmt: str = "parquet") -> str:
    """Replace this run's partition and return its path.

    The partition columns are the path, so the files hold only ``rows``' columns.
    """
    return _replace(rows, _aside(root, run), fmt)


def read_run(
    spark: SparkSession, root: str, run: Run, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of one run; no other partition is listed.

    With a known ``schema`` no file is opened to find it.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(run.directory(root))


def write_runs(tables: Mapping[str, DataFrame], run: Run) -> dict[str, int]:
    """Write this run's partition of several tables, by root, and count their rows.

    The tables are submitted together, so that one fills the cores which the last tasks of
    another leave idle.  Rows are counted from the files' footers.  Old partitions are replaced when all tables
    are written, or not at all.
    """
    spark = next(iter(tables.values())).sparkSession
    return write_runs_in_parts(spark, tables, [tables], run)


def write_runs_in_parts(
    spark: SparkSession, roots: Iterable[str], parts: Iterable[Mapping[str, DataFrame]], run: Run
) -> dict[str, int]:
    """``write_runs`` of tables that come in parts, one after another; a part may be made when its turn comes."""
    asides = {root: _aside(root, run) for root in roots}
    schemas: dict[str, T.StructType] = {}

    def count(root: str) -> int:
        return spark.read.schema(schemas[root]).parquet(asides[root].incoming).count()

    try:
        for tables in parts:
            write_together({asides[root].incoming: rows for root, rows in tables.items()})
            schemas = {root: rows.schema for root, rows in tables.items()}
            del tables  # the next part is made without this one in memory
        counts = {root: count(root) for root in asides}
        _swap(spark, list(asides.values()))
    except BaseException:
        _discard(spark, list(asides.values()))
        raise
    return counts


def write_together(tables: Mapping[str, DataFrame]) -> None:
    """Add rows to the folders they are given for, submitted together."""
    spark = next(iter(tables.values())).sparkSession

    def write(path: str) -> None:
        tables[path].write.mode("append").parquet(path)

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        # Each thread gets its own copy of the caller's job settings (group, pool, tags).
        writes = [pool.submit(inheritable_thread_target(spark)(write), path) for path in tables]
    for done in writes:
        done.result()


def land_bronze(records: DataFrame, root: str, run: Run) -> str:
    """Land typed records as JSON, one per line, under their ingestion date and run.

    Lines let any number of tasks share the landed data, and landing before any transformation lets a
    run be repeated without asking the source again.  They are packed like those of ``land_lines``.
    """
    return _replace(records, _aside(root, run, "ingestion_date"), "json", options=PACKED_LINES)


def land_lines(
    lines: DataFrame, root: str, run: Run, check: Callable[[], None] | None = None
) -> str:
    """Land JSON lines as they are: fields and values that no schema names are kept.

    ``check`` is called when the lines are written and before they replace others, and may refuse them.  The files are
    compressed, and a large one is split by its number of lines, as ``PACKED_LINES`` says.
    """
    return _replace(lines, _aside(root, run, "ingestion_date"), "text", check, PACKED_LINES)


def run_exists(spark: SparkSession, root: str, run: Run) -> bool:
    """Whether the run's partition is in place; it is complete then."""
    return Files(spark).exists(run.directory(root))


def drop_run(spark: SparkSession, root: str, run: Run) -> None:
    """Take the run's partition away, if there is one."""
    Files(spark).delete(run.directory(root))
