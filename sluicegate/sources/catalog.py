"""Run tables in the catalog, for SQL."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.run import Run

# Columns that exist only as directory names; text, so that a date stays as written.
PARTITION_FIELDS = (
    T.StructField("processing_date", T.StringType()),
    T.StructField("run_id", T.StringType()),
)


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _bare(path: str) -> str:
    """A local path with or without its scheme, and with no slash at its end, in one form."""
    bare = path.rstrip("/")
    return re.sub("^file:/+", "/", bare)


def _evolve(spark: SparkSession, table: str, root: str, fields: Sequence[T.StructField]) -> None:
    """Add a run's new columns to a table, after checking those that it has."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").first()
    if described and _bare(described["data_type"]) != _bare(root):
        raise ValueError(f"{table} lies in {described['data_type']}, not in {root}")
    known = {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema}
    new = [f for f in fields if f.name.lower() not in known]
    for field in fields:
        kind = known.get(field.name.lower())
        if kind and kind != field.dataType.simpleString():
            raise ValueError(f"{table}.{field.name} is {kind}, not {field.dataType.simpleString()}")
    if new:
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD COLUMNS ({T.StructType(new).toDDL()})")


def register_table(
    spark: SparkSession, table: str, root: str, schema: T.StructType, run: Run
) -> None:
    """Make the run table under ``root`` queryable as ``table``, with this run's partition.

    The catalog keeps its own list of partitions, to which the run is added without
    listing the others.  Columns that the table does not have yet are added to it, and read as NULL from earlier
    runs; a run that lacks columns of the table reads as NULL there.  A column of another type, or another
    place of the table, is refused: old files could not be read any more.
    """
    named = {field.name for field in PARTITION_FIELDS}
    own = [T.StructField(f.name, f.dataType) for f in schema if f.name not in named]
    if spark.catalog.tableExists(table):
        _evolve(spark, table, root, own)
    else:
        columns = T.StructType([*own, *PARTITION_FIELDS]).toDDL()
        partitions = ", ".join(field.name for field in PARTITION_FIELDS)
        location = root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING parquet "
            f"PARTITIONED BY ({partitions}) LOCATION '{location}'"
        )
    spark.sql(
        f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS PARTITION "
        f"(processing_date = '{run.processing_date}', run_id = '{run.run_id}')"
    )
    spark.catalog.refreshTable(table)


def read_table_run(spark: SparkSession, table: str, run: Run) -> DataFrame:
    """One run's rows of a catalog table; both predicates prune partitions."""
    return spark.table(table).where(
        (F.col("processing_date") == run.processing_date) & (F.col("run_id") == run.run_id)
    )
