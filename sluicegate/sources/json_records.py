"""JSON records through an explicit schema."""

from __future__ import annotations

from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.sources.grouped_files import GLOB, FileGroup

_ENVELOPE = "page_records"
SOURCE_FILE = "source_file"
EMPTY_ROW = "_empty_row"

# Files that are named one by one when they are read again; Spark lists each name in a task of its own.
MOST_NAMED = 1_000


def _reading(spark: SparkSession, path: str | list[str] | FileGroup) -> tuple[DataFrameReader, str | list[str]]:
    if isinstance(path, FileGroup):
        return spark.read.options(**path.options), list(path.patterns)
    return spark.read, path


def read_json(
    spark: SparkSession,
    path: str | list[str] | FileGroup,
    schema: T.StructType,
    *,
    multi_line: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read JSON with a fixed schema; nothing is inferred.

    ``multi_line`` reads one document per file, where a root array gives one row per
    element.  Such a file is a single task, so large data should come as one record
    per line (``multi_line=False``), which Spark splits.

    A value of the wrong shape becomes NULL and a document that does not parse becomes
    one all-NULL row.  ``corrupt_column`` adds the raw text of such records; of a document that is one array per
    file each row gets it, for which the file is read again.
    """
    reader, path = _reading(spark, path)
    reader = reader.option("multiLine", multi_line)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def _sources(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*(F.col(f"`{name}`") for name in names), F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_with_source(
    spark: SparkSession, path: str | list[str] | FileGroup, schema: T.StructType, *, multi_line: bool = True
) -> DataFrame:
    """``read_json`` with each row's file, and whether the row holds nothing (``EMPTY_ROW``)."""
    rows = _sources(read_json(spark, path, schema, multi_line=multi_line), schema.names)
    return rows.withColumn(EMPTY_ROW, _holds_nothing(schema))


def sound_files(spark: SparkSession, path: str | list[str] | FileGroup, schema: T.StructType) -> DataFrame:
    """The files whose document has rows and lost nothing in the reading, one row each.

    A document that does not parse or holds a value of the wrong shape is left out by the reader as a whole.  It would also
    give such a document's text, with each of its rows, but reads the file once more for each of them.
    """
    reader, path = _reading(spark, path)
    reader = reader.option("multiLine", True).option("mode", "DROPMALFORMED")
    rows = _sources(reader.schema(schema).json(path), schema.names)
    # Only values that are asked for are looked at, so all of them are.
    return rows.groupBy(SOURCE_FILE).agg(F.count_if(_holds_nothing(schema)).alias("empty_row_count"))


def _holds_nothing(schema: T.StructType) -> Column:
    return reduce(and_, (F.col(f"`{name}`").isNull() for name in schema.names))


def _pages(spark: SparkSession, path: str | list[str], envelope: str, multi_line: bool) -> DataFrame:
    """Every page's envelope, and the file it comes from."""
    return (
        spark.read.schema(T.StructType([T.StructField(envelope, T.ArrayType(T.StringType()))]))
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.col(f"`{envelope}`").alias(_ENVELOPE), F.col("_metadata.file_path").alias(SOURCE_FILE))
    )


def _refused(texts: DataFrame) -> DataFrame:
    """No rows, or an error if a text is a list."""
    refused = F.raise_error(F.lit("a page did not contain a list of records, it is one"))
    is_list = F.col("value").rlike(r"^\s*\[")
    return texts.where(F.when(is_list, refused.cast("boolean")).otherwise(F.lit(False)))


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    *,
    envelope: str = "products",
    multi_line: bool = True,
    checked: bool = True,
) -> DataFrame:
    """Response pages, each an object that holds a list of records under ``envelope``.

    The records stay JSON text, as the file has it.  A page without the envelope (or with a null one)
    has no records.  A page that is not JSON, whose envelope is not a list, or that is a list itself
    fails the read: unlike a bad field, it would lose a whole page of records.

    The reader takes the elements of a root list for pages without an envelope, so finding one takes a second
    reading of the files as text.  A caller that counts such pages anyway leaves it out, with ``checked=False``, and
    calls ``refuse_lists`` where there are some.
    """
    pages = _pages(spark, path, envelope, multi_line).select(_ENVELOPE)
    if not checked:
        return pages
    none = _refused(spark.read.text(path, wholetext=multi_line))
    return pages.unionAll(none.select(F.lit(None).cast(pages.schema[_ENVELOPE].dataType).alias(_ENVELOPE)))


def refuse_lists(
    spark: SparkSession, path: str | list[str], *, envelope: str = "products", multi_line: bool = True
) -> None:
    """Raise an error if a page is a list, reading the text of those files only that gave a page without an envelope."""
    suspects = _pages(spark, path, envelope, multi_line).where(F.col(_ENVELOPE).isNull()).select(SOURCE_FILE).distinct()
    _refused(texts_of(spark, path, suspects, multi_line=multi_line)).count()


def texts_of(
    spark: SparkSession, path: str | list[str] | FileGroup, files: DataFrame, *, multi_line: bool = True
) -> DataFrame:
    """The text (``value``) of those files under ``path`` that ``files`` names, one row a file or a line."""
    few = [row[0] for row in files.select(SOURCE_FILE).limit(MOST_NAMED + 1).collect()]
    names = [unquote(name) for name in few]
    named = 0 < len(few) <= MOST_NAMED and not any(GLOB.search(name) for name in names)
    # Else they are too many to name one by one, or a reader would take their names for patterns.
    reader, path = _reading(spark, names if named else path)
    texts = reader.text(path, wholetext=multi_line)
    texts = texts.select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return texts if named else texts.join(files.select(SOURCE_FILE), SOURCE_FILE, "left_semi")


def page_lines(pages: DataFrame) -> DataFrame:
    """The records of all pages as JSON lines (``value``), each in its own text.

    A null element is an empty object and one that is no object a list of it, so that every element
    is a line and reads as a row.
    """
    element = F.explode(_ENVELOPE).alias("value")
    text = F.col("value")
    line = F.when(text.isNull(), "{}").when(F.ltrim(text).startswith("{"), text)
    return pages.select(element).select(line.otherwise(F.to_json(F.array(text))).alias("value"))


def flatten_pages(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """One typed row per record of all pages; an element that is no object is an all-NULL row."""
    return pages.select(F.explode(_ENVELOPE).alias("record")).select(
        F.inline(F.array(F.coalesce(F.from_json("record", schema), F.from_json(F.lit("{}"), schema))))
    )


def page_count_columns() -> list[Column]:
    """Aggregates over pages: how many there are, and how many without an envelope."""
    return [
        F.count("*").alias("page_count"),
        F.count_if(F.col(_ENVELOPE).isNull()).alias("empty_envelope_count"),
    ]


def page_counts(pages: DataFrame) -> DataFrame:
    """One row of ``page_count_columns``."""
    return pages.agg(*page_count_columns())
