"""Input frames derived from the test tables.

The tables hold no nulls or faults that suit the quality rules, so raw product records
are derived from line items and parts.  The join only prepares input.  Every query derives them anew, so it
reads the tables as they are, and its time holds that work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.sources import PACKED_LINES

# Columns that trace a derived record back to its line item.
TRACE = ("l_orderkey", "l_linenumber", "l_partkey")

# Orders whose records share a page, and a document.
ORDERS_PER_PAGE = 25
ORDERS_PER_DOCUMENT = 100

# Documents that share a folder, as a power of two.
DOCUMENTS_PER_FOLDER_BITS = 10

# How files of pages, one a line, are written: like landed lines, but a page holds about a hundred records.
PACKED_PAGES = {**PACKED_LINES, "maxRecordsPerFile": PACKED_LINES["maxRecordsPerFile"] // 100}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(moment: Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, whatever the session time zone."""
    days = F.unix_date(moment.cast("date")).cast("long")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def _unless(missing: Column, value: Column) -> Column:
    return F.when(~missing, value)


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items, spread over all tasks: a small table is one row group, which one task would read and work on."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "lineitem").repartition(width, "l_orderkey", "l_linenumber")


def _with_parts(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    return items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def traced_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw product record per line item, with its trace columns."""
    return _derived(_with_parts(spark, sf_dir, line_items(spark, sf_dir)))


def _derived(joined: DataFrame, *further: str) -> DataFrame:
    """The product records of line items with their parts, with trace columns and further ones."""
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    k = order * 7 + line
    no_nutrients = (line == 7) & (part % 3 == 0)
    part_text = part.cast("string")
    brand = F.col("p_brand")

    return joined.select(
        *TRACE,
        *further,
        _unless((k % 53 == 0) & (line <= 3), part_text).alias("_id"),
        F.when(k % 53 == 0, F.lit(None).cast("string"))
        .when(k % 59 == 0, F.lit("  "))
        .when(k % 61 == 0, F.lit(""))
        .otherwise(part_text)
        .alias("code"),
        _unless((order + line) % 47 == 0, F.concat(F.lit("  "), "p_name", F.lit(" "))).alias(
            "product_name"
        ),
        F.when(part % 11 == 0, F.lit(None).cast("string"))
        .when(part % 17 == 0, F.lit("   "))
        .when(part % 13 == 0, F.concat(F.lit(" "), F.lower(brand), F.lit(" ")))
        .otherwise(brand)
        .alias("brands"),
        F.col("p_type").alias("categories"),
        F.concat(F.lit("Nation "), (F.col("l_suppkey") % 25).cast("string")).alias("countries"),
        _unless(line >= 5, F.lit("cocoa, sugar")).alias("ingredients_text"),
        F.lit("").alias("allergens"),
        _unless(part % 19 == 0, F.upper(F.substring("p_type", 1, 1))).alias("nutrition_grades"),
        _unless(k % 43 == 0, epoch_seconds(F.col("l_shipdate"))).alias("last_modified_t"),
        F.struct(
            _unless(no_nutrients, F.col("l_extendedprice") / 100).alias("energy-kcal_100g"),
            _unless(no_nutrients, F.col("l_quantity")).alias("fat_100g"),
            _unless(
                no_nutrients | (F.col("l_quantity") > 40), F.col("l_discount") * 100
            ).alias("proteins_100g"),
            _unless(no_nutrients, F.col("l_tax") * 100 - F.lit(0.01)).alias("salt_100g"),
            _unless(no_nutrients, F.col("l_quantity") * F.lit(2.2)).alias("sugars_100g"),
        ).alias("nutriments"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product records only."""
    return traced_products(spark, sf_dir).drop(*TRACE)


def product_pages(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    """The records as response pages, each with those of ``ORDERS_PER_PAGE`` neighbouring order keys.

    With ``extra`` records hold fields that no schema names.  The tables' own columns are dealt out by page, and the
    records, several times as wide, derived where they are collected.
    """
    page_no = F.floor(F.col("l_orderkey") / ORDERS_PER_PAGE)
    joined = _with_parts(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    records = _derived(joined.withColumn("page_no", page_no).repartition("page_no"), "page_no")
    names = [c for c in records.columns if c not in (*TRACE, "page_no")]
    if extra:
        records = records.withColumn("extra", F.concat(F.lit("x"), F.col("l_orderkey").cast("string")))
        names.append("extra")
    return (
        records.groupBy("page_no").agg(F.collect_list(F.struct(*names)).alias("products")).select("products")
    )


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (``document``, ``value``) with lists of records in which much is wrong.

    What is wrong with a record depends on its line number, and with a document on its own number.  Elements are in the
    order of their texts.
    """
    line, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    quantity = F.col("l_quantity").cast("long").cast("string")
    middle = (
        F.when(line == 1, F.concat(F.lit('"code":'), part, F.lit(',"nutriments":{"fat_100g":'), quantity, F.lit("}")))
        .when(line == 2, F.concat(F.lit('"code":"'), part, F.lit('","nutriments":[]')))
        .when(line == 3, F.concat(F.lit('"code":"'), part, F.lit('","last_modified_t":1.5')))
        .when(line == 4, F.concat(F.lit('"code":"'), part, F.lit('","last_modified_t":"12","nutriments":{"salt_100g":"35.0"}')))
        .when(line == 5, F.lit(""))
        .when(line == 6, F.concat(F.lit('"_id":"'), part, F.lit('","unknown":{"x":1}')))
        .otherwise(F.concat(F.lit('"code":"'), part, F.lit('","last_modified_t":'), quantity))
    )
    elements = line_items(spark, sf_dir).select(
        F.floor(F.col("l_orderkey") / ORDERS_PER_DOCUMENT).alias("document"),
        F.concat(F.lit("{"), middle, F.lit("}")).alias("element"),
    )
    joined = F.array_join(F.array_sort(F.collect_list("element")), ",")
    kind = F.col("document") % 5
    end = F.when(kind == 0, ',{"co').when(kind == 1, ",7]").otherwise("]")
    return elements.groupBy("document").agg(joined.alias("list")).select(
        "document", F.concat(F.lit("["), "list", end).alias("value")
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """Each document as a file of its own, put in place by the task that writes it.

    A task deals its documents out to folders of its own, as it meets them: a folder's names are listed as a whole.
    """
    files = {"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}
    folder = F.shiftright(F.monotonically_increasing_id(), DOCUMENTS_PER_FOLDER_BITS).alias("folder")
    documents.select("value", folder).write.options(**files).partitionBy("folder").text(path)
