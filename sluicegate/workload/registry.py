"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions import Between, as_type
from sluicegate.operators import (
    Field,
    Order,
    accepted_rows,
    add_completeness,
    failure_breakdown,
    flag_reasons,
    latest_per_key,
    quarantined_rows,
    rates,
    run_quality_in_one_pass,
    stage_counts,
    stamp_run,
    standardize,
    top_groups,
)
from sluicegate.plans import (
    PRODUCTS,
    Roots,
    bronze_to_silver,
    land_documents,
    land_pages,
    latest_accepted,
    process_pages,
    process_run,
    silver_to_gold,
    validate,
)
from sluicegate.plans.silver_to_gold import (
    BRAND_TABLE,
    CANONICAL_BRAND_TABLE,
    GRADE_TABLE,
    QUALITY_TABLE,
    brand_label,
    brand_summary,
    brand_summary_of_runs,
    canonical_brand_label,
    canonical_brand_summary,
    grade_label,
    grade_summary,
    grade_summary_of_runs,
)
from sluicegate.run import Run
from sluicegate.session import shared_scratch
from sluicegate.sources import (
    PACKED_LINES,
    flatten_pages,
    land_bronze,
    read_json,
    read_pages,
    read_run,
    read_table_run,
    register_table,
    write_run,
)
from sluicegate.workload.inputs import (
    PACKED_PAGES,
    TRACE,
    epoch_seconds,
    product_documents,
    product_pages,
    products,
    table,
    traced_products,
    write_documents,
)

Query = Callable[[SparkSession, str], DataFrame]

RUN = Run("run-a", "2024-03-01", datetime(2024, 3, 1, 12, tzinfo=timezone.utc))
OTHER_RUN = Run("run-b", "2024-03-02", datetime(2024, 3, 2, 12, tzinfo=timezone.utc))

_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Shared chains ---------------------------------------------------------------------


def _flat(bronze: DataFrame) -> DataFrame:
    """Raw records with the nested struct spread out, to compare by value."""
    plain = [c for c in bronze.columns if c != "nutriments"]
    return bronze.select(
        *plain,
        F.col("nutriments.`energy-kcal_100g`").alias("energy_kcal_100g"),
        "nutriments.fat_100g",
        "nutriments.proteins_100g",
        "nutriments.salt_100g",
        "nutriments.sugars_100g",
    )


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(products(spark, sf_dir), PRODUCTS, RUN)


def _traced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standardize(traced_products(spark, sf_dir), PRODUCTS.fields, keep=TRACE)
    return add_completeness(rows, PRODUCTS.scored)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_accepted(_rows(spark, sf_dir), PRODUCTS)


def _fields(spark: SparkSession, sf_dir: str, *targets: str) -> DataFrame:
    chosen = [PRODUCTS.field(target) for target in targets]
    return standardize(traced_products(spark, sf_dir), chosen, keep=TRACE)


def _rule_failures(rows: DataFrame, *labels: str) -> DataFrame:
    flags = (r.fails().alias(r.label) for r in PRODUCTS.rules if r.label in labels)
    return rows.select(*TRACE, *flags)


_EPOCHS = {
    "processed_at": "processed_epoch",
    "source_last_modified_at": "source_last_modified_epoch",
    "generated_at": "generated_epoch",
}


def _with_epochs(rows: DataFrame) -> DataFrame:
    """Timestamps as seconds, which engines print alike."""
    seconds = {new: F.unix_seconds(old) for old, new in _EPOCHS.items() if old in rows.columns}
    return rows.withColumns(seconds).drop(*_EPOCHS)


# Sources and sinks -----------------------------------------------------------------


@_query("json_scan")
def _json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_scratch(spark, 'json-scan')}/records"
    products(spark, sf_dir).write.options(**PACKED_LINES).json(path)
    return _flat(read_json(spark, path, PRODUCTS.bronze, multi_line=False))


@_query("json_props")
def _json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON text column through an explicit schema, summed by event type."""
    props = T.StructType().add("k", T.LongType())
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_type", F.from_json("props", props).alias("props"))
    return parsed.groupBy("event_type").agg(
        F.count("props.k").alias("k_count"), F.sum("props.k").alias("k_sum")
    )


@_query("page_flatten")
def _page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_scratch(spark, 'pages')}/pages"
    product_pages(spark, sf_dir).write.options(**PACKED_PAGES).json(path)
    return _flat(flatten_pages(read_pages(spark, path, multi_line=False), PRODUCTS.bronze))


@_query("bronze_landing")
def _bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch(spark, "bronze")
    land_bronze(products(spark, sf_dir), root, RUN)
    # Reading the root brings the partition columns back; given in the schema, they
    # stay text.
    schema = T.StructType(
        [
            *PRODUCTS.bronze,
            T.StructField("ingestion_date", T.StringType()),
            T.StructField("run_id", T.StringType()),
        ]
    )
    return _flat(read_json(spark, root, schema, multi_line=False))


@_query("run_metadata")
def _run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch(spark, "metadata")
    _landed_pages(spark, sf_dir, root)
    record = read_run(spark, f"{root}/runs", RUN)
    # The path below the root that this run drew.
    landed = F.regexp_extract("product_path", "/([^/]+)/ingestion_date=", 1)
    return record.withColumn("product_path", landed).drop("started_at", "completed_at", "pages_requested")


def _landed_pages(spark: SparkSession, sf_dir: str, root: str, extra: bool = False) -> DataFrame:
    """Pages landed as records below ``pages``, by a clock of its own; the metadata row."""
    product_pages(spark, sf_dir, extra).write.options(**PACKED_PAGES).json(f"{root}/fetched")
    clock = iter(
        (
            datetime(2024, 3, 1, 11, 59, 0, tzinfo=timezone.utc),
            datetime(2024, 3, 1, 12, 0, 1, 256000, tzinfo=timezone.utc),
        )
    )
    return land_pages(
        spark,
        f"{root}/fetched",
        RUN,
        f"{root}/pages",
        f"{root}/runs",
        source="line items",
        category="all",
        page_size=100,
        multi_line=False,
        clock=lambda: next(clock),
    )


@_query("page_landing")
def _page_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed in their own text: fields that no schema named are read by one that does."""
    root = shared_scratch(spark, "page-landing")
    path = _landed_pages(spark, sf_dir, root, extra=True).first()["product_path"]
    schema = T.StructType([*PRODUCTS.bronze, T.StructField("extra", T.StringType())])
    return _flat(read_json(spark, path, schema, multi_line=False))


@_query("json_documents")
def _json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with lists of records split into records and dead letters, in one frame."""
    root = shared_scratch(spark, "documents")
    write_documents(product_documents(spark, sf_dir), f"{root}/fetched")
    land_documents(spark, f"{root}/fetched", PRODUCTS.bronze, RUN, f"{root}/records", f"{root}/letters")
    records = _flat(read_run(spark, f"{root}/records", RUN)).withColumn("side", F.lit("record"))
    letters = read_run(spark, f"{root}/letters", RUN).drop("source_file").withColumn("side", F.lit("letter"))
    # The writer of the files has ended each with a line break.
    letters = letters.withColumn("document_text", F.rtrim("document_text", F.lit("\n")))
    return records.unionByName(letters, allowMissingColumns=True)


@_query("silver_roundtrip")
def _silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch(spark, "silver")
    write_run(_silver(spark, sf_dir), root, RUN)
    return _with_epochs(read_run(spark, root, RUN))


@_query("quarantine_roundtrip")
def _quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch(spark, "quarantine")
    write_run(quarantined_rows(_rows(spark, sf_dir), PRODUCTS.rules), root, RUN)
    return _with_epochs(read_run(spark, root, RUN))


@_query("gold_roundtrip")
def _gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch(spark, "gold")
    summary = brand_summary(_silver(spark, sf_dir))
    write_run(summary, root, RUN)
    text = T.StringType()
    schema = T.StructType([*summary.schema]).add("processing_date", text).add("run_id", text)
    return spark.read.schema(schema).parquet(root)


def _registered_silver(spark: SparkSession, sf_dir: str) -> str:
    """A catalog table that holds the same silver under two runs."""
    root = shared_scratch(spark, "catalog")
    name = f"silver_{root.rsplit('-', 1)[-1]}"
    silver = _silver(spark, sf_dir)
    write_run(silver, root, RUN)
    write_run(read_run(spark, root, RUN, silver.schema), root, OTHER_RUN)
    for run in (RUN, OTHER_RUN):
        register_table(spark, name, root, silver.schema, run)
    return name


@_query("catalog_evolution")
def _catalog_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one catalog table, of which the later has columns that the earlier lacks."""
    root = shared_scratch(spark, "evolution")
    name = f"evolved_{root.rsplit('-', 1)[-1]}"
    silver = _silver(spark, sf_dir)
    write_run(silver, root, OTHER_RUN)
    fewer = read_run(spark, root, OTHER_RUN, silver.schema).drop("salt_100g", "allergens")
    write_run(fewer, root, RUN)
    register_table(spark, name, root, fewer.schema, RUN)
    register_table(spark, name, root, silver.schema, OTHER_RUN)
    return _with_epochs(spark.table(name))


@_query("partition_pruned_scan")
def _partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _registered_silver(spark, sf_dir)
    return _with_epochs(read_table_run(spark, name, RUN))


@_query("sql_top_brands")
def _sql_top_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch(spark, "brands")
    name = f"brands_{root.rsplit('-', 1)[-1]}"
    summary = brand_summary(_silver(spark, sf_dir))
    write_run(summary, root, RUN)
    register_table(spark, name, root, summary.schema, RUN)
    return spark.sql(
        f"""
        SELECT brand, product_count, average_sugars_100g, average_energy_kcal_100g
        FROM {name}
        ORDER BY product_count DESC, brand
        LIMIT 20
        """
    )


# Projections and scalar functions --------------------------------------------------


@_query("resolve_key")
def _resolve_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "barcode")


@_query("trim_fields")
def _trim_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(
        spark,
        sf_dir,
        "product_name",
        "brand",
        "categories",
        "countries",
        "ingredients_text",
        "allergens",
    )


@_query("normalize_grade")
def _normalize_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "nutrition_grade")


@_query("nested_extract")
def _nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(
        spark, sf_dir, "energy_kcal_100g", "fat_100g", "proteins_100g", "salt_100g", "sugars_100g"
    )


@_query("cast_fields")
def _cast_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts of text that may not parse, and of numbers that already have the type."""
    fields = [
        Field("code_number", ("code",), (as_type("long"),)),
        Field("code_double", ("code",), (as_type("double"),)),
        PRODUCTS.field("source_last_modified_timestamp"),
        PRODUCTS.field("energy_kcal_100g"),
    ]
    return standardize(traced_products(spark, sf_dir), fields, keep=TRACE)


@_query("epoch_to_timestamp")
def _epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fields(spark, sf_dir, "source_last_modified_at")
    return rows.select(
        *TRACE, F.unix_seconds("source_last_modified_at").alias("source_last_modified_epoch")
    )


@_query("lineage_columns")
def _lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stamp_run(_fields(spark, sf_dir, "barcode"), RUN)
    return rows.withColumn("processed_epoch", F.unix_seconds("processed_at")).drop("processed_at")


@_query("brand_default")
def _brand_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "brand").select(*TRACE, brand_label().alias("brand_group"))


@_query("grade_default")
def _grade_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fields(spark, sf_dir, "nutrition_grade")
    return rows.select(*TRACE, grade_label().alias("grade_group"))


@_query("brand_initcap")
def _brand_initcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fields(spark, sf_dir, "brand")
    return rows.select(*TRACE, canonical_brand_label().alias("brand_clean"))


@_query("completeness_score")
def _completeness_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _traced_rows(spark, sf_dir).select(*TRACE, "completeness_score")


# Predicates, validation and routing ------------------------------------------------


@_query("rule_missing_key")
def _rule_missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_failures(_traced_rows(spark, sf_dir), "missing_barcode")


@_query("rule_missing_name")
def _rule_missing_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_failures(_traced_rows(spark, sf_dir), "missing_product_name")


@_query("rule_range")
def _rule_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_failures(
        _traced_rows(spark, sf_dir),
        "invalid_sugars_100g",
        "invalid_fat_100g",
        "invalid_proteins_100g",
        "invalid_salt_100g",
    )


@_query("rule_range_accounts")
def _rule_range_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range rule on another table: customers by account balance."""
    rules = [Between("c_acctbal", 0, 9000, "invalid_c_acctbal")]
    return quarantined_rows(table(spark, sf_dir, "customer"), rules)


@_query("rule_energy_range")
def _rule_energy_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_failures(_traced_rows(spark, sf_dir), "invalid_energy_kcal_100g")


@_query("rejection_reason")
def _rejection_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_reasons(_traced_rows(spark, sf_dir), PRODUCTS.rules)
    return flagged.select(*TRACE, "rejection_reason")


@_query("route_quarantine")
def _route_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quarantined_rows(_traced_rows(spark, sf_dir), PRODUCTS.rules)
    return rows.select(*TRACE, "barcode", "product_name", "completeness_score", "rejection_reason")


@_query("route_accepted")
def _route_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted_rows(_traced_rows(spark, sf_dir), PRODUCTS.rules)
    return rows.select(*TRACE, "barcode", "product_name", "completeness_score")


# Window ----------------------------------------------------------------------------


@_query("dedup_latest")
def _dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_epochs(_silver(spark, sf_dir))


@_query("dedup_latest_events")
def _dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on another table: each user's last event."""
    events = table(spark, sf_dir, "events")
    latest = latest_per_key(events, ("user_id",), (Order("ts", descending=True), Order("event_id")))
    return latest.withColumn("ts_epoch", epoch_seconds(F.col("ts"))).drop("ts")


# Aggregations ----------------------------------------------------------------------


@_query("brand_summary")
def _brand_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = brand_summary(_silver(spark, sf_dir), key="barcode")
    return summary.orderBy(F.desc("product_count"), F.asc("brand"))


@_query("brand_summary_canonical")
def _brand_summary_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_brand_summary(_silver(spark, sf_dir))


@_query("grade_summary")
def _grade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_summary(_silver(spark, sf_dir), key="barcode").orderBy("nutrition_grade")


@_query("run_quality")
def _run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_quality_in_one_pass(_rows(spark, sf_dir), PRODUCTS.rules, PRODUCTS.key, PRODUCTS.latest)


def _silver_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of two runs, each of two thirds of the orders."""
    rows = stamp_run(_traced_rows(spark, sf_dir), RUN)
    thirds = (rows.where(F.col("l_orderkey") % 3 != left_out) for left_out in (0, 1))
    return reduce(DataFrame.unionAll, (latest_accepted(third, PRODUCTS) for third in thirds))


@_query("brand_summary_runs")
def _brand_summary_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys and averages per brand over two runs, from one exchange by key."""
    return brand_summary_of_runs(_silver_of_runs(spark, sf_dir), "barcode")


@_query("grade_summary_runs")
def _grade_summary_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_summary_of_runs(_silver_of_runs(spark, sf_dir), "barcode")


@_query("route_rates")
def _route_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stage_counts(_rows(spark, sf_dir), PRODUCTS.rules, PRODUCTS.key)
    return rates(counts).select("acceptance_rate", "quarantine_rate")


@_query("quarantine_breakdown")
def _quarantine_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_breakdown(_rows(spark, sf_dir), PRODUCTS.rules)


@_query("stage_counts")
def _stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_counts(_rows(spark, sf_dir), PRODUCTS.rules, PRODUCTS.key)


@_query("top_brands")
def _top_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_groups(canonical_brand_summary(_silver(spark, sf_dir)), "brand", 20)


# Composed jobs ---------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str, base: str) -> str:
    return land_bronze(products(spark, sf_dir), f"{base}/bronze", RUN)


@_query("bronze_to_silver")
def _bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of the job in one frame."""
    base = shared_scratch(spark, "to-silver")
    bronze = read_json(spark, _landed(spark, sf_dir, base), PRODUCTS.bronze, multi_line=False)
    roots = Roots.under(base)
    bronze_to_silver(bronze, PRODUCTS, RUN, roots.silver, roots.quarantine)
    silver = read_run(spark, roots.silver, RUN).withColumn("side", F.lit("silver"))
    rejected = read_run(spark, roots.quarantine, RUN).withColumn("side", F.lit("quarantine"))
    return _with_epochs(silver.unionByName(rejected, allowMissingColumns=True))


@_query("silver_to_gold")
def _silver_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the job in one frame, missing columns NULL."""
    base = shared_scratch(spark, "to-gold")
    roots = Roots.under(base)
    result = bronze_to_silver(
        products(spark, sf_dir), PRODUCTS, RUN, roots.silver, roots.quarantine
    )
    silver_to_gold(
        read_run(spark, roots.silver, RUN),
        RUN,
        roots.gold,
        result.counts(spark),
        canonical_brands=True,
    )
    brands, canonical, grades, quality = (
        read_run(spark, f"{roots.gold}/{name}", RUN).withColumn("gold_table", F.lit(name))
        for name in (BRAND_TABLE, CANONICAL_BRAND_TABLE, GRADE_TABLE, QUALITY_TABLE)
    )
    union = brands
    for other in (canonical, grades, quality):
        union = union.unionByName(other, allowMissingColumns=True)
    return _with_epochs(union)


@_query("run_report")
def _run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a whole run from landed records."""
    base = shared_scratch(spark, "run")
    report = process_run(
        spark,
        _landed(spark, sf_dir, base),
        RUN,
        Roots.under(base),
        source="line items",
        category="all",
        multi_line=False,
    )
    return _flat_report(report)


@_query("pages_to_report")
def _pages_to_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, from fetched pages to the report."""
    base = shared_scratch(spark, "pages-to-report")
    product_pages(spark, sf_dir).write.options(**PACKED_PAGES).json(f"{base}/fetched")
    report = process_pages(
        spark,
        f"{base}/fetched",
        RUN,
        Roots.under(base),
        source="line items",
        category="all",
        page_size=100,
        multi_line=False,
    )
    return _flat_report(report)


def _flat_report(report: DataFrame) -> DataFrame:
    """A report without its clock and paths, its map written out as text."""
    pairs = F.transform(
        F.array_sort(F.map_entries("quarantine_breakdown")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    paths = [c for c in report.columns if c.endswith("_path")]
    return report.withColumn("quarantine_breakdown", F.array_join(pairs, " | ")).drop(
        "generated_at", *paths
    )
