r"""One run of a silver catalog table to the summary tables.

    spark-submit --py-files sluicegate.zip sluicegate/jobs/silver_to_gold.py \
        --run-id R --processing-date D \
        --silver-table T --gold-root G
"""

from __future__ import annotations

from sluicegate.jobs import options as common
from sluicegate.operators import top_groups
from sluicegate.plans.bronze_to_silver import counts_frame
from sluicegate.plans.silver_to_gold import CANONICAL_BRAND_TABLE, GoldResult, silver_to_gold
from sluicegate.sources import read_run, read_table_run


def main(argv: list[str] | None = None) -> GoldResult:
    parser = common.parser("silver to gold")
    parser.add_argument("--silver-table", required=True)
    parser.add_argument("--gold-root", required=True)
    parser.add_argument("--source-count", type=int, help="with the next: adds the quality table")
    parser.add_argument("--quarantined-count", type=int)
    options = parser.parse_args(argv)
    if (options.source_count is None) != (options.quarantined_count is None):
        parser.error("--source-count and --quarantined-count go together")
    spark = common.session("silver-to-gold", options)
    run = common.run(options)
    silver = read_table_run(spark, options.silver_table, run)
    counts = None
    if options.source_count is not None:
        counts = counts_frame(spark, options.source_count, options.quarantined_count)
    result = silver_to_gold(silver, run, options.gold_root, counts, canonical_brands=True)
    for name, path in result.paths.items():
        print(f"{name}: {result.row_counts[name]} rows in {path}")
    brands = read_run(spark, f"{options.gold_root.rstrip('/')}/{CANONICAL_BRAND_TABLE}", run)
    top_groups(brands, "brand", 20).show(20, truncate=False)
    return result


if __name__ == "__main__":
    main()
