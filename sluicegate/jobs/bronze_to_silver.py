r"""Landed JSON to the silver and quarantine tables.

    spark-submit --py-files sluicegate.zip sluicegate/jobs/bronze_to_silver.py \
        --run-id R --bronze-path P \
        --silver-root S --quarantine-root Q
"""

from __future__ import annotations

from sluicegate.jobs import options as common
from sluicegate.plans import PRODUCTS, bronze_to_silver
from sluicegate.sources import read_json


def main(argv: list[str] | None = None) -> None:
    parser = common.parser("bronze to silver")
    parser.add_argument("--bronze-path", required=True)
    parser.add_argument("--silver-root", required=True)
    parser.add_argument("--quarantine-root", required=True)
    parser.add_argument(
        "--json-documents",
        action="store_true",
        help="each file is one JSON document, such as an array, rather than lines",
    )
    options = parser.parse_args(argv)
    spark = common.session("bronze-to-silver", options)
    bronze = read_json(
        spark, options.bronze_path, PRODUCTS.bronze, multi_line=options.json_documents
    )
    result = bronze_to_silver(
        bronze, PRODUCTS, common.run(options), options.silver_root, options.quarantine_root
    )
    print(f"source rows: {result.source_count}")
    print(f"silver rows: {result.valid_count} in {result.silver_path}")
    print(f"quarantined rows: {result.quarantined_count} in {result.quarantine_path}")
    print(f"duplicate rows: {result.duplicate_count}")


if __name__ == "__main__":
    main()
