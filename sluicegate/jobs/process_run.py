r"""Landed JSON through silver and gold to the run report, in one application.

    spark-submit --py-files sluicegate.zip sluicegate/jobs/process_run.py \
        --run-id R --bronze-path P --base B \
        --source S --category C
"""

from __future__ import annotations

from sluicegate.jobs import options as common
from sluicegate.plans import Roots, process_run


def main(argv: list[str] | None = None) -> None:
    parser = common.parser("bronze to gold with a report")
    parser.add_argument("--bronze-path", required=True)
    parser.add_argument("--base", required=True, help="folder of the table roots")
    parser.add_argument("--source", required=True)
    parser.add_argument("--category", required=True)
    parser.add_argument("--json-documents", action="store_true")
    options = parser.parse_args(argv)
    spark = common.session("process-run", options)
    report = process_run(
        spark,
        options.bronze_path,
        common.run(options),
        Roots.under(options.base),
        source=options.source,
        category=options.category,
        multi_line=options.json_documents,
    )
    print(report.toJSON().first())


if __name__ == "__main__":
    main()
