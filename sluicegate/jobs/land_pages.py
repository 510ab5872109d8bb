r"""Fetched response pages to landed bronze records.

    spark-submit --py-files sluicegate.zip sluicegate/jobs/land_pages.py \
        --run-id R --pages-path P --bronze-root B --metadata-root M \
        --source S --category C --page-size N
"""

from __future__ import annotations

from sluicegate.jobs import options as common
from sluicegate.plans import land_pages


def main(argv: list[str] | None = None) -> None:
    parser = common.parser("pages to bronze")
    parser.add_argument("--pages-path", required=True)
    parser.add_argument("--bronze-root", required=True)
    parser.add_argument("--metadata-root", required=True)
    parser.add_argument("--source", required=True)
    parser.add_argument("--category", required=True)
    parser.add_argument("--page-size", type=int, required=True)
    parser.add_argument("--pages-requested", type=int)
    parser.add_argument(
        "--page-lines", action="store_true", help="files hold one page per line"
    )
    options = parser.parse_args(argv)
    metadata = land_pages(
        common.session("land-pages", options),
        options.pages_path,
        common.run(options),
        options.bronze_root,
        options.metadata_root,
        source=options.source,
        category=options.category,
        page_size=options.page_size,
        pages_requested=options.pages_requested,
        multi_line=not options.page_lines,
    )
    print(metadata.toJSON().first())


if __name__ == "__main__":
    main()
