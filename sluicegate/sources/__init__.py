"""Readers and writers."""

from sluicegate.sources.catalog import read_table_run, register_table
from sluicegate.sources.grouped_files import FileGroup, file_groups, small_files
from sluicegate.sources.json_records import (
    flatten_pages,
    page_count_columns,
    page_counts,
    page_lines,
    read_json,
    read_pages,
    read_with_source,
    refuse_lists,
    sound_files,
)
from sluicegate.sources.run_tables import (
    PACKED_LINES,
    drop_run,
    land_bronze,
    land_lines,
    read_run,
    run_exists,
    write_run,
    write_runs,
    write_runs_in_parts,
    write_together,
)

__all__ = [
    "FileGroup",
    "PACKED_LINES",
    "drop_run",
    "file_groups",
    "flatten_pages",
    "land_bronze",
    "land_lines",
    "page_count_columns",
    "page_counts",
    "page_lines",
    "read_json",
    "read_pages",
    "read_run",
    "read_table_run",
    "read_with_source",
    "refuse_lists",
    "register_table",
    "run_exists",
    "small_files",
    "sound_files",
    "write_run",
    "write_runs",
    "write_runs_in_parts",
    "write_together",
]
