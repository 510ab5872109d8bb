"""Command-line options the jobs share."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sluicegate.run import Run
from sluicegate.session import MIB, build_session, shuffle_partitions_for


def parser(description: str) -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description=description)
    options.add_argument("--run-id", required=True)
    options.add_argument("--processing-date", help="YYYY-MM-DD; today (UTC) if not given")
    options.add_argument(
        "--input-gib",
        type=float,
        help="size of the input, from which the shuffle width is set",
    )
    return options


def session(app_name: str, options: argparse.Namespace) -> SparkSession:
    width = None
    if options.input_gib:
        width = shuffle_partitions_for(int(options.input_gib * 1024 * MIB))
    return build_session(app_name, shuffle_partitions=width)


def run(options: argparse.Namespace) -> Run:
    return Run.start(run_id=options.run_id, processing_date=options.processing_date)
