"""Every registered query against its SQL on another engine, and the shape of its plan."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from sluicegate.workload.oracles import oracle_sql
from sluicegate.workload.registry import queries
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()

# SQL names of Spark's types.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

# Rows at sf0.001, counted independently when the records were designed.
ROW_COUNTS = {
    "json_scan": 6000,
    "route_accepted": 4605,
    "route_quarantine": 1395,
    "dedup_latest": 200,
    "dedup_latest_events": 15,
    "rule_range_accounts": 24,
    "brand_summary": 36,
    "brand_summary_canonical": 26,
    "grade_summary": 6,
    "quarantine_breakdown": 20,
    "run_quality": 1,
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    expected = tables.sql(oracle_sql()[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPE_NAMES[t] for c, t in frame.dtypes} == types

    plan = plan_of(frame)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert unwanted not in plan

    rows = [tuple(r) for r in frame.select(*columns).collect()]
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert sorted(rows, key=repr) == sorted(expected.project(quoted).fetchall(), key=repr)
    assert len(rows) == ROW_COUNTS.get(name, len(rows))


@pytest.mark.parametrize("name", ["grade_summary", "stage_counts"])
def test_summaries_read_only_their_columns(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for scan in plan.split("FileScan parquet [")[1:]:
        columns = scan.split("]")[0]
        # Of the wide source rows only what the derived records and rules are made of.
        assert not any(unused in columns for unused in ("l_returnflag", "l_linestatus", "p_retailprice"))


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:2] == ["brand", "product_count"]
    assert frame.count() == 36
