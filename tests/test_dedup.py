from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sluicegate.functions import Between
from sluicegate.operators import (
    Order,
    latest_and_counts,
    latest_per_key,
    route_counts,
    run_quality,
    run_quality_in_one_pass,
    stage_counts,
)
from sluicegate.plans import PRODUCTS, latest_accepted, validate
from sluicegate.workload.registry import queries
from tests.conftest import plan_of, record


def _names(frame) -> dict:
    return {r.barcode: r.product_name for r in frame.select("barcode", "product_name").collect()}


def test_which_row_is_kept(bronze, run):
    rows = validate(
        bronze(
            record(code="newer", product_name="old", last_modified_t=1),
            record(code="newer", product_name="new", last_modified_t=2),
            record(code="dated", product_name="none", last_modified_t=None),
            record(code="dated", product_name="some", last_modified_t=-5),
            # A newer row that fails a rule hides nothing.
            record(code="hidden", product_name="valid", last_modified_t=1),
            record(code="hidden", product_name="invalid", last_modified_t=9, fat_100g=500.0),
            # A tie goes to the first by content, nulls first.
            record(code="tied", product_name="b"),
            record(code="tied", product_name="a", brands="x"),
            record(code="tied", product_name="a", brands=None, categories="won"),
            # Padding makes another key.
            record(code=" padded", product_name="p1"),
            record(code="padded", product_name="p2"),
        ),
        PRODUCTS,
        run,
    )
    silver = latest_accepted(rows, PRODUCTS)
    assert _names(silver) == {
        "newer": "new",
        "dated": "some",
        "hidden": "valid",
        "tied": "a",
        " padded": "p1",
        "padded": "p2",
    }
    assert silver.where("barcode = 'tied'").first().categories == "won"


def test_a_hot_key_matches_brute_force(spark):
    """A third of the rows share one key, and a third are copies of one row."""
    rng = random.Random(7)
    data = [("hot", rng.randrange(50), rng.randrange(50)) for _ in range(3000)]
    data += [("copy", 1, 1)] * 3000
    data += [(f"k{rng.randrange(900)}", rng.randrange(50), rng.randrange(50)) for _ in range(3000)]
    rng.shuffle(data)
    best: dict = {}
    for key, t, v in data:
        if key not in best or (-t, v) < best[key]:
            best[key] = (-t, v)
    frame = spark.createDataFrame(data, "k string, t long, v long").repartition(7)
    kept = latest_per_key(frame, ("k",), (Order("t", descending=True), Order("v")))
    assert {r.k: (-r.t, r.v) for r in kept.collect()} == best
    assert kept.count() == len(best)


def test_only_one_row_per_key_and_task_is_shuffled(spark):
    frame = spark.range(0, 8000, 1, 4).select((F.col("id") % 1).alias("k"), F.col("id").alias("t"))
    kept = latest_per_key(frame, ("k",), (Order("t", descending=True),))
    assert [tuple(r) for r in kept.collect()] == [(0, 7999)]
    below_exchange = plan_of(kept).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange
    assert "Partial" in below_exchange


def test_counts_account_for_every_row(bronze, run):
    rows = validate(
        bronze(
            record(code="a"),
            record(code="a"),
            record(code="b"),
            record(code="b", salt_100g=200.0),
            record(code=None, _id=None),
        ),
        PRODUCTS,
        run,
    )
    counts = stage_counts(rows, PRODUCTS.rules, PRODUCTS.key).first()
    assert tuple(counts) == (5, 2, 2, 1)
    assert tuple(route_counts(rows, PRODUCTS.rules).first()) == (5, 2)
    assert latest_accepted(rows, PRODUCTS).count() == 2
    empty = stage_counts(rows.where("false"), PRODUCTS.rules, PRODUCTS.key).first()
    assert tuple(empty) == (0, 0, 0, 0)


def test_null_keys_count_as_one_key_in_both(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, t long")
    order = (Order("t", descending=True),)
    rules = (Between("t", 0, 10, "t_out"),)
    assert stage_counts(rows, rules, ("k",)).first().valid_record_count == 2
    assert latest_per_key(rows, ("k",), order).count() == 2


def test_one_exchange_gives_latest_rows_and_counts(spark):
    """Against the window, with a hot key, a third rejected, ties, nulls and every type that can descend."""
    rng = random.Random(11)
    days = [None, *(datetime(2024, 1, d, 3) for d in range(1, 9))]
    data = []
    for i in range(3000):
        at = rng.choice(days)
        key = "hot" if i % 3 == 0 else rng.choice([None, f"k{rng.randrange(300)}"])
        data.append((key, at, at and at.date(), rng.choice([None, -(2**63), 2**63 - 1, 5]), 900.0 if i % 3 == 1 else 1.0, f"v{rng.randrange(9)}"))
    rows = spark.createDataFrame(data, "k string, at timestamp, day date, n long, x double, v string").repartition(5)
    rules = [Between("x", 0, 5, "x_out")]
    for descending in (("at", "n"), ("day", "at"), ("n", "day")):
        order = [*(Order(c, descending=True) for c in descending), Order("v"), Order("at"), Order("n")]
        keyed = latest_and_counts(rows, rules, ["k"], order, rows.columns)
        found = {tuple(r) for r in keyed.where("kept").select("latest.*").collect()}
        assert found == {tuple(r) for r in latest_per_key(rows.where("x <= 5"), ["k"], order).collect()}
        assert {tuple(r) for r in keyed.where("not kept").select("k", "row_count", "latest").collect()} == {(None, 1000, None)}
    with pytest.raises(ValueError, match="descending"):
        latest_and_counts(rows, rules, ["k"], [Order("v", descending=True)], ["v"])
    assert date(2024, 1, 1) in {r.day for r in rows.collect()}


def test_quality_in_one_pass(spark, bronze, run):
    for records in ([], [record(code=" ")], [record(code="a"), record(code="a", last_modified_t=9, brands=None), record(fat_100g=-1.0)]):
        rows = validate(bronze(record(), *records).where("code <> 'c1' or code is null"), PRODUCTS, run)
        expected = run_quality(latest_accepted(rows, PRODUCTS), route_counts(rows, PRODUCTS.rules))
        found = run_quality_in_one_pass(rows, PRODUCTS.rules, PRODUCTS.key, PRODUCTS.latest)
        assert found.schema.names == expected.schema.names and found.collect() == expected.collect()


def test_run_quality_reads_and_shuffles_once(spark):
    plan = plan_of(queries()["run_quality"](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan") == 2  # line items and parts
    keyed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # One spreads the line items over the tasks before records are made of them.
    assert len(keyed) == 2 and sum("l_orderkey" in line for line in keyed) == 1
