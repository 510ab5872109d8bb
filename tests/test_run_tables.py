"""Partitions replaced as a whole, the catalog's schema, documents and the resumable chain."""

from __future__ import annotations

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluicegate import Run
from sluicegate.plans import PRODUCTS, Roots, land_documents, land_pages, process_pages, whole_run
from sluicegate.plans import landing as landing_plan
from sluicegate.sources import (
    land_bronze,
    read_run,
    read_table_run,
    register_table,
    run_tables,
    write_run,
    write_runs,
)
from tests.conftest import record


def _hidden(root) -> list[Path]:
    return [p for p in Path(root).glob("**/.*") if p.is_dir()]


def _rows(spark, *values: int):
    return spark.createDataFrame([(v,) for v in values], "v int")


def _values(spark, root, run) -> list[int]:
    return sorted(r.v for r in read_run(spark, root, run).collect())


def test_a_failed_table_leaves_all_old_ones(spark, run, tmp_path):
    first, second = f"{tmp_path}/first", f"{tmp_path}/second"
    assert write_runs({first: _rows(spark, 1, 2), second: _rows(spark, 3)}, run) == {first: 2, second: 1}
    broken = _rows(spark, 9).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(PySparkException, match="broken"):
        write_runs({first: _rows(spark, 7), second: broken}, run)
    assert (_values(spark, first, run), _values(spark, second, run)) == ([1, 2], [3])
    with pytest.raises(PySparkException, match="broken"):
        write_run(broken, first, run)
    assert _values(spark, first, run) == [1, 2]
    assert not _hidden(tmp_path)
    write_runs({first: _rows(spark), second: _rows(spark, 4)}, run)
    assert (_values(spark, first, run), _values(spark, second, run)) == ([], [4])


def test_a_failed_move_is_undone(spark, run, tmp_path, monkeypatch):
    roots = [f"{tmp_path}/{name}" for name in "abc"]
    write_runs({root: _rows(spark, at) for at, root in enumerate(roots[:2])}, run)
    moved, move = [], run_tables.Files.move

    def failing(self, source, target):
        if len(moved) == 3:
            moved.append(None)
            raise OSError("no more")
        moved.append((source, target))
        move(self, source, target)

    monkeypatch.setattr(run_tables.Files, "move", failing)
    with pytest.raises(OSError, match="no more"):
        write_runs({root: _rows(spark, 10 + at) for at, root in enumerate(roots)}, run)
    monkeypatch.undo()
    assert [_values(spark, root, run) for root in roots[:2]] == [[0], [1]]
    assert not Path(run.directory(roots[2])).exists() and not _hidden(tmp_path)


def test_a_run_may_be_rewritten_from_itself(spark, run, tmp_path):
    root = str(tmp_path)
    write_run(_rows(spark, 1, 2, 3), root, run)
    write_run(read_run(spark, root, run).where("v > 1"), root, run)
    assert _values(spark, root, run) == [2, 3]


def test_the_catalog_takes_new_columns_and_refuses_new_types(spark, run, tmp_path):
    root, later, last = f"{tmp_path}/t", Run("r2", "2024-03-02", run.processed_at), Run("r3", "2024-03-03", run.processed_at)
    frames = {
        run: spark.createDataFrame([("a", 1)], "k string, n long"),
        later: spark.createDataFrame([("b", 2, "new", 0.5)], "k string, n long, extra string, x double"),
        last: spark.createDataFrame([("c",)], "k string"),
    }
    for each, rows in frames.items():
        write_run(rows, root, each)
        register_table(spark, "evolving", root, rows.schema, each)
    columns = ["k", "n", "extra", "x", "run_id"]
    found = {tuple(r) for r in spark.table("evolving").select(*columns).collect()}
    assert found == {("a", 1, None, None, "test-run"), ("b", 2, "new", 0.5, "r2"), ("c", None, None, None, "r3")}
    assert [r.extra for r in read_table_run(spark, "evolving", later).collect()] == ["new"]
    other = spark.createDataFrame([("a", "1")], "k string, n string")
    with pytest.raises(ValueError, match="evolving.n is bigint, not string"):
        register_table(spark, "evolving", root, other.schema, run)
    with pytest.raises(ValueError, match="lies in"):
        register_table(spark, "evolving", f"{tmp_path}/elsewhere", frames[run].schema, run)


def test_documents_are_split_into_records_and_dead_letters(spark, run, tmp_path):
    texts = {
        "good.json": json.dumps([record(code="a"), record(code="b")]),
        "empty.json": "[]",
        "one.json": json.dumps(record(code="c")),
        "cut.json": '[{"code": "d"}, {"co',
        "number.json": '[{"code": "e"}, 7]',
        "odd [1].json": '[{"code": "f", "nutriments": []}, {}, {"code": "g", "last_modified_t": 1.5}]',
        "void.json": "[{}]",
    }
    fetched = tmp_path / "fetched"
    fetched.mkdir()
    for name, text in texts.items():
        (fetched / name).write_text(text)
    roots = f"{tmp_path}/records", f"{tmp_path}/letters"
    counts = land_documents(spark, str(fetched), PRODUCTS.bronze, run, *roots)
    records = read_run(spark, roots[0], run)
    assert records.schema.names == PRODUCTS.bronze.names
    assert sorted(r.code or "" for r in records.collect()) == ["", "a", "b", "c", "f", "g"]
    letters = {r.document_text: (r.row_count, r.lost_row_count) for r in read_run(spark, roots[1], run).collect()}
    assert letters == {texts["cut.json"]: (1, 1), texts["number.json"]: (1, 1), texts["odd [1].json"]: (3, 1)}
    assert (counts.record_count, counts.dead_letter_count) == (6, 3)


def _write_pages(folder, *contents) -> str:
    folder.mkdir()
    for i, content in enumerate(contents):
        (folder / f"{i}.json").write_text(json.dumps(content))
    return str(folder)


PAGES = ({"products": [record(code="1"), record(code="1", last_modified_t=2)]}, {"products": [record(code=" "), record(code="2")]})
WHAT = {"source": "s", "category": "c", "page_size": 2}


def test_pages_are_read_once_unless_one_has_no_envelope(spark, run, tmp_path, monkeypatch):
    asked = []
    refuse = landing_plan.refuse_lists
    monkeypatch.setattr(landing_plan, "refuse_lists", lambda *a, **k: (asked.append(1), refuse(*a, **k)))
    roots = f"{tmp_path}/bronze", f"{tmp_path}/runs"
    path = land_pages(spark, _write_pages(tmp_path / "a", *PAGES), run, *roots, **WHAT).first().product_path
    assert not asked
    land_pages(spark, _write_pages(tmp_path / "b", *PAGES, {}), run, *roots, **WHAT)
    assert len(asked) == 1
    listed = _write_pages(tmp_path / "c", {"products": [record(code="9")]}, [{"code": "1"}])
    with pytest.raises(PySparkException, match="did not contain a list"):
        land_pages(spark, listed, run, *roots, **WHAT)
    # The refused pages took nobody's place.
    assert spark.read.text(path).count() == 4 and not _hidden(tmp_path / "bronze")


def _plain(report) -> dict:
    return {k: v for k, v in report.first().asDict(recursive=True).items() if not k.endswith("_path")}


def test_a_chain_goes_on_behind_its_last_finished_stage(spark, run, tmp_path, monkeypatch):
    pages = _write_pages(tmp_path / "pages", *PAGES)
    whole = process_pages(spark, pages, run, Roots.under(f"{tmp_path}/whole"), **WHAT)
    expected = _plain(whole)
    assert (expected["extracted_record_count"], expected["silver_record_count"], expected["duplicate_record_count"]) == (4, 2, 1)

    roots = Roots.under(f"{tmp_path}/broken")
    calls = []

    def counted(name):
        work = getattr(whole_run, name)
        monkeypatch.setattr(whole_run, name, lambda *a, **k: (calls.append(name), work(*a, **k))[1])

    counted("land_pages")
    counted("bronze_to_silver")
    gold = whole_run.silver_to_gold
    monkeypatch.setattr(whole_run, "silver_to_gold", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        process_pages(spark, pages, run, roots, **WHAT)
    assert calls == ["land_pages", "bronze_to_silver"]
    monkeypatch.setattr(whole_run, "silver_to_gold", gold)
    assert _plain(process_pages(spark, pages, run, roots, resume=True, **WHAT)) == expected
    assert calls == ["land_pages", "bronze_to_silver"]
    # Finished stages of another run do not count, and without resuming all run again.
    other = replace(run, run_id="other")
    process_pages(spark, pages, other, roots, resume=True, **WHAT)
    process_pages(spark, pages, run, roots, **WHAT)
    assert calls == ["land_pages", "bronze_to_silver"] * 3


def test_gold_tables_carry_the_run(spark, run, tmp_path):
    roots = Roots.under(str(tmp_path))
    process_pages(spark, _write_pages(tmp_path / "pages", *PAGES), run, roots, **WHAT)
    for name in ("brand_summary", "nutrition_grade_summary", "pipeline_quality_summary"):
        rows = read_run(spark, f"{roots.gold}/{name}", run)
        register_table(spark, f"gold_{name}", f"{roots.gold}/{name}", rows.schema, run)
        found = spark.table(f"gold_{name}").select("run_id", "processing_date", F.unix_seconds("generated_at")).distinct().collect()
        assert [tuple(r) for r in found] == [(run.run_id, run.processing_date, int(run.processed_at.timestamp()))]


def test_landing_again_replaces_lines(spark, run, bronze, tmp_path):
    land_bronze(bronze(record(code="1"), record(code="2")), str(tmp_path), run)
    path = land_bronze(bronze(record(code="3")), str(tmp_path), run)
    assert [r.code for r in spark.read.json(path).collect()] == ["3"]
