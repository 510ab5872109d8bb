from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException

from sluicegate.plans import PRODUCTS, validate
from sluicegate.sources import (
    flatten_pages,
    land_lines,
    page_counts,
    page_lines,
    read_json,
    read_pages,
)
from tests.conftest import record


@pytest.fixture
def write(tmp_path):
    def to(name: str, content) -> str:
        path = tmp_path / name
        path.write_text(content if isinstance(content, str) else json.dumps(content))
        return str(path)

    return to


def test_edge_values_of_an_array_document(spark, write):
    path = write(
        "records.json",
        [
            {"code": 123, "nutriments": {"fat_100g": 7, "salt_100g": "35.0"}},
            {"code": "a", "last_modified_t": 1.5, "nutriments": []},
            {"code": "b", "last_modified_t": "12", "unknown": {"x": 1}},
            {},
            {"code": "c", "last_modified_t": 12, "nutriments": {"energy-kcal_100g": 1.5}},
        ],
    )
    rows = read_json(spark, path, PRODUCTS.bronze).collect()
    assert [r.code for r in rows] == ["123", "a", "b", None, "c"]
    assert [r.last_modified_t for r in rows] == [None, None, None, None, 12]
    assert rows[0].nutriments.fat_100g == 7.0
    assert rows[0].nutriments.salt_100g is None
    assert [r.nutriments is None for r in rows] == [False, True, True, True, False]
    assert rows[4].nutriments["energy-kcal_100g"] == 1.5
    assert set(rows[3]) == {None}


def test_empty_and_truncated_documents(spark, write, run):
    assert read_json(spark, write("empty.json", []), PRODUCTS.bronze).count() == 0
    truncated = read_json(spark, write("cut.json", '[{"code": "a"}, {"co'), PRODUCTS.bronze)
    assert [set(r) for r in truncated.collect()] == [{None}]
    kept = read_json(spark, write("cut2.json", '[{"co'), PRODUCTS.bronze, corrupt_column="raw")
    assert kept.first().raw == '[{"co'


def test_lines_are_read_like_an_array(spark, write):
    records = [record(code=str(i)) for i in range(5)]
    array = read_json(spark, write("a.json", records), PRODUCTS.bronze)
    lines = read_json(
        spark,
        write("l.json", "\n".join(map(json.dumps, records))),
        PRODUCTS.bronze,
        multi_line=False,
    )
    assert array.schema == lines.schema == PRODUCTS.bronze
    assert sorted(array.collect()) == sorted(lines.collect())


def test_pages_are_flattened(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    contents = {
        "1": {"page": 1, "products": [record(code="a"), record(code="b")]},
        "2": {"products": []},
        "3": {"page": 3},
        "4": {"products": None},
        "5": {"products": [record(code="c")]},
    }
    for name, content in contents.items():
        (pages / f"{name}.json").write_text(json.dumps(content, indent=1))
    found = read_pages(spark, str(pages))
    records = flatten_pages(found, PRODUCTS.bronze)
    assert records.schema.names == PRODUCTS.bronze.names
    assert sorted(r.code for r in records.collect()) == ["a", "b", "c"]
    assert tuple(page_counts(found).first()) == (5, 2)


def test_one_bad_element_costs_only_itself(spark, write, run):
    path = write(
        "page.json",
        {"products": [record(code="a"), 7, "text", None, {"code": "b", "nutriments": []}]},
    )
    records = flatten_pages(read_pages(spark, path), PRODUCTS.bronze)
    assert [r.code for r in records.collect()] == ["a", None, None, None, "b"]
    assert validate(records, PRODUCTS, run).where("barcode IS NULL").count() == 3


@pytest.mark.parametrize("envelope", ['{"a": 1}', "5", '"text"'])
def test_an_envelope_that_is_no_list_is_an_error(spark, write, envelope):
    pages = read_pages(spark, write("page.json", f'{{"products": {envelope}}}'))
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        flatten_pages(pages, PRODUCTS.bronze).collect()


def test_a_text_that_looks_like_a_list_is_none(spark, write):
    page = '{"products": "[{\\"code\\":\\"1\\"}]"}'
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_pages(spark, write("page.json", page)).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_page_that_is_a_list_is_an_error(spark, write, multi_line):
    path = write("page.json", '[{"code": "1"}, {"code": "2"}]')
    with pytest.raises(PySparkException, match="did not contain a list"):
        read_pages(spark, path, multi_line=multi_line).collect()


def test_lines_keep_what_no_schema_names(spark, write, tmp_path, run):
    element = {"code": "1", "product_name": "a", "extra": "keepme", "nutriments": {"fat_100g": "35.0", "fiber_100g": 3.0}}
    page = json.dumps({"products": [element, None, "two\nlines", 7]}).replace("3.0}", "1.10}")
    lines = page_lines(read_pages(spark, write("page.json", page)))
    landed = land_lines(lines, str(tmp_path / "bronze"), run)
    texts = [r.value for r in spark.read.text(landed).collect()]
    assert json.loads(texts[0]) == {**element, "nutriments": {"fat_100g": "35.0", "fiber_100g": 1.1}}
    assert "1.10" in texts[0] and texts[1:] == ["{}", '["two\\nlines"]', '["7"]']
    rows = read_json(spark, landed, PRODUCTS.bronze, multi_line=False).collect()
    assert [r.code for r in rows] == ["1", None, None, None]

def test_a_page_that_is_not_json_is_an_error(spark, write):
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_pages(spark, write("page.json", '{"products": [{"co')).collect()
