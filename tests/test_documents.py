"""Documents that lose something are read a few times, not once for each of their rows."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicegate.plans import PRODUCTS, land_documents, landing
from sluicegate.sources import grouped_files, read_run
from sluicegate.workload import inputs


def _bytes_read(spark) -> int:
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_a_damaged_document_is_not_read_for_each_of_its_rows(spark, run, tmp_path):
    n = 1500
    records = [{"code": str(i), "last_modified_t": 1.5} for i in range(n)] + [{}]
    fetched = tmp_path / "fetched"
    fetched.mkdir()
    (fetched / "long.json").write_text(text := json.dumps(records))
    before = _bytes_read(spark)
    counts = land_documents(spark, str(fetched), PRODUCTS.bronze, run, f"{tmp_path}/records", f"{tmp_path}/letters")
    assert _bytes_read(spark) - before < 50 * len(text)
    assert (counts.record_count, counts.dead_letter_count) == (n, 1)
    letter = read_run(spark, f"{tmp_path}/letters", run).first()
    assert (letter.document_text, letter.row_count, letter.lost_row_count) == (text, n + 1, 1)


def test_encodings_broken_bytes_and_empty_rows(spark, run, tmp_path):
    good = {
        "mark.json": b'\xef\xbb\xbf[{"code":"a"}]',
        "wide.json": '[{"code":"b"}]'.encode("utf-16"),
        "text.json": b'[{"code":{"y":1.10}},{},{"code":null}]',
        "behind.json": b'[{"code":"c"}] junk',
        "blank.json": b" \n",
        "none.json": b"",
    }
    bad = {"bytes.json": b'[{"code":"d\xff"}]', "null.json": b'[{"code":"e"},null]', "list.json": b"[[{}]]", "seven.json": b"7"}
    fetched = tmp_path / "fetched"
    fetched.mkdir()
    for name, content in {**good, **bad}.items():
        (fetched / name).write_bytes(content)
    land_documents(spark, str(fetched), PRODUCTS.bronze, run, f"{tmp_path}/records", f"{tmp_path}/letters")
    records = read_run(spark, f"{tmp_path}/records", run).collect()
    assert sorted(r.code or "" for r in records) == ["", "", "a", "b", "c", '{"y":1.10}']
    letters = read_run(spark, f"{tmp_path}/letters", run).collect()
    assert sorted(r.source_file.rpartition("/")[2] for r in letters) == sorted(bad)
    assert {(r.row_count, r.lost_row_count) for r in letters} == {(1, 1)}


def _documents(fetched, *places: str) -> None:
    """Documents of three kinds in turn, of which the last two are dead letters."""
    for i, place in enumerate(places):
        target = fetched / place
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(('[{"code":"%d"},{}]', '[{"code":"%d","last_modified_t":1.5},{}]', '[{"code":"%d"},7]')[i % 3] % i)


def _landed(spark, run, root: str, path: str | list[str]):
    counts = land_documents(spark, path, PRODUCTS.bronze, run, f"{root}/records", f"{root}/letters")
    records = sorted(str(r.code) for r in read_run(spark, f"{root}/records", run).collect())
    letters = sorted(tuple(r) for r in read_run(spark, f"{root}/letters", run).collect())
    assert (len(records), len(letters)) == (counts.record_count, counts.dead_letter_count)
    return records, letters


def test_documents_are_read_in_groups_of_files(spark, run, tmp_path, monkeypatch):
    fetched = tmp_path / "fetched"
    flat = [f"flat/{i}.json" for i in range(7)] + ["flat/odd [1] {a,b} %41*?.json", "flat/_hidden.json", "flat/deeper/unread.json"]
    parts = [f"parts/day=2/k={i % 4}/{i}.json" for i in range(6)] + ["parts/day=2/k=9/sub/12.json", "parts/.old=1/hidden.json"]
    _documents(fetched, *flat)
    _documents(fetched, *parts)
    paths = [f"{fetched}/flat", f"{fetched}/parts", f"{fetched}/fl*/[0-4].json", [f"{fetched}/flat/0.json", f"{fetched}/parts"]]
    known = []
    for name in ("read_with_source", "sound_files"):
        read = getattr(landing, name)
        monkeypatch.setattr(landing, name, lambda *a, f=read: (known.append(len((out := f(*a)).inputFiles())), out)[1])
    found = [_landed(spark, run, f"{tmp_path}/whole-{i}", path) for i, path in enumerate(paths)]
    assert max(known) == 8
    monkeypatch.setattr(grouped_files, "MOST_AT_ONCE", 3)
    known.clear()
    assert [_landed(spark, run, f"{tmp_path}/groups-{i}", path) for i, path in enumerate(paths)] == found
    assert max(known) == 3
    assert found[0][0] == ["0", "1", "3", "4", "6", "7", "None", "None", "None"]
    assert [len(letters) for _, letters in found] == [5, 4, 3, 4]


def test_the_settings_of_the_session_come_back(spark, run, tmp_path):
    _documents(tmp_path / "fetched", "0.json")
    key, other = "spark.sql.files.openCostInBytes", "spark.sql.hive.filesourcePartitionFileCacheSize"
    spark.conf.set(key, "1234567")
    try:
        _landed(spark, run, str(tmp_path), f"{tmp_path}/fetched")
        assert spark.conf.get(key) == "1234567" and spark.conf.get(other, None) is None
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            _landed(spark, run, str(tmp_path), f"{tmp_path}/missing")
        assert spark.conf.get(key) == "1234567" and spark.conf.get(other, None) is None
    finally:
        spark.conf.unset(key)


def test_a_folder_of_the_workload_has_few_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "DOCUMENTS_PER_FOLDER_BITS", 2)
    documents = spark.range(23).select(F.col("id").alias("document"), F.col("id").cast("string").alias("value"))
    inputs.write_documents(documents, f"{tmp_path}/fetched")
    folders = [list(folder.glob("part-*")) for folder in (tmp_path / "fetched").iterdir() if folder.is_dir()]
    assert max(map(len, folders)) == 4
    assert sorted(int(file.read_text()) for files in folders for file in files) == list(range(23))
