"""CSV and JSON read in splits: equal to readers that have the whole file, wherever splits fall."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from granary.sources import pieces, tables

CELLS = ["a", "", 'q"q', "x,y", "line\nbreak", '"', "é\r\nz", " sp ", 'a""b', ",", "\n\n", '","', "日本", "'"]


@pytest.fixture
def split_bytes(spark):
    key, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = spark.conf.get(key), spark.conf.get(cost)
    spark.conf.set(cost, "1")
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, old[0])
    spark.conf.set(cost, old[1])


@pytest.mark.parametrize("ending,size", [("\n", 60), ("\r\n", 150), ("\n", 1 << 20)])
def test_csv_in_any_splits(spark, tmp_path, split_bytes, ending, size):
    rng = random.Random(size)
    (tmp_path / "in").mkdir()
    want = []
    for k, mark in enumerate(("", "﻿")):
        rows = [[str(i), *rng.choices(CELLS, k=2)] for i in range(80)]
        with open(tmp_path / f"in/{k}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(mark)
            csv.writer(f, lineterminator=ending).writerows([["id", "a", "b\nc"], *rows])
        want += rows
    split_bytes(size)
    assert pieces.pieces(spark, str(tmp_path / "in"), "\n").rdd.getNumPartitions() >= (8 if size < 200 else 1)
    got = tables.read_csv(spark, str(tmp_path / "in"), ordered=False)
    assert got.columns == ["id", "a", "b\nc"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert list(map(tuple, tables.read_csv(spark, str(tmp_path / "in")).collect())) == list(map(tuple, want))


def test_odd_csv(spark, tmp_path, split_bytes):
    """Quotes inside of fields without quotes are text; short rows are filled up; empty lines are none; one record may cover many splits."""
    long = "x\n" * 500
    (tmp_path / "a.csv").write_text(f'a,b\n5" disk,1\n\nonly\nx"","y\nz"\n1,"{long}"\nlast,""\n', encoding="utf-8")
    split_bytes(300)
    got = sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "a.csv")).collect()))
    assert got == sorted([('5" disk', "1"), ("only", ""), ('x""', "y\nz"), ("1", long), ("last", "")])
    (tmp_path / "b.csv").write_text("a,b\n", encoding="utf-8")
    assert tables.read_csv(spark, str(tmp_path / "b.csv")).collect() == []


def document(rng):
    nested = {"counts": 'a\\}"{[', "size": [1, [2]], "more": {"x": [{"y": "]"}]}}
    return {
        "info": {"d": "a } b", "n": {"x": {"y": [1, {"images": [{"id": 99}]}]}, "z": {}}, "images": [{"id": 98}]}, "licenses": [], "version": "1}",
        "images": [{"id": i, "file_name": f'é\\"}}{i}]', "n": {"a": [{"b": i}]}} if i % 3 else {"id": i, "file_name": "{"} for i in range(40)],
        "mixed": [1, {"a": 2}, [3, {"z": 1}], {"a": 3}, "}", [[{"q": 1}]], {}], "annotations": [{"id": i, "bbox": [1.5, 2, 3, i], "seg": nested if i % 2 else [[1, 2], [3]], "area": rng.choice([1, 2.5])} for i in range(50)],
        "empty": [], "categories": [{"id": 0, "name": "{"}], "last": {"images": 1},
    }


@pytest.mark.parametrize("indent,size", [(None, 150), (2, 200), (None, 400), (1, 1 << 20)])
def test_json_in_any_splits(spark, tmp_path, split_bytes, indent, size):
    whole = document(random.Random(1))
    path = str(tmp_path / "c.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(whole, f, indent=indent, ensure_ascii=size == 400)
    split_bytes(size)
    got = pieces.json_elements(spark, path).collect()
    text = lambda x: json.dumps(x, sort_keys=True)
    for key, value in whole.items():
        want = [x for x in value if isinstance(x, dict)] if isinstance(value, list) else []
        assert sorted(text(json.loads(r["element"])) for r in got if r["key"] == key) == sorted(map(text, want)), key
    if size < 300:
        return
    for rows, key in zip(tables.read_coco(spark, path), ("images", "annotations", "categories"), strict=True):
        plain = spark.read.json(path, multiLine=True).select(F.explode(key).alias("x")).select("x.*")
        # Values of mixed types stay text, in which line breaks have become spaces.
        assert rows.schema == plain.schema and sorted(map(repr, rows.collect())) == sorted(repr(r).replace("\\n", " ") for r in plain.collect())


def test_documents_without_arrays(spark, tmp_path):
    for i, text in enumerate(("[]", '[{"id": 1}]', '{"images": {"id": {"a": 1}, "b": {}}}', '{"images": []}')):
        path = str(tmp_path / f"{i}.json")
        (tmp_path / f"{i}.json").write_text(text)
        assert pieces.json_elements(spark, path).collect() == []
    assert all(rows.count() == 0 for rows in tables.read_coco(spark, str(tmp_path / "3.json")))
