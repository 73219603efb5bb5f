"""Whole run of a category mapping, and the assertion of relative paths."""

import json
from pathlib import Path

import pytest

from granary.functions.labels import Policy
from granary.operators import reconcile
from granary.plans import pipelines


def test_mapping_a_document(spark, tmp_path):
    categories = [{"id": i, "name": n} for i, n in enumerate([" Phone", "LAPTOP", "cable", "blurry", "odd", "lost"])]
    annotations = [{"id": i, "image_id": i % 5, "category_id": [0, 1, 2, 3, 4, 5, 77][i % 7], "bbox": [0.5, 1, 2, i], "note": 'a "}] ' + str(i)} for i in range(40)] + [{"id": 100, "image_id": 9, "category_id": 2, "bbox": [], "note": ""}]
    whole = {"info": {"year": 2024}, "images": [{"id": i, "file_name": f"{i}.jpg"} for i in range(10)], "annotations": annotations, "categories": categories}
    (tmp_path / "in.json").write_text(json.dumps(whole))
    policy = Policy(targets=("phone", "laptop"), mapping={"phone": "phone", "laptop": "laptop", "lost": "no target"}, ignore=("cable",), review=("blurry",), unknown="review")
    report = pipelines.map_document(spark, str(tmp_path / "in.json"), str(tmp_path / "out"), policy, "thing")
    (part,) = Path(tmp_path / "out").glob("part-*")
    new = json.loads(part.read_text())
    kept = [a | {"category_id": {0: 1, 1: 2}[a["category_id"]]} for a in annotations if a["category_id"] in (0, 1)]
    assert sorted(new["annotations"], key=lambda a: a["id"]) == kept and sorted(x["id"] for x in new["images"]) == sorted({a["image_id"] for a in kept})
    assert new["categories"] == [{"id": 1, "name": "phone", "supercategory": "thing"}, {"id": 2, "name": "laptop", "supercategory": "thing"}]
    names = {0: "phone", 1: "laptop", 2: "cable", 3: "blurry", 4: "odd", 5: "lost", 77: ""}
    count = lambda keep: {n: sum(names[a["category_id"]] == n for a in annotations) for n in sorted(names.values()) if keep(n)}
    assert report["source_label_counts"] == count(lambda n: True) and report["target_label_counts"] == count(lambda n: n in ("phone", "laptop"))
    assert report["ignored_label_counts"] == count(lambda n: n == "cable") and report["review_label_counts"] == count(lambda n: n in ("blurry", "odd", "lost", ""))
    assert (report["input_images"], report["input_annotations"], report["output_images"], report["output_annotations"]) == (10, 41, len(new["images"]), len(kept))


def test_nothing_is_mapped(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps({"images": [{"id": 1}], "annotations": [{"image_id": 1, "category_id": 0}], "categories": [{"id": 0, "name": "x"}]}))
    report = pipelines.map_document(spark, str(tmp_path / "in.json"), str(tmp_path / "out"), Policy(targets=("a",), mapping={}, unknown="ignore"))
    (part,) = Path(tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text())["annotations"] == [] and report["ignored_label_counts"] == {"x": 1} and report["output_images"] == 0


def test_relative_paths_are_asserted(spark):
    rows = [(i, f"/abs/{i}" if i % 2 else f"rel/{i}", None if i == 3 else " /x" if i == 8 else "") for i in range(12)]
    table = spark.createDataFrame(rows, "i int, source string, target string").repartition(3)
    with pytest.raises(ValueError, match="source=/abs/1, source=/abs/3, source=/abs/5, source=/abs/7, target=/x$"):
        reconcile.assert_relative(table, ["source", "target"], ["i"])
    reconcile.assert_relative(table.where("i % 2 = 0 and i <> 8"), ["source", "target"], ["i"])
