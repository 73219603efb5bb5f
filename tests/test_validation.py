"""Validation, plans of file actions, rewritten labels, configuration, images and whole runs."""

import json
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions import numbers, pixels, policy
from granary.operators import actions, dedup, learning, manifest, metrics, reconcile, validation
from granary.plans import pipelines
from granary.sources import filetree, sinks, tables


def names_one_by_one(names, taken=()):
    used, out = set(taken), []
    for n in names:
        stem, ending = re.match(r"^(.*?)(\.[^.]*)?$", n).groups()
        now, i = n, 2
        while now in used:
            now, i = f"{stem}__{i}{ending or ''}", i + 1
        used.add(now)
        out.append(now)
    return out


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_unique_names_are_those_of_writing_one_by_one(spark, seed):
    rng = random.Random(seed)
    pool = ["a.txt", "a__2.txt", "a__3.txt", "a__2__2.txt", "a__5.txt", "b", "b__2", "b__02", "a__2__3.txt", "c.x.png", "a__1.txt", "a__2__2__2.txt", "a__4.txt"]
    names = [rng.choice(pool[: rng.randint(3, len(pool))]) for _ in range(60)]
    taken = rng.sample(pool, 3) if seed % 2 else []
    rows = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    used = spark.createDataFrame([(x,) for x in taken], "name string") if taken else None
    got = [r["unique_name"] for r in reconcile.unique_names(rows, "name", [F.col("id")], used).orderBy("id").collect()]
    assert got == names_one_by_one(names, taken) and len(set(got)) == len(got)


def test_numbers_as_text_are_those_of_the_binary_value(spark):
    rng = random.Random(5)
    values = [rng.random() for _ in range(200)] + [10 ** rng.uniform(-8, 14) * rng.choice([1, -1]) for _ in range(200)]
    values += [0.0, -0.0, 5e-7, 0.1234565, 1.0, 1e-5, 123456789012.5, float("inf"), float("-inf"), 0.00009999999999999, 2.5e-6, 1e-4, 1 / 3, 1e15]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", numbers.fixed6(F.col("x")), numbers.short12(F.col("x"))).collect()
    assert [r[2] for r in got] == [f"{v:.12g}" for v in values]
    assert [r[1] for r in got if abs(r[0]) < 1e9] == [f"{v:.6f}" for v in values if abs(v) < 1e9]
    assert spark.createDataFrame([(None,), (float("nan"),)], "x double").select(numbers.fixed6(F.col("x")), numbers.short12(F.col("x"))).distinct().collect() == [(None, None)]


def test_policies_by_version():
    assert policy.policies({}) == policy.Policies("v1", "legacy", "off", "off") and not policy.policies({}).multi_instance
    assert policy.policies({"dataset_policy_version": " V2 "}) == policy.Policies("v2", "multi_instance", "warn_review_queue", "warn")
    own = policy.policies({"dataset_policy_version": "v2", "annotation_policy": {"instance_mode": "legacy"}, "qc": "bad"})
    assert (own.instance_mode, own.missing_instance_policy) == ("legacy", "warn")


def test_names_and_orders(spark):
    sources = spark.createDataFrame([("toner", "raw/toner"), ("x", "raw/batery_y")], "id string, root string")
    with pytest.raises(ValueError, match="batery"):
        policy.refuse_misspelt(sources)
    policy.refuse_misspelt(sources.limit(0))
    assert policy.class_order([(1, "b"), (0, "a")]) == ["a", "b"] and policy.extended_order(["a"], ["a", "b"]) == ["a", "b"]
    for bad in ([(0, "a"), (2, "b")], [(0, "a"), (0, "b")]):
        with pytest.raises(ValueError):
            policy.class_order(bad)
    with pytest.raises(ValueError):
        policy.extended_order(["a", "b"], ["b", "a"])


def test_batches(spark):
    line = "0 0.5 0.5 0.95 0.95"
    images = spark.createDataFrame([("train/images/a.jpg", "a"), ("train/images/b.jpg", "b")], "path string, stem string")
    labels = spark.createDataFrame([("train/labels/a.txt", "a", [line]), ("train/labels/b.txt", "b", [line])], "path string, stem string, lines array<string>")
    copies = spark.createDataFrame([("m1", "r/a", "m.csv", "i/a", "l/a"), ("m2", "r/b", "m.csv", "i/b", "l/b")], "md5 string, source_path string, source_manifest string, output_image string, output_label string")
    assert validation.batch_findings(images, labels, copies, 2, "c").count() == 0
    bad = {r["rule"]: r["severity"] for r in validation.batch_findings(images.limit(1), labels.withColumn("lines", F.array()), copies.union(copies.limit(1)), 3, "c", ("c",)).collect()}
    assert set(bad) == {"excluded_class", "image_count", "label_count", "labels_without_images", "duplicate_md5s", "unexpected_label"} and set(bad.values()) == {"error"}
    loose = {r["rule"]: r["severity"] for r in validation.batch_findings(images, labels, copies.union(copies.limit(1)), 2, "c", collapse=True).collect()}
    assert loose == {"duplicate_source_md5s_collapsed_in_output": "warn"}


def test_round_trip(spark):
    md5 = [f"{i:032x}" for i in range(4)]
    images = spark.createDataFrame([(f"train/images/{m}_x.jpg", f"{m}_x") for m in md5[:3]], "path string, stem string")
    lines = [["0 0.5 0.5 1 1"], [], ["0 0.5 0.5 0.4 0.4", "0 0.5 0.5 0.2 0.2", "1 0.5 0.5 2 0.1", "x y", "a 0 0 0 0"]]
    labels = spark.createDataFrame([(f"train/labels/{m}_x.txt", f"{m}_x", x) for m, x in zip(md5, lines, strict=False)], "path string, stem string, lines array<string>")
    out = validation.roundtrip(images, labels, spark.createDataFrame([(m,) for m in (md5[0], md5[1], md5[3])], "md5 string"), rows_shown=1)
    found = {r["rule"]: r["observed"] for r in out["findings"].collect()}
    assert found == {
        "original_md5s_missing_from_images": 1, "original_md5s_missing_from_labels": 1, "unexpected_image_md5s": 1, "unexpected_label_md5s": 1, "malformed_rows": 2, "out_of_range_rows": 1,
        "nonzero_class_rows": 1,
    }
    shown = out["malformed"].collect()
    assert len(shown) == 1 and shown[0]["total"] == 2 and shown[0]["line"] == "x y"
    assert [tuple(r)[1:] for r in out["overlaps"].collect()] == [(0, 1, 0.25, 1.0, 1.0, 1)]
    assert out["nulled"].count() == 1 and out["seeds"].first()[0].endswith(f"{md5[0]}_x.txt")


def test_frozen(spark):
    files = [("train", "a.txt", "a", ["0 .1 .1 .1 .1", "7 .1 .1 .1 .1", "x .1 .1 .1 .1", "0 1.5 0 0 0", "0 1"]), ("valid", "b.txt", "b", [])]
    labels = spark.createDataFrame(files, "split string, path string, stem string, lines array<string>")
    images = spark.createDataFrame([("train", "a.jpg", "a"), ("train", "b.jpg", "b")], "split string, path string, stem string")
    lineage = spark.createDataFrame([("m",), ("m",)], "md5 string")
    got = sorted((r["rule"], r["subject"], r["observed"]) for r in validation.frozen_findings(images, labels, lineage, 3).collect())
    assert [g[0] for g in got] == ["duplicate_md5s", "images_without_labels", "invalid_class_id", "labels_without_images", "malformed_label", "non_numeric_label", "out_of_range_label"]
    assert ("invalid_class_id", "a.txt:7", 7.0) in got


def test_polygons_become_boxes_in_files(spark):
    text = "0 .5 .5 .1 .1\n1 0.1 0.2 0.3 0.2 0.3 0.6\nbad\n\n2 0 0 0 0.5 0 1\n"
    files = spark.createDataFrame([("train/labels/a.txt", text), ("b.txt", "0 .5 .5 .1 .1\n"), ("c.txt", "")], "path string, content string")
    out = pipelines.normalised(files, "root")
    got = {r["path"]: r for r in out["labels"].collect()}
    a = got["train/labels/a.txt"]
    assert a["content"] == "0 .5 .5 .1 .1\n1 0.200000 0.400000 0.200000 0.400000\n" and a["split"] == "train" and a["changed"]
    assert (a["box_rows_unchanged"], a["polygon_rows_converted"], a["malformed_rows_dropped"], a["invalid_polygon_rows_dropped"]) == (1, 1, 1, 1)
    assert not got["b.txt"]["changed"] and got["b.txt"]["split"] == "unknown" and not got["c.txt"]["changed"]
    assert [r["target"] for r in out["plan"].collect()] == ["root/train/labels/a.txt"]
    strict = validation.strict_files(spark.createDataFrame([("a", "3 0.1 0.25 1e-5 1\n"), ("b", "3 .1 .1 .1 .1\n3 2 0 0 0"), ("c", "4 .1 .1 .1 .1"), ("d", "")], "path string, content string"), 3, 0)
    assert {r["path"]: r["lines"] for r in strict.collect()} == {"a": ["0 0.1 0.25 1e-05 1"], "b": None, "c": None, "d": []}


def test_plans(spark, tmp_path):
    files = spark.createDataFrame([("train/images/A.jpg",), ("train/images/b.jpg",)], "path string")
    kept = spark.createDataFrame([("train\\images\\a.JPG",), ("",), (None,)], "path string")
    assert [r["source"] for r in actions.keep_only(files, kept, "out").collect()] == ["out/train/images/b.jpg"]
    moves = {r["source"]: r["target"] for r in actions.to_split_first(spark.createDataFrame([("images/val/a.png",), ("train/images/b.png",)], "path string"), "d", "d").collect()}
    assert moves == {"d/images/val/a.png": "d/valid/images/a.png"}
    rows = spark.createDataFrame([("in/a.jpg", "train/images/m.jpg", "train/labels/m.txt", ["0 1 1 1 1"]), ("in/b.jpg", "i/n.jpg", "l/n.txt", [])], "s string, i string, l string, lines array<string>")
    plan = sorted(tuple(r) for r in actions.exported(rows, "s", "i", "l", "lines", "o").select("action", "target", "content").collect())
    assert plan == [("copy", "o/i/n.jpg", None), ("copy", "o/train/images/m.jpg", None), ("write", "o/l/n.txt", ""), ("write", "o/train/labels/m.txt", "0 1 1 1 1\n")]
    batch = spark.createDataFrame([("7", "1", "u", "s rc", "", "raw/x.WEBP", "cat", "r"), ("12345", "2", "v", "s", "q.png", "raw/none", "dog", "r")], "priority_rank string, batch_rank string, unique_id string, source_dataset string, original_filename string, source_relpath string, mapped_label string, reason string")
    table, copies = actions.review_package(batch, spark.createDataFrame([("raw/x.WEBP",)], "path string"), "root", "out")
    assert {r["copied_image"]: r["copy_status"] for r in table.collect()} == {"images/0007__s_rc__u.webp": "ok", "images/12345__s__v.png": "missing_source"}
    assert [tuple(r)[:3] for r in copies.collect()] == [("copy", "root/raw/x.WEBP", "out/images/0007__s_rc__u.webp")] and tuple(table.columns) == actions.REVIEW_FIELDS
    prune = sinks.prune_plan(spark.createDataFrame([("w/last.pt", 5), ("w/x/epoch1.pt", 7), ("w/best.txt", 1)], "path string, length long"), ["**/epoch*.pt", "w/last.pt"], "r")
    assert sorted((r["source"], r["length"]) for r in prune.collect()) == [("r/w/last.pt", 5), ("r/w/x/epoch1.pt", 7)]


def test_reports_and_files(spark, tmp_path):
    counts = spark.createDataFrame([("b", "x", 2), ("a", "y", 1)], "s string, c string, n long")
    assert sinks.counts(counts, "s", "c", by="/") == {"a/y": 1, "b/x": 2} and sinks.nested(counts, "s", "c") == {"a": {"y": 1}, "b": {"x": 2}}
    with pytest.raises(ValueError):
        sinks.counts(counts, "s", "c", most=1)
    sinks.write_json({"é": 1, "a": [2]}, str(tmp_path / "r" / "x.json"), sort_keys=True)
    assert (tmp_path / "r" / "x.json").read_text(encoding="utf-8") == '{\n  "a": [\n    2\n  ],\n  "é": 1\n}'
    sinks.write_csv(spark.createDataFrame([("a", 'q "x"', "train"), ("b", "l\nm", "test")], "a string, b string, split string"), str(tmp_path / "parts"), ["b", "a", "split"], by="split")
    assert {p.name for p in (tmp_path / "parts").iterdir() if p.is_dir()} == {"split=train", "split=test"}
    back = tables.read_csv(spark, str(tmp_path / "parts" / "split=test"))
    assert back.columns == ["b", "a"] and tuple(back.first()) == ("l\nm", "b")
    files = sinks.one_class_files("tv")
    assert set(files) == {"classes.txt", "obj.names", "labelmap.txt", "labelmap.pbtxt"} and files["labelmap.txt"] == "tv\n" and files["labelmap.pbtxt"] == "item {\n  id: 0\n  name: 'tv'\n}\n"
    assert tables.class_names(sinks.one_class_yaml("tv", "/d")) == {0: "tv"} and "nc: 2" in sinks.dataset_yaml(["a", "b"], count=True)
    listing = spark.createDataFrame([("a/b", "22"), ("a-b/x", "33"), ("c", "11")], "path string, sha256 string")
    assert manifest.streamed_digest(listing) == manifest.digest(listing).first()[0]
    images = spark.createDataFrame([("train", "cat"), ("train", "cat"), ("test", "dog")], "split string, class string")
    out = sinks.release_manifest(listing, images, "m1", "d1", "data", sinks.utc(0), manifests=listing, inventory={"config": {"qc": {"a": 1}}}, extra={"k": 1})
    assert out["split_class_counts"] == {"train": {"cat": 2}, "valid": {}, "test": {"dog": 1}} and out["generated_at_utc"] == "1970-01-01T00:00:00Z" and out["dataset_sha256"] == out["manifests_sha256"]
    assert out["dataset_policy"] == {"dataset_policy_version": "v1", "annotation_policy": {}, "qc": {"a": 1}} and out["extra"] == {"k": 1}


def test_tables_of_runs_and_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text(" epoch , metrics/mAP50(B)\n1,0.5\n2,0.6\n2,0.7\n")
    runs = tables.read_runs(spark, {"one": str(tmp_path / "a.csv")}, {"map50": "metrics/mAP50(B)"})
    assert sorted((r["run"], r["epoch"], r["map50"]) for r in tables.last_epochs(runs).collect()) == [("one", 1, 0.5), ("one", 2, 0.7)]
    coco = {"info": {}, "images": [{"id": 1}, {"id": 2}], "annotations": [{"image_id": 1, "category_id": 0}], "categories": [{"id": 0, "name": "Cat"}]}
    (tmp_path / "c.json").write_text(json.dumps(coco))
    images, annotations, categories = tables.read_coco(spark, str(tmp_path / "c.json"))
    assert images.count() == 2 and annotations.first()["image_id"] == 1 and categories.first()["name"] == "Cat"
    sources = tables.registry(spark, [{"id": "a", "type": "direct_yolo"}, {"id": "b", "type": "odd", "action": "exclude_for_now"}, {"id": "c", "type": "odd"}])
    assert {r["id"]: r["route"] for r in tables.dispatched(sources, ("direct_yolo",)).collect()} == {"a": "direct_yolo", "b": "excluded", "c": "unsupported_type:odd"}
    status = tables.source_status(sources, spark.createDataFrame([("a", "x")], "source_folder string, canonical_class string"), spark.createDataFrame([("a", 3)], "id string, files int"))
    assert {r["id"]: (r["status"], r["files"]) for r in status.collect()} == {"a": ("active", 3), "b": ("exclude_for_now", 0), "c": ("unmapped_class", 0)}
    (tmp_path / "m.csv").write_text("source_folder,canonical_class,status\na,x,Active\na,y,active\nb,z,exclude\n")
    assert [(r["source_folder"], r["canonical_class"]) for r in tables.class_map_rows(tables.read_csv(spark, str(tmp_path / "m.csv"))).collect()] == [("a", "y")]
    (tmp_path / "d" / "one").mkdir(parents=True)
    (tmp_path / "d" / "two").mkdir()
    (tmp_path / "d" / "one" / "review_reduced.csv").write_bytes('﻿unique_id,decision\nu1,cat\nu2,\n u3 , dog \n'.encode())
    (tmp_path / "d" / "two" / "review_reduced.csv").write_text("unique_id,decision\nu1,tv\n")
    (tmp_path / "d" / "two" / "old_review_reduced.csv").write_text("unique_id,decision\nu1,no\n")
    (tmp_path / "d" / "review_reduced.csv").write_bytes(b"unique_id,decision\n\xff\xfe,x\n")
    from granary.operators import review

    found = tables.decisions(spark, str(tmp_path / "d"))
    assert {r["unique_id"]: r["decision"] for r in review.last_of(found, "unique_id", "sequence").collect()} == {"u1": "tv", "u3": "dog"}
    assert tables.decisions(spark, str(tmp_path / "none")).count() == 0


def test_images_of_labels(spark):
    labels = spark.createDataFrame([("train", "a"), ("train", "b"), ("train", "c"), ("test", "a")], "split string, stem string")
    images = spark.createDataFrame([("train", "a", "x/a.png"), ("train", "a", "x/a.JPG"), ("train", "b", "x/b.gif"), ("train", "c", "x/c.webp")], "split string, stem string, path string")
    assert {r["stem"]: r["image"] for r in filetree.with_images(labels, images).collect()} == {"a": "x/a.JPG", "c": "x/c.webp"}
    order = filetree.in_order(spark.createDataFrame([("b",), ("A",), ("a",)], "path string")).collect()
    assert [r[0] for r in order] == ["A", "a", "b"]


def png(width, height, rows):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + bytes(r) for r in rows)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_sizes_of_images(spark):
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + b"\0" * 9 + b"\xff\xc0" + struct.pack(">HBHH", 17, 8, 33, 44) + b"\0" * 10
    bmp = b"BM" + b"\0" * 16 + struct.pack("<ii", 5, -6) + b"\0" * 20
    webp = b"RIFF\0\0\0\0WEBPVP8X\x0a\0\0\0\0\0\0\0" + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")
    cases = [(png(3, 2, [[0] * 9] * 2), (3, 2)), (jpeg, (44, 33)), (bmp, (5, 6)), (b"GIF89a" + struct.pack("<HH", 7, 8) + b"\0" * 4, (7, 8)), (webp, (100, 50)), (b"text that is no image", None), (b"", None), (None, None), (jpeg[:20], None)]
    rows = spark.createDataFrame([(i, bytearray(raw) if raw is not None else None) for i, (raw, _) in enumerate(cases)], "i int, c binary")
    got = {r["i"]: (r["s"]["width"], r["s"]["height"]) for r in rows.select("i", pixels.image_size(F.col("c")).alias("s")).collect()}
    assert got == {i: want or (None, None) for i, (_, want) in enumerate(cases)}


def test_features_and_baseline(spark, tmp_path):
    rng = random.Random(1)
    for i in range(24):
        red = i % 2 == 0
        rows = [[v for _ in range(6) for v in ((200 if red else 20) + rng.randrange(20), 40, 20 if red else 200)] for _ in range(5)]
        (tmp_path / f"{i}.png").write_bytes(png(6, 5, rows))
    (tmp_path / "bad.png").write_bytes(b"no image")
    read = spark.read.format("image").option("dropInvalid", False).load(str(tmp_path))
    number = F.regexp_extract(F.col("image.origin"), r"(\d+)\.png$", 1)
    images = read.withColumn("label", F.when(number.try_cast("int") % 2 == 0, F.lit("red")).otherwise("blue"))
    found = pixels.features(images, side=2)
    rows = found.collect()
    assert len(rows) == 24 and all(len(r["features"]) == 12 for r in rows)
    for r in rows:
        assert (r["features"][0] > 0.5) == (r["label"] == "red") and abs(r["features"][1] - 40 / 255) < 1e-6
    bad = images.where(number == "")
    assert pixels.features(bad.repartition(3), side=2).collect() == [] and pixels.features(images.repartition(25, "image.origin"), side=2).count() == 24
    model = learning.train_baseline(found, rounds=20)
    truth = learning.predicted(model, found).select(F.col("label").alias("truth"), "predicted")
    assert metrics.overall(truth).first()["accuracy"] == 1.0
    assert np.allclose(pixels.resized(np.arange(16, dtype=np.uint8).reshape(4, 4, 1), 2)[:, :, 0], [[2.5, 4.5], [10.5, 12.5]])


def test_coordinates_that_are_no_numbers(spark):
    """Comparisons with them are false: they are neither malformed nor out of range, but what else is wrong still counts."""
    lines = ["0 nan 0.2 0.3 0.4", "0 nan 0.2 1.5 0.4", "0 0.1 0.2 0.3 -NaN", "nan 0.1 0.2 0.3 0.4", "0 0.1 0.2 0.3 inf"]
    labels = spark.createDataFrame([("train/labels/a__x.txt", "a", lines)], "path string, stem string, lines array<string>")
    images = spark.createDataFrame([("train/images/a__x.jpg", "a", "a")], "path string, stem string, md5 string")
    out = validation.roundtrip(images, labels, images.select("md5"))
    assert sorted(r["line"] for r in out["out_of_range"].collect()) == ["0 0.1 0.2 0.3 inf", "0 nan 0.2 1.5 0.4"]
    assert [r["line"] for r in out["malformed"].collect()] == ["nan 0.1 0.2 0.3 0.4"]
    split = lambda rows: rows.withColumn("split", F.lit("train"))
    found = validation.frozen_findings(split(images), split(labels), images.select("md5"), 2).collect()
    assert sorted((r["rule"], r["subject"].split(":")[1]) for r in found) == [("non_numeric_label", lines[3]), ("out_of_range_label", lines[4]), ("out_of_range_label", lines[1])]


def test_quality_run(spark):
    """Files with no, two and five boxes, one without a label file and one that can't be read."""
    images = spark.createDataFrame([("train", f"train/images/src__{k}__x.jpg") for k in "abcde"] + [("valid", "valid/images/q.jpg")], "split string, path string")
    line = "0 .5 .5 .1 .1\n"
    labels = spark.createDataFrame([("train/labels/src__a__x.txt", ""), ("train/labels/src__b__x.txt", line * 2), ("train/labels/src__c__x.txt", line * 5), ("train/labels/src__e__x.txt", "9 0 0 0 0\nbad"), ("valid/labels/q.txt", "1 0 0 0 0")], "path string, content string")
    limits = pipelines.QualityLimits(least_multi=0.9, most_empty=0.1, least_files=1)
    out = pipelines.validated(images, labels, ("cat", "dog"), limits, required={"valid": ("dog", "cat", "cow")})
    found = sorted((r["rule"], r["severity"], r["split"], r["subject"]) for r in out["findings"].collect())
    assert found == sorted([
        ("missing_split", "error", "test", None), ("malformed_line", "warn", "train", "train/labels/src__e__x.txt"), ("class_out_of_range", "error", "train", "train/labels/src__e__x.txt"),
        ("images_without_label", "warn", "train", None), ("high_empty_ratio", "warn", "train", None), ("low_multi_box_ratio", "warn", "valid", None), ("missing_class", "warn", "valid", "cat"),
        ("required_class_missing", "error", "valid", "cat"), ("required_class_unknown", "error", "valid", "cow"),
    ], key=repr) or found == sorted(found)
    assert {r[0] for r in found} >= {"missing_split", "malformed_line", "class_out_of_range", "images_without_label", "high_empty_ratio", "required_class_unknown"}
    queue = {r["path"][-8]: (r["reason"], r["notes"]) for r in out["queue"].where("split = 'train'").collect()}
    assert queue == {
        "a": ("possible_missing_instances", "empty_label_file"), "c": ("crowded_scene_needs_review", "high_box_density"), "d": ("possible_missing_instances", "missing_label_file"),
        "e": ("possible_missing_instances", "empty_label_file"),
    }
    assert {(r["split"], r["class"]): r["n"] for r in out["instances"].collect()} == {("train", "cat"): 7, ("valid", "dog"): 1}
    assert {r["size"]: r["n"] for r in out["histogram"].where("split = 'train'").collect()} == {0: 3, 2: 1, 5: 1}


def test_label_audit(spark):
    line = "0 .5 .5 .1 .1"
    files = [("train", "a", f"{line}\n"), ("train", "b", f"{line}\r\n\r\n1 0 0 1 0 1 1\r\nbad"), ("train", "c", ""), ("train", "d", line), ("test", "e", "\n")]
    out = pipelines.audited(spark.createDataFrame(files, "split string, path string, content string"), pipelines.QualityLimits(least_multi=0.5, least_files=1))
    assert {r["path"]: tuple(r)[2:] for r in out["files"].collect()} == {"a": (1, 0, 0, 0), "b": (1, 1, 1, 1), "c": (0, 0, 0, 0), "d": (1, 0, 0, 0), "e": (0, 0, 0, 1)}
    total = next(r for r in out["splits"].collect() if r["split"] is None)
    assert (total["files_scanned"], total["files_with_polygons"], total["box_rows"]) == (5, 1, 3)
    assert ("low_multi_box_ratio", "train") in {(r["rule"], r["split"]) for r in out["findings"].collect()}


def test_accounting_and_staging_runs(spark):
    assets = spark.createDataFrame([("s1", "f", "s1/a.jpg", "m1", ".jpg"), ("s1", "f", "s1/b.jpg", "m1", ".jpg"), ("s2", "f", "s2/c.png", "m2", ".png"), ("s2", "f", "s2/d.png", "m3", ".png")], "source_id string, source_family string, source_path string, md5 string, extension string")
    classes = spark.createDataFrame([("s1", "cat"), ("s2", "cat")], "source_id string, canonical_class string")
    plan = lambda size, most=None: pipelines.scraped_plan(assets, classes, spark.createDataFrame([("cat", size)], "canonical_class string, batch_size string"), "b1", most)
    out = plan("2")
    assert out["inventory"].count() == 4 and [tuple(r) for r in out["duplicates"].collect()] == [("m1", "s1/a.jpg", "s1/b.jpg")]
    assert [(r["batch_order"], r["future_staged_image"]) for r in out["preview"].orderBy("batch_order").collect()] == [(1, "class_batches/cat/b1/train/images/m1.jpg"), (2, "class_batches/cat/b1/train/images/m2.png")]
    row = out["assessment"].first()
    assert (row["available_image_count"], row["unique_image_count"], row["duplicate_image_count"], row["extension_breakdown"]) == (4, 3, 1, '{".jpg":2,".png":2}')
    assert plan("many")["preview"].count() == 0 and plan("", 1)["preview"].count() == 1 and plan("")["preview"].count() == 0
    labelled = spark.createDataFrame([("cat", s, f"l{s}") for s in ("train", "valid", "test")], "class string, split string, md5 string")
    targets = spark.createDataFrame([("cat", "10", "5")], "class string, target string, batch_size string")
    done = pipelines.accounted(out["inventory"].where("canonical_class = 'cat'").limit(1).withColumn("duplicate_role", F.lit("canonical")).withColumn("status", F.lit("scraped_unused")), labelled, spark.createDataFrame([("cat",)], "class string"), targets)
    row = done["classes"].first()
    assert (row["labelled"], row["gap_to_target"], row["suggested_target"]) == (3, 7, 4) and done["total_unique"].first()["total_unique"] == 4
    assert {r["class"]: r["labelled"] for r in done["totals"].collect()} == {"cat": 3, "total": 3}


def test_pairs_by_bands_and_by_buckets(spark):
    """Hashes of one prefix that differ in up to six bits: the same pairs, whether bands or whole buckets meet."""
    rng = random.Random(6)
    bits = [0xABCD << 48 | rng.getrandbits(48) for _ in range(60)]
    bits += [b ^ sum(1 << k for k in rng.sample(range(48), rng.randint(0, 7))) for b in bits]
    rows = spark.createDataFrame([(i, f"{b:016x}") for i, b in enumerate(bits)], "id long, h string")
    for most in (0, 3, 5, 20):
        want = {(i, j, (a ^ b).bit_count()) for i, a in enumerate(bits) for j, b in enumerate(bits) if i < j and (a ^ b).bit_count() <= most}
        assert {tuple(r) for r in dedup.similar_pairs(rows, "id", "h", 4, most).collect()} == want


def test_one_class_batches(spark):
    rows = [("tv", "canonical", "m2", "raw/b.PNG"), ("tv", "canonical", "m1", "raw/a.jpg"), ("tv", "duplicate", "m3", "raw/c.jpg"), ("tv", "canonical", "m4", "/abs/d.jpg"), ("pc", "canonical", "m5", "raw/none.jpg"), ("no", "canonical", "m6", "raw/a.jpg")]
    inventory = spark.createDataFrame(rows, "canonical_class string, duplicate_role string, md5 string, source_path string")
    files = spark.createDataFrame([("raw/a.jpg",), ("raw/b.PNG",), ("raw/c.jpg",)], "path string")
    targets = spark.createDataFrame([("tv", 2), ("pc", 1), ("no", 0)], "canonical_class string, target int")
    out = pipelines.one_class_batches(inventory, files, targets, "in", "out")
    assert sorted(r["output_image"] for r in out["selected"].collect()) == ["tv/train/images/m1.jpg", "tv/train/images/m2.png"]
    plan = {(r["action"], r["source"], r["target"], r["content"]) for r in out["plan"].collect()}
    assert ("copy", "in/raw/b.PNG", "out/tv/train/images/m2.png", None) in plan and ("write", None, "out/tv/train/labels/m1.txt", "0 0.5 0.5 0.95 0.95\n") in plan and len(plan) == 4
    assert [(r["canonical_class"], r["available"]) for r in out["short"].collect()] == [("pc", 0)]


def test_review_queue_run(spark):
    files = spark.createDataFrame([("m1", "b", "x", "0 .5 .5 .2 .2\nbad"), ("m2", "a", "y", None)], "md5 string, source_id string, path string, content string")
    out = pipelines.review_queue(files, {"a": "flat"})
    assert [(r["source_id"], r["decision_class"], r["status"]) for r in out["queue"].collect()] == [("a", "flat", "missing_label"), ("b", "uncertain", "warning_malformed_ignored")]
    assert {(r["source_id"], r["images"], r["boxes"]) for r in out["counts"].collect()} == {("a", 1, 1), ("b", 1, 1)}


def test_merged_datasets(spark):
    schema = "path string, label_path string, content_hash string"
    base = spark.createDataFrame([("train/images/a.jpg", "train/labels/a.txt", "h1")], schema)
    more = spark.createDataFrame([("train/images/a.jpg", "train/labels/a.txt", "h2"), ("train/images/b.jpg", "train/labels/b.txt", "h1"), ("train/images/c.jpg", "train/labels/c.txt", "h2")], schema)
    out = pipelines.merged_datasets(base, more, ["x"], ["x", "y"], "base", "in", "out")
    assert sorted((r["path"], r["origin"], r["unique_name"]) for r in out["rows"].collect()) == [("train/images/a.jpg", "base", "train/images/a.jpg"), ("train/images/a.jpg", "incremental", "train/images/a__2.jpg")]
    assert {(r["source"], r["target"]) for r in out["plan"].collect()} == {
        ("base/train/images/a.jpg", "out/train/images/a.jpg"), ("base/train/labels/a.txt", "out/train/labels/a.txt"), ("in/train/images/a.jpg", "out/train/images/a__2.jpg"),
        ("in/train/labels/a.txt", "out/train/labels/a__2.txt"),
    }
    with pytest.raises(ValueError):
        pipelines.merged_datasets(base, more, ["x"], ["y", "x"], "base", "in", "out")


def test_baseline_report_and_runs(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.png").write_bytes(png(4, 4, [[200 if i % 2 else 10, 50, 10 if i % 2 else 200] * 4] * 4))
    images = spark.read.format("image").load(str(tmp_path))
    odd = F.regexp_extract(F.col("image.origin"), r"(\d+)\.png$", 1).cast("int") % 2 == 1
    images = images.withColumn("label", F.when(odd, F.lit("red")).otherwise("blue"))
    out = pipelines.baseline_report(images, images, side=2, rounds=20)
    assert out["overall"].first()["accuracy"] == 1.0 and out["worst"].count() == 0 and {r["class"] for r in out["classes"].collect()} == {"red", "blue"}
    for run, values in {"one": "1,0.5\n2,0.4\n2,0.7", "two": "1,0.1\n2,0.2\n3,0.3"}.items():
        (tmp_path / f"{run}.csv").write_text(f"epoch,m\n{values}\n")
    files = {run: str(tmp_path / f"{run}.csv") for run in ("one", "two")}
    runs = pipelines.compared_runs(files, {"map": "m"}, spark, "map", window=1)
    assert {(r["run"], r["best_epoch"], r["best"], r["latest"]) for r in runs["summary"].collect()} == {("one", 2, 0.7, 0.7), ("two", 3, 0.3, 0.3)}
    assert {(r["run"], r["epoch"]) for r in runs["epochs"].collect()} == {("one", 2), ("two", 2)}
    with pytest.raises(ValueError):
        pipelines.compared_runs(files, {"map": "m"}, spark, "other")
