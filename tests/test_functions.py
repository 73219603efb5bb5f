import hashlib
import math
import os
import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from granary.functions import boxes, hashing, labels, numbers, paths


def values(spark, rows, *columns):
    schema = ", ".join(f"c{i} string" for i in range(len(rows[0])))
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[c.alias(f"x{i}") for i, c in enumerate(columns)]).collect()]


def test_labels(spark):
    got = values(spark, [(" Hello-World!! ",), ("__a  b__",), ("Água-Viva",), ("***",)], labels.normalize_label(F.col("c0")))
    assert [g[0] for g in got] == ["hello_world", "a_b", "água_viva", ""]


def test_review_reasons(spark):
    cases = {
        "single_object_only": labels.POSSIBLE_MISSING, "partial Occlusion": labels.AMBIGUOUS, "dense": labels.CROWDED, "a single object": labels.POSSIBLE_MISSING, "blurred": "blurred",
        "single crowded object": labels.CROWDED,
    }
    got = values(spark, [(c,) for c in cases], labels.review_reason(F.col("c0")), labels.review_reason(F.col("c0"), False))
    assert [g[0] for g in got] == list(cases.values()) and [g[1] for g in got] == list(cases)


def test_policy(spark):
    policy = labels.Policy(("cat",), {"cat": "cat", "dog": "animal"}, ("bg",), ("odd",), "ignore")
    got = values(spark, [(" CAT ",), ("dog",), ("bg",), ("odd",), ("new",)], policy.apply(F.col("c0")))
    assert [tuple(g[0]) for g in got] == [("map", "cat"), ("review", None), ("ignore", None), ("review", None), ("ignore", None)]
    with pytest.raises(ValueError):
        labels.Policy((), {}, unknown="drop")


def test_paths(spark):
    names = ["a/b.tar.gz", ".bashrc", "a/.hidden", "x.JPG", "a.b/c", "no/ending."]
    got = values(spark, [(n,) for n in names], paths.suffix(F.col("c0")), paths.stem(F.col("c0")), paths.is_image(F.col("c0")))
    assert [g[0] for g in got] == [".gz", "", "", ".JPG", "", ""]
    assert [g[1] for g in got] == [PurePosixPath(n).stem if n != "no/ending." else "ending." for n in names]
    assert [g[2] for g in got] == [False, False, False, True, False, False]
    moved = values(spark, [("d/Images/x/y.png",), ("d/y.png",), ("y.png",)], paths.label_path(F.col("c0")))
    assert [g[0] for g in moved] == ["d/labels/x/y.txt", "d/y.txt", "y.txt"]
    split = values(spark, [("a/Val/x",), ("test/train/x",), ("q/x",)], paths.split_of(F.col("c0"), "none"))
    assert [g[0] for g in split] == ["valid", "train", "none"]
    blocked = values(spark, [("a/Dismissed_x/b.png",), ("a/__pycache__/b.png",), ("dismissed.png",)], paths.is_blocked(F.col("c0")))
    assert [g[0] for g in blocked] == [True, True, False]
    bucket = values(spark, [("cat__src__a__x", "cat"), ("zzz", "cat")], paths.source_bucket(F.col("c0"), F.col("c1"), F.lit("folder")))
    assert [g[0] for g in bucket] == ["src__a", "folder"]
    assert values(spark, [("root/images/val/a.png",)], paths.to_split_first(F.col("c0"))) == [("root/valid/images/a.png",)]


def test_stable_split(spark):
    texts = [(hashlib.md5(str(i).encode()).hexdigest(),) for i in range(300)]

    def plain(h):
        x = int(h[:8], 16) / 0xFFFFFFFF
        return "train" if x < 0.7 else "valid" if x < 0.7 + 0.2 else "test"

    assert [g[0] for g in values(spark, texts, hashing.split_by_hash(F.col("c0")))] == [plain(t[0]) for t in texts]


def test_hamming(spark):
    rng = random.Random(1)
    pairs = [(f"{rng.getrandbits(64):016x}", f"{rng.getrandbits(64):016x}") for _ in range(100)] + [("ffffffffffffffff", "0" * 16), ("zz", "zz"), ("zz", "0" * 16)]
    want = [bin(int(a, 16) ^ int(b, 16)).count("1") for a, b in pairs[:-2]] + [0, 64]
    assert [g[0] for g in values(spark, pairs, hashing.hamming(F.col("c0"), F.col("c1")))] == want


def test_mean_hash(spark):
    cells = [float(i) for i in range(64)]
    got = spark.createDataFrame([(cells,)], "c array<double>").select(hashing.mean_hash(F.col("c"))).first()[0]
    assert got == f"{(1 << 32) - 1:016x}"


def test_numbers(spark):
    texts = ["1", "1.0", "1d", "0x1p3", "inf", "-nan", " 0.5 ", "1_0", "", "1e-3", "abc"]
    got = [g[0] for g in values(spark, [(t,) for t in texts], numbers.to_number(F.col("c0")))]
    assert got[0] == got[1] == 1 and got[4] == math.inf and math.isnan(got[5]) and got[6] == 0.5 and got[9] == 0.001
    assert [got[i] for i in (2, 3, 7, 8, 10)] == [None] * 5
    ids = values(spark, [("1.0",), ("1.5",), ("7",), ("x",)], numbers.strict_class(F.col("c0")), numbers.truncated_class(F.col("c0")), numbers.integral_class(F.col("c0")))
    assert ids == [(None, 1, 1), (None, 1, None), (7, 7, 7), (None, None, None)]
    text = spark.createDataFrame([(5e-7,), (0.1234565,), (0.5,)], "x double").select(numbers.fixed6(F.col("x")), numbers.short12(F.col("x"))).collect()
    assert [tuple(r) for r in text] == [(f"{v:.6f}", f"{v:.12g}") for v in (5e-7, 0.1234565, 0.5)]


def test_lines(spark):
    lines = ["", "0 .5 .5 .1 .1", "bad row", "0 nan 0 0 0", "1 0 0 1 0 1 1", "1 0 0 1 0 1", "2 0.5 0.5 1.5 0.1"]
    got = values(spark, [(x,) for x in lines], boxes.classify(F.col("c0")), boxes.parsed(F.col("c0")).isNotNull())
    assert [g[0] for g in got] == ["empty", "box", "malformed", "malformed", "polygon", "malformed", "box"]
    assert [g[1] for g in got] == [False, True, False, False, False, False, False]


def test_polygons(spark):
    cases = ["1.0 -0.5 0.2 0.4 0.2 0.4 1.7", "1 0.2 0.2 0.2 0.4 0.2 0.6", "1.5 0 0 1 0 1 1", "1 inf 0 1 0 1 1"]
    got = [g[0] for g in values(spark, [(x,) for x in cases], boxes.polygon_box(F.col("c0")))]
    assert tuple(round(v, 9) for v in got[0]) == (1, 0.2, 0.6, 0.4, 0.8) and got[1:] == [None] * 3


def test_remap(spark):
    maps = spark.createDataFrame([("3 0.1 0.2 0.3 0.4",), ("9 0.1 0.2 0.3 0.4",), ("3 0.1",)], "line string")
    names, ids = F.create_map(F.lit(3), F.lit("Cat")), F.create_map(F.lit("cat"), F.lit(0))
    assert [r[0] for r in maps.select(boxes.remapped(F.col("line"), names, ids)).collect()] == ["0 0.1 0.2 0.3 0.4", None, None]
    assert [r[0] is not None for r in maps.select(boxes.strict_line(F.col("line"), 3, 0)).collect()] == [True, False, False]


def test_empty_label_files_are_listed(spark, tmp_path):
    from granary.sources import filetree

    for name, text in {"train/images/a.JPG": "x", "train/labels/a.txt": "", "valid/labels/b.txt": "0 .5 .5 .1 .1\n", "dismissed_dark/c.png": "x", "top.txt": ""}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    found = {r["path"]: r["length"] for r in filetree.listing(spark, str(tmp_path)).collect()}
    assert found == {"train/images/a.JPG": 1, "train/labels/a.txt": 0, "valid/labels/b.txt": 14, "dismissed_dark/c.png": 1, "top.txt": 0}
    assert [r["path"] for r in filetree.images(spark, str(tmp_path)).collect()] == ["train/images/a.JPG"]
    assert {r["path"]: r["content"] for r in filetree.label_files(spark, str(tmp_path)).collect()}["train/labels/a.txt"] == ""
    assert filetree.listing(spark, str(tmp_path / "none")).count() == 0
    images, files = filetree.split_first(spark, str(tmp_path))
    assert images.count() == 1 and {r["split"] for r in files.collect()} == {"train", "valid"}
    assert [r["path"] for r in filetree.negatives_of(filetree.label_files(spark, str(tmp_path)), [0], [5]).collect()] == ["valid/labels/b.txt"]


def test_tables_and_files(spark, tmp_path):
    from granary.sources import sinks, tables

    (tmp_path / "a.csv").write_bytes('﻿id,note\n1,"a ""b""\nc"\n2,\n'.encode())
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [("1", 'a "b"\nc'), ("2", "")]
    assert tables.read_csv(spark, str(tmp_path / "none.csv"), ("id",), empty_if_missing=True).count() == 0
    (tmp_path / "c.json").write_bytes(b'\xef\xbb\xbf{"a": 1}')
    assert tables.read_config(str(tmp_path / "c.json")) == {"a": 1}
    assert tables.class_names("train: x\nnames:\n  0: 'cat'\n  1: dog\nnc: 2\n") == {0: "cat", 1: "dog"}
    assert tables.class_names("names: [cat, \"dog\"]") == {0: "cat", 1: "dog"}
    with pytest.raises(ValueError):
        tables.class_names("nc: 1", strict=True)
    assert sinks.write_single_csv(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "o" / "x.csv"), ["b", "a"]) == 1
    assert (tmp_path / "o" / "x.csv").read_text() == "b,a\n,1\n"
    assert tables.class_names(sinks.dataset_yaml(["cat", "dog"])) == {0: "cat", 1: "dog"}
    assert sinks.write_if_absent(str(tmp_path / "t.md"), "x") and not sinks.write_if_absent(str(tmp_path / "t.md"), "y")
    (tmp_path / "out-two").mkdir()
    with pytest.raises(ValueError):
        sinks.clean(str(tmp_path / "out-two"), str(tmp_path / "out"))
    sinks.clean(str(tmp_path / "out-two"), str(tmp_path))
    assert not (tmp_path / "out-two").exists()
    plan = spark.createDataFrame([("copy", str(tmp_path / "a.csv"), str(tmp_path / "n/b.csv")), ("delete", str(tmp_path / "no"), None)], "action string, source string, target string")
    assert [r["status"] for r in sinks.apply_plan(plan).collect()] == ["planned", "missing_source"] and not (tmp_path / "n").exists()
    assert [r["status"] for r in sinks.apply_plan(plan, dry_run=False).collect()] == ["ok", "missing_source"] and (tmp_path / "n/b.csv").exists()
    os.makedirs(tmp_path / "old")
    assert sinks.rename_folders([(str(tmp_path / "old"), str(tmp_path / "new")), (str(tmp_path / "p"), str(tmp_path / "q"))], False) == [(str(tmp_path / "old"), str(tmp_path / "new"), "planned"), (str(tmp_path / "p"), str(tmp_path / "q"), "missing")]


def worked_out(spark, column, what):
    plan = spark.createDataFrame([], "line string").select(column.alias("x"))._jdf.queryExecution().analyzed().toString()
    return plan.count(what)


def test_a_token_is_read_once(spark):
    """Inside lambdas each mention of an expression is worked out anew: a class id was matched sixteen times."""
    assert worked_out(spark, numbers.truncated_class(F.col("line")), "RLIKE") + worked_out(spark, numbers.truncated_class(F.col("line")), "regexp_replace") <= 1
    assert worked_out(spark, numbers.integral_class(F.col("line")), "RLIKE") <= 1
    texts = [(" 1.5\t", 1.5), ("1e400", None), ("inf", None), (" -NaN ", None), ("1d", None), ("0x1p3", None), ("", None), (".5", 0.5), ("5.", 5.0), (None, None), ("1 2", None)]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, line string").select("i", numbers.finite(F.col("line")).alias("x"), numbers.to_number(F.col("line")).alias("y")).orderBy("i").collect()
    assert [r["x"] for r in rows] == [x for _, x in texts]
    assert rows[1]["y"] == rows[2]["y"] == float("inf") and rows[3]["y"] != rows[3]["y"] and [r["y"] for r in rows[4:7]] == [None] * 3


def test_a_line_is_cut_once(spark):
    """A line was cut into tokens again at each mention of one, up to a hundred times."""
    for read in (boxes.parsed, boxes.polygon_box, boxes.classify):
        assert worked_out(spark, read(F.col("line")), "split(") == 1


def test_boxes_are_not_worked_out_for_a_filter(spark):
    """Spark infers of a plain explode that its array isn't empty, and works the array out once more to know."""
    from granary.operators import boxes as ob

    found = spark.createDataFrame([], "md5 string, source_id string, path string, content string")
    rows = spark.createDataFrame([], "image string, id int, xc double, yc double, w double, h double")
    for plan in (ob.review_rows(found), ob.meeting(rows, ["image"], "id")):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in text.splitlines() if "Filter" in x and "transform(" in x]
