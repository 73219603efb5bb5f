import itertools

import pytest
from pyspark.sql import functions as F

from granary.functions.labels import Labelling
from granary.operators import boxes, dedup, metrics, qc, reconcile, review, split
from granary.plans import pipelines


def test_apportionment_goldens(spark):
    want = {2985: (2090, 597, 298), 188: (131, 38, 19), 1: (1, 0, 0), 0: (0, 0, 0), 3: (2, 1, 0), 10: (7, 2, 1)}

    def plain(n):
        shares = [n * r for r in (0.7, 0.2, 0.1)]
        out = [int(s) for s in shares]
        for i in sorted(range(3), key=lambda i: (-(shares[i] - out[i]), i))[: n - sum(out)]:
            out[i] += 1
        return tuple(out)

    got = {r[0]: tuple(r)[1:] for r in spark.range(0, 3001).select("id", *split.apportioned(F.col("id"))).collect()}
    assert all(got[n] == plain(n) for n in got) and got[188] == want[188] and got[0] == want[0] and all(sum(v) == n for n, v in got.items())


def test_quota_goldens(spark):
    rows = spark.createDataFrame([(2985, 746), (855, 214), (426, 106)], "p int, q int")
    assert all(r[0] == r[1] for r in rows.select("q", split.negative_quota(F.col("p"), 0.2)).collect())


def test_rebalance_golden(spark):
    counts = spark.createDataFrame([("a", 1575), ("b", 527), ("c", 3)], "label string, n long")
    assert split.rebalance_cap(counts, "label", "a", 1.5).first()[0] == 790


def test_negatives_run_out(spark):
    rows = spark.range(0, 110).select(F.col("id"), (F.col("id") >= 100).alias("neg"), F.when(F.col("id") < 70, "train").when(F.col("id") < 90, "valid").otherwise("test").alias("split"))
    got = {r[0]: r[1] for r in split.with_negatives(rows, "id", "neg", 1, 0.2).groupBy("split").count().collect()}
    assert got == {"train": 10}


def test_leaders(spark):
    base = 0x1234567890ABCDEF
    near, far, same_name = base ^ 0b111, base ^ (0xFFFF << 20), base ^ 0xFE00
    rows = [("a", f"{base:016x}"), ("b", f"{near:016x}"), ("c", f"{far:016x}"), ("d", f"{same_name:016x}"), ("e", "f" * 16)]
    got = dict(dedup.leaders(spark.createDataFrame(rows, "id string, h string"), "id", "h").collect())
    assert got["a"] == got["b"] != got["c"]
    assert got["d"] == got["a"]  # a leader of its own (seven bits away), whose name is that of another
    assert got["e"] == "near_ffffffffffff"


def _plain_greedy(rows, iou=0.85, coverage=0.9):
    """rows: (id, source, xc, yc, w, h) in list order."""
    active = list(rows)
    while True:
        for a, b in itertools.combinations(active, 2):
            x = max(0, min(a[2] + a[4] / 2, b[2] + b[4] / 2) - max(a[2] - a[4] / 2, b[2] - b[4] / 2))
            y = max(0, min(a[3] + a[5] / 2, b[3] + b[5] / 2) - max(a[3] - a[5] / 2, b[3] - b[5] / 2))
            one, two = a[4] * a[5], b[4] * b[5]
            if x * y / (one + two - x * y) >= iou or x * y / min(one, two) >= coverage:
                worse = max(a, b, key=lambda r: (r[1].startswith("synthetic"), r[1] == "synthetic_missing_label", r[4] * r[5], r[0]))
                active.remove(worse)
                break
        else:
            return {r[0] for r in active}


def test_greedy_boxes_of_small_groups_meet_where_they_are(spark, monkeypatch):
    """Small groups send no pairs anywhere; groups of either size have the results of the plain version, also null ones."""
    import random

    rng, rows = random.Random(5), []
    for image in [*(f"i{k}" for k in range(12)), None]:
        for k in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((image, "c", f"b{k}", rng.randrange(3), rng.choice(["label", None, "synthetic_missing_label"]), round(rng.uniform(0.45, 0.55), 3), 0.5, round(rng.uniform(0.3, 0.5), 3), 0.4))
    rows += [("odd", "c", "b0", 0, "label", 0.5, 0.5, float("nan"), 0.4), ("odd", "c", "b1", 0, "label", 0.5, 0.5, 0.4, None), ("odd", "c", "b2", 0, "label", 0.5, 0.5, 0.4, 0.4), ("odd", "c", "b3", 0, "label", 0.5, 0.5, 0.0, 0.4)]
    schema = "image string, class string, box_id string, seq int, box_source string, xc double, yc double, w double, h double"
    docs = spark.createDataFrame(rows, schema)
    found = []
    for most in (4, 0, 64):
        monkeypatch.setattr(boxes, "GROUP_BOXES", most)
        if most == 64:
            monkeypatch.setattr(boxes, "meeting", None)
        got = boxes.deduplicated(docs, ["image", "class"]).collect()
        found.append(sorted(map(tuple, got), key=str))
        assert len(got) == len(rows) and not any(r["image"] == "odd" and not r["kept"] for r in got)
        for image in {r[0] for r in rows} - {"odd"}:
            own = [(r[2], r[4] or "", *r[5:]) for r in sorted((r for r in rows if r[0] == image), key=lambda r: (r[3], r[2]))]
            assert {r["box_id"] for r in got if r["image"] == image and r["kept"]} == _plain_greedy(own)
    assert found[0] == found[1] == found[2] and any(r[4] for r in found[0])


def test_greedy_boxes(spark):
    import random

    rng, rows = random.Random(3), []
    for image in range(40):
        for k in range(rng.randint(1, 7)):
            rows.append((f"i{image}", "c", f"b{k}", k, rng.choice(["label", "synthetic_full_image", "synthetic_missing_label"]), round(rng.uniform(0.45, 0.55), 3), 0.5, round(rng.uniform(0.3, 0.5), 3), 0.4))
    chain = [("x", "c", n, i, "label", x, 0.5, 0.4, 0.4) for i, (n, x) in enumerate([("B", 0.52), ("A", 0.50), ("C", 0.54)])]
    schema = "image string, class string, box_id string, seq int, box_source string, xc double, yc double, w double, h double"
    got = boxes.deduplicated(spark.createDataFrame(rows + chain, schema), ["image", "class"]).collect()
    for image in {r[0] for r in rows + chain}:
        own = [(r[2], r[4], *r[5:]) for r in sorted((r for r in rows + chain if r[0] == image), key=lambda r: (r[3], r[2]))]
        assert {r["box_id"] for r in got if r["image"] == image and r["kept"]} == _plain_greedy(own)
    assert len(got) == len(rows + chain)


def test_box_goldens(spark):
    schema = "image string, box_id string, seq int, box_source string, xc double, yc double, w double, h double"
    rows = [("a", "1", 0, "label", 0.5, 0.5, 0.4, 0.4), ("a", "2", 1, "label", 0.51, 0.5, 0.4, 0.4), ("b", "1", 0, "synthetic_full_image", 0.5, 0.5, 1.0, 1.0), ("b", "2", 1, "label", 0.5, 0.5, 0.4, 0.4)]
    got = {(r["image"], r["box_id"]): (r["kept"], r["reason"]) for r in boxes.deduplicated(spark.createDataFrame(rows, schema), ["image"]).collect()}
    assert got[("a", "2")] == (False, "iou_threshold") and got[("b", "1")] == (False, "coverage_threshold") and got[("b", "2")][0]


def test_review_rows(spark):
    files = [("m1", "s", "a", "0 .5 .5 .2 .2\n0 .4 .4 .1 .1\nbad row"), ("m2", "s", "b", None), ("m3", "s", "c", "")]
    got = boxes.review_rows(spark.createDataFrame(files, "md5 string, source_id string, path string, content string")).orderBy("review_box_id").collect()
    assert [(r["status"], r["box_source"], r["review_box_id"]) for r in got] == [
        ("warning_malformed_ignored", "label", "m1__s__box0000"), ("warning_malformed_ignored", "label", "m1__s__box0001"),
        ("missing_label", "synthetic_missing_label", "m2__s__box0000"), ("empty_label", "synthetic_full_image", "m3__s__box0000"),
    ]


def test_first_writer_and_names(spark):
    rows = spark.createDataFrame([("x", 1, "b"), ("x", 0, "c"), ("y", 2, "a")], "md5 string, stage int, path string")
    kept, lost = dedup.first_writer(rows, "md5", [F.col("stage"), F.col("path")])
    assert {r["path"] for r in kept.collect()} == {"c", "a"} and [r["path"] for r in lost.collect()] == ["b"]
    names = spark.createDataFrame([(1, "a.png"), (2, "a.png"), (3, "a__2.png")], "id int, name string")
    got = [r["unique_name"] for r in reconcile.unique_names(names, "name", [F.col("id")]).orderBy("id").collect()]
    assert got == ["a.png", "a__2.png", "a__2__2.png"]


def test_overrides_with_empty_text(spark):
    queue = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, c string")
    decisions = spark.createDataFrame([("1", "late", 1), ("1", "", 2), ("", "z", 3)], "id string, c string, sequence int")
    assert {tuple(r) for r in review.overridden(queue, decisions, "id", ["c"], "sequence").collect()} == {("1", ""), ("2", "y")}


def test_findings(spark):
    lines = spark.createDataFrame([("train", "a", "9 .1 .1 .1 .1"), ("train", "b", "x"), ("train", "c", "1 .1 .1 .1 .1"), ("valid", "d", "1.0 .1 .1 .1 .1")], "split string, path string, line string")
    found = qc.bad_lines(lines, 5)
    assert {(r["rule"], r["subject"]) for r in found.collect()} == {("class_out_of_range", "a"), ("malformed_line", "b"), ("malformed_line", "d")}
    with pytest.raises(qc.QualityError):
        qc.fail_on_errors(found)
    files = spark.createDataFrame([("train", "a", 0), ("train", "b", 2), ("train", "c", 5), ("train", "d", None)], "split string, path string, boxes int")
    assert {r["path"]: r["reason"] for r in qc.queue(files).collect()} == {"a": "possible_missing_instances", "c": "crowded_scene_needs_review", "d": "possible_missing_instances"}
    assert qc.queue(files, policy="off").count() == 0 and [r["split"] for r in qc.missing_splits(files, ("train", "test")).collect()] == ["test"]


def test_reports(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "truth string, predicted string")
    got = {r["class"]: tuple(r)[1:] for r in metrics.class_report(rows).collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0, 0, 0, 1)
    assert metrics.per_class(["x", "y"], ap=[0.5]) == [(0, "x", 0.5), (1, "y", None)]


def test_unified_pipeline(spark):
    rows = [("src", f"f{i}", "mobile" if i % 3 else "junk", 10 + i % 4, 4, 4, f"{i % 25:040x}", f"{(i % 25) * 0x0101010101:016x}") for i in range(60)]
    assets = spark.createDataFrame(rows, "source string, path string, label string, length int, width int, height int, sha1 string, phash string")
    out = pipelines.unified(assets, pipelines.UnifiedConfig(Labelling({"mobile": "phone"}, taxonomy=("phone",)), seed=7))
    assert out["exact"].count() == 25
    splits = out["splits"].collect()
    assert {r["split"] for r in splits} <= {"train", "valid", "test"} and len({r["unique_id"] for r in splits}) == len(splits) and out["review_queue"].count() == 0


def test_detection_merges_equal_images(spark):
    rows = [("s1", "a", "m", None, "x", "0 .25 .25 .1 .1", {0: "cat"}), ("s2", "b", "m", None, "y", "0 .75 .75 .1 .1\n7 0 0 0 0", {0: "dog"})]
    schema = "source_id string, path string, md5 string, split string, canonical_class string, content string, names map<int,string>"
    out = pipelines.detection(spark.createDataFrame(rows, schema), {"dog": 0, "cat": 3})
    (image,) = out["images"].collect()
    assert image["label_lines"] == ["3 .25 .25 .1 .1", "0 .75 .75 .1 .1"] and image["canonical_class"] == "mixed" and out["warnings"].count() == 1


def test_box_review_pipeline(spark):
    q = [("m__a__0", "m", "a", "label", 0.5, 0.5, 0.4, 0.4, "", "pending"), ("m__b__0", "m", "b", "label", 0.2, 0.2, 0.1, 0.1, "", "pending")]
    queue = spark.createDataFrame(q, "review_box_id string, md5 string, source_id string, box_source string, xc double, yc double, w double, h double, decision_class string, review_status string")
    decisions = spark.createDataFrame([("m__a__0", "flat", "done", 1), ("m__b__0", "crt", "accepted", 1)], "review_box_id string, decision_class string, review_status string, sequence int")
    out = pipelines.box_review(queue, decisions, ("flat", "crt"), ("a", "b"), loser="flat", winner="crt")
    assert out["sources"].first()["status"] == "resolved_conflict" and out["labels"].first()["lines"] == ["1 0.2 0.2 0.1 0.1"]


def test_incremental_and_frozen(spark):
    base = spark.createDataFrame([("p0", "c", "train", "h0", 4)], "path string, class string, split string, content string, index int")
    new = spark.createDataFrame([("p0", "c", "train", "h9"), ("p1", "c", "train", "h0"), ("p2", "c", "train", "h2"), ("p3", "c", "train", "h3")], "path string, class string, split string, content string")
    caps = spark.createDataFrame([("train", "c", 5)], "split string, class string, cap int")
    out = pipelines.incremental(base, new, "content", caps, 1)
    assert sorted((r["path"], r["index"]) for r in out["added"].collect()) == [("p2", 5), ("p3", 6)] and out["short"].first()["available"] == 2
    rows = lambda *r: spark.createDataFrame(list(r), "md5 string, class string, path string")
    targets = spark.createDataFrame([("c", 1, 1)], "class string, boost_target int, manual_target int")
    got = pipelines.frozen(rows(("a", "c", "r1")), rows(("a", "c", "b1"), ("b", "c", "b2")), rows(("d", "c", "m1")), targets)
    assert {r["path"] for r in got["images"].collect()} == {"r1", "m1"} and [r["path"] for r in got["warnings"].collect()] == ["b1"]


def test_stream_keeps_each_content_once(spark, tmp_path):
    from granary.streaming import ingest

    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 00:06:00")], "md5 string, t string").select("md5", F.to_timestamp("t").alias("t")).write.parquet(src)
    stream = ingest.first_contents(spark.readStream.schema("md5 string, t timestamp").parquet(src), "md5", "t")
    stream.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["md5"] for r in spark.table("firsts").collect()) == ["a", "b"]
