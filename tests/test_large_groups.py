"""Groups that hold most or all rows: ranks by ranges, boxes by grids, against plain versions."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from granary.functions import sha256
from granary.operators import boxes, dedup, manifest, ranks, reconcile, validation

BOX = "image string, box_id string, seq int, box_source string, xc double, yc double, w double, h double"


def shared(a, b):
    x = max(0, min(a[0] + a[2] / 2, b[0] + b[2] / 2) - max(a[0] - a[2] / 2, b[0] - b[2] / 2))
    return x * max(0, min(a[1] + a[3] / 2, b[1] + b[3] / 2) - max(a[1] - a[3] / 2, b[1] - b[3] / 2))


def random_boxes(rng, n):
    """Of all sizes, on the borders of cells too, some outside of the image, and some copies with small shifts."""
    out = []
    for _ in range(n):
        if out and rng.random() < 0.4:
            x, y, w, h = rng.choice(out)
            out.append((x + rng.choice([0, 0.001, w / 50]), y, w * rng.choice([1, 1.02]), h))
        else:
            size = rng.choice([0.0005, 0.004, 0.0156, 0.0625, 0.25, 0.6, 2.5])
            out.append((rng.choice([0.25, 0.5, rng.uniform(-0.5, 1.5)]), rng.choice([0.25, 0.125, rng.uniform(-0.5, 1.5)]), size * rng.choice([1, rng.random()]), size * rng.choice([1, rng.random()])))
    return out


def test_meeting_boxes_are_those_that_share_an_area(spark):
    rng = random.Random(2)
    found = [(g, f"{i:03d}", *b) for g in ("p", "q", None) for i, b in enumerate(random_boxes(rng, 120))]
    odd = [("p", "n1", float("nan"), 0.5, 0.1, 0.1), ("p", "n2", 0.5, 0.5, float("inf"), 0.1), ("p", "n3", 0.5, 0.5, 0.0, 1.0), ("p", "n4", 0.5, 0.5, -1.0, -1.0), ("p", "n5", None, 0.5, 1.0, 1.0)]
    rows = spark.createDataFrame(found + odd, "g string, id string, xc double, yc double, w double, h double")
    got = [(r["g"], r["a"]["key"], r["b"]["key"]) for r in boxes.meeting(rows, ["g"], "id").collect()]
    want = {(a[0], a[1], b[1]) for a, b in itertools.combinations(found, 2) if a[0] == b[0] and min(a[2] + a[4] / 2, b[2] + b[4] / 2) > max(a[2] - a[4] / 2, b[2] - b[4] / 2) and min(a[3] + a[5] / 2, b[3] + b[5] / 2) > max(a[3] - a[5] / 2, b[3] - b[5] / 2)}
    assert set(got) == want and len(got) == len(want) > 500


def plain_elimination(rows):
    """rows: (box_id, source, xc, yc, w, h) in list order; the first overlapping pair loses its worse box, again and again."""
    alive, fate = list(rows), {}
    rank = lambda r: (r[1].startswith("synthetic"), r[1] == "synthetic_missing_label", r[4] * r[5], r[0])
    while True:
        for a, b in itertools.combinations(alive, 2):
            s = shared(a[2:], b[2:])
            one, two = a[4] * a[5], b[4] * b[5]
            why = "iou_threshold" if s / (one + two - s) >= 0.85 else "coverage_threshold" if s / min(one, two) >= 0.9 else None
            if why:
                worse, better = (a, b) if rank(a) > rank(b) else (b, a)
                fate[worse[0]] = (better[0], why)
                alive.remove(worse)
                break
        else:
            return {r[0]: fate.get(r[0], (None, None)) for r in rows}


@pytest.mark.parametrize("seed", [1, 5])
def test_elimination_in_rounds(spark, seed):
    rng = random.Random(seed)
    rows = []
    for g in ("a", "b", None):
        for i, b in enumerate(random_boxes(rng, 70)):
            rows.append((g, f"{rng.randrange(1000):03d}-{i}", i // 3 if seed == 1 else i, rng.choice(["label", "label", "synthetic_full_image", "synthetic_missing_label"]), *b))
    got = {(r["image"], r["box_id"]): (r["kept_by"], r["reason"]) for r in boxes.deduplicated(spark.createDataFrame(rows, BOX), ["image"]).collect()}
    for g in ("a", "b", None):
        listed = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]))
        want = plain_elimination([(r[1], r[3], *r[4:]) for r in listed])
        assert {k[1]: v for k, v in got.items() if k[0] == g} == want
    assert sum(v[0] is not None for v in got.values()) > 40


def test_many_boxes_in_one_group(spark):
    """20,000 boxes of one image in clusters of four: no task gets the group, and few pairs are looked at."""
    rows = spark.range(20_000).select(
        F.lit("one").alias("image"), F.format_string("%06d", "id").alias("box_id"), F.col("id").cast("int").alias("seq"), F.lit("label").alias("box_source"),
        (F.floor(F.col("id") / 4) % 100 / 100 + F.col("id") % 4 * 0.0001).alias("xc"), (F.floor(F.col("id") / 400) / 50).alias("yc"), F.lit(0.008).alias("w"), (F.lit(0.008) + F.col("id") % 4 * 1e-6).alias("h"),
    )
    found = boxes.deduplicated(rows, ["image"])
    assert {r["kept"]: r["count"] for r in found.groupBy("kept").count().collect()} == {True: 5000, False: 15000}
    assert found.where("kept").selectExpr("bool_and(cast(box_id as int) % 4 = 0)").first()[0]
    assert boxes.meeting(rows, ["image"], "box_id").count() == 6 * 5000


def test_overlaps_of_label_files(spark):
    rng = random.Random(3)
    found = [("f", i, *b) for i, b in enumerate(random_boxes(rng, 60))] + [("f", 60, float("nan"), 0.5, 0.5, 0.5)]
    got = {(r["a"], r["b"]) for r in validation.label_overlaps(spark.createDataFrame(found, "path string, at int, xc double, yc double, w double, h double")).collect()}
    want = set()
    for a, b in itertools.combinations(found[:-1], 2):
        s = shared(a[2:], b[2:])
        one, two = max(a[4] * a[5], 1e-12), max(b[4] * b[5], 1e-12)
        if s > 0 and max(s / one, s / two) >= 0.9:
            want.add((a[1], b[1]))
    assert got == want and want


def test_numbers_in_one_content(spark):
    """All rows of one content: they are numbered right, and no task has more than a few ranges of them."""
    n = 60_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("id"), F.when(F.col("id") % 1000 == 1, F.lit(None)).otherwise("c").cast("string").alias("md5"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # else so few rows are one partition
    try:
        out = ranks.numbered(rows, ["md5"], [F.desc("id")], "k")
        sizes = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg({"count": "max"}).first()[0]
    finally:
        spark.conf.set(key, old)
    assert sizes < 0.6 * n
    assert out.groupBy("md5").agg(F.count("*").alias("n"), F.max("k").alias("m"), F.count_distinct("k").alias("d")).where("n <> m or n <> d").count() == 0
    one = out.where("md5 is not null").orderBy("k").select("id").toPandas()["id"]
    assert (one.diff().dropna() < 0).all()
    found = dedup.ranked(rows.where("md5 = 'c'"), "md5", ["id"])
    assert found.where("duplicate_role = 'canonical'").count() == 1 and found.agg(F.max("duplicate_rank")).first()[0] == rows.where("md5 = 'c'").count()
    assert ranks.numbered(rows.limit(0), ["md5"], ["id"], "k").count() == 0 and ranks.numbered(rows, [], ["id"], "k").where("k <> id + 1").count() == 0


def test_running_numbers_and_names_of_one_key(spark):
    rows = spark.range(3000).select("id", F.lit("a.jpg").alias("name"), F.lit("train").alias("split"))
    got = reconcile.numbered_on(rows, spark.createDataFrame([("train", 17)], "split string, index int"), ["split"], [F.col("id")])
    assert got.where("index <> id + 18").count() == 0
    names = reconcile.unique_names(rows, "name", [F.col("id")]).orderBy("id").limit(3).collect()
    assert [r["unique_name"] for r in names] == ["a.jpg", "a__2.jpg", "a__3.jpg"]


def test_shares_of_overlaps_are_rounded_as_in_sql(spark):
    """A share of 0.85006249999999990 is 850,063 millionths: SQL multiplies before it rounds."""
    found = [("f", 0, 0.44, 0.43000000000000005, 0.5, 0.48), ("f", 1, 0.48, 0.42400000000000004, 0.45, 0.47)]
    got = validation.label_overlaps(spark.createDataFrame(found, "path string, at int, xc double, yc double, w double, h double")).collect()
    assert [round(r["a_covered"] * 1_000_000) for r in got] == [850063]


def test_keys_are_dealt_over_all_partitions(spark):
    """Bare keys compress so well that Spark put most of them into one task; and annotations of a class met in one."""
    from granary.functions import labels
    from granary.operators import manifest

    plan = lambda found: found._jdf.queryExecution().executedPlan().toString()
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "key long")
    found = reconcile.sides(keys, spark.createDataFrame([(2,), (3,)], "key long"), "key")
    assert plan(found).count("REPARTITION_BY_NUM") == 4 and "ENSURE_REQUIREMENTS" not in plan(found)
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, "images_without_labels"), (3, "labels_without_images"), (None, "images_without_labels")]
    annotations, categories = spark.createDataFrame([(5, 1), (5, 1), (6, 2), (7, 9)], "image_id long, category_id int"), spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    mapped = manifest.mapped_annotations(annotations, categories, labels.Policy(targets=("a",), mapping={"a": "a"}))
    assert "BroadcastHashJoin" in plan(mapped) and "Exchange hashpartitioning" not in plan(mapped)
    assert manifest.kept_images(spark.createDataFrame([(5,), (6,), (7,)], "id long"), mapped).collect() == [(5,)]


def test_digests_of_folders_of_any_size(spark, monkeypatch):
    """Folders over many pieces, read in rounds, beside small ones, and in one folder alone."""
    rows = [(f"{folder}/{i}.png", hashlib.sha256(f"{folder}{i}".encode()).hexdigest()) for folder, n in (("a", 60), ("a/b", 1), ("c", 30), ("d", 3), ("e", 60)) for i in range(n)]
    rows += [("top.png", "00"), ("a/é.png", "11"), (None, "22")]
    want = {}
    for path, digest in sorted(r for r in rows if r[0]):
        want.setdefault("/".join(path.split("/")[:-1]), []).append(path + digest)
    want = {k: (len(x), hashlib.sha256("".join(x).encode()).hexdigest()) for k, x in want.items()} | {None: (1, hashlib.sha256(b"").hexdigest())}
    files = spark.createDataFrame(rows, "path string, sha256 string").repartition(3)
    for bits, size in ((17, 1 << 20), (3, 1500), (4, 1)):
        monkeypatch.setattr(manifest, "PIECE_BITS", bits)
        monkeypatch.setattr(manifest, "ROUND_BYTES", size)
        got = {r["folder"]: (r["files"], r["sha256"]) for r in manifest.folder_digests(files).collect()}
        assert got == want


@pytest.mark.parametrize("openssl", [True, False])
def test_hashes_are_taken_up_again(monkeypatch, openssl):
    if not openssl:
        monkeypatch.setattr(sha256, "_openssl", lambda: None)
    rng = random.Random(3)
    for _ in range(40):
        state, whole = sha256.START, b""
        for _ in range(rng.randint(0, 6)):
            data = rng.randbytes(rng.choice((0, 1, 55, 56, 63, 64, 65, 300)))
            state, whole = sha256.read_on(state, data), whole + data
        assert sha256.hex_digest(state) == hashlib.sha256(whole).hexdigest()
