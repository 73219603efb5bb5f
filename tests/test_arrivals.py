"""Listings in balanced tasks, and as streams; increments of a stream that stops and goes on."""

import os
import time

import pytest
from pyspark.sql import functions as F

from granary.operators import reconcile
from granary.sources import filetree
from granary.streaming import ingest


def test_one_large_folder_is_many_tasks(spark, tmp_path):
    big = tmp_path / "big"
    big.mkdir()
    for i in range(20_000):
        os.close(os.open(big / f"{i % 9973:05d}-{i}.txt", os.O_CREAT))
    for i in range(300):
        (tmp_path / f"s{i}/deep").mkdir(parents=True)
        (tmp_path / f"s{i}/deep/x.TXT").write_text("x")
        (tmp_path / f"s{i}/no.jpg").write_text("")
    spark.dataSource.register(filetree.FileTree)
    rows = spark.read.format("filetree").options(path=str(tmp_path), endings=".txt", files="1000").load()
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == rows.select("path").distinct().count() == 20_300 and max(sizes) <= 1000 and len(sizes) <= 25
    default = filetree.listing(spark, str(tmp_path), endings=(".txt",))
    assert default.rdd.getNumPartitions() <= 6 and default.count() == 20_300
    content = spark.read.format("filetree").options(path=str(tmp_path / "s1"), content="true", bytes="1").load()
    assert {(r["path"], bytes(r["content"])) for r in content.collect()} == {("deep/x.TXT", b"x"), ("no.jpg", b"")}


def test_folders_beyond_what_the_driver_looks_at(spark, tmp_path, monkeypatch):
    for i in range(30):
        (tmp_path / f"a{i}/b").mkdir(parents=True)
        (tmp_path / f"a{i}/b/{i}.txt").write_text(str(i))
    monkeypatch.setattr(filetree, "ENTRIES", 40)
    assert filetree.listing(spark, str(tmp_path)).count() == 30
    assert filetree.listing(spark, str(tmp_path / "none")).count() == 0


def run(stream, folder, name):
    query = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint-{name}").format("parquet").option("path", f"{folder}/out-{name}").trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()


def test_a_stream_takes_each_file_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in/a").mkdir(parents=True)
    for i in range(5):
        (tmp_path / f"in/a/{i}.txt").write_text(str(i))
    reader = filetree.FileTreeStream({"path": str(tmp_path / "in")})
    now = lambda: {"until": time.time_ns()}
    files = lambda start, end: sorted(r[0] for p in reader.partitions(start, end) for r in reader.read(p))
    first = now()
    assert files(reader.initialOffset(), first) == [f"a/{i}.txt" for i in range(5)]
    time.sleep(0.05)
    (tmp_path / "in/b").mkdir()
    (tmp_path / "in/b/new.txt").write_text("")
    os.utime(tmp_path / "in/b/new.txt", (1, 1))  # an old time of its content is no obstacle
    (tmp_path / "other.txt").write_text("")
    os.rename(tmp_path / "other.txt", tmp_path / "in/a/moved.txt")
    time.sleep(0.05)
    second = now()
    assert files(first, second) == ["a/moved.txt", "b/new.txt"] and files(first, second) == ["a/moved.txt", "b/new.txt"]
    assert files(second, now()) == []
    assert all(x.folder != "" for p in reader.partitions(second, now()) for x in p.value[0])


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        for i in range(3):
            (tmp_path / f"in/{k}-{i}.txt").write_text(str(i))
        time.sleep(filetree.SETTLE / 1e9 + 0.3)
        run(filetree.stream(spark, str(tmp_path / "in"), content=True), tmp_path, "z")
        found = [r["path"] for r in spark.read.parquet(str(tmp_path / "out-z")).collect()]
        assert sorted(found) == sorted(f"{a}-{i}.txt" for a in range(k + 1) for i in range(3))


ASSET = "class string, sha1 string, path string, t timestamp"


@pytest.mark.parametrize("restart", [True])
def test_increments_are_those_of_a_batch(spark, tmp_path, restart):
    rows = [("cat", "1", "a"), ("cat", "1", "b"), ("dog", "1", "c"), ("cat", "2", "d"), ("dog", "9", "e"), ("cat", "2", "f"), ("cat", "3", "g"), ("dog", "1", "h"), ("cat", "4", "i"), ("owl", "4", "j"), (None, "5", "k"), ("cat", None, "l")]
    rows = [(*r, f"2024-01-{1 + i // 4:02d} 0{i % 4}:00:00") for i, r in enumerate(rows)]
    for part in range(3):  # the stream stops after each
        own = spark.createDataFrame([(*r[:3], r[3]) for r in rows[4 * part : 4 * part + 4]], "class string, sha1 string, path string, t string").withColumn("t", F.to_timestamp("t"))
        own.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(ingest.increments(spark.readStream.schema(ASSET).parquet(str(tmp_path / "in")), "class", "sha1", "path", "t", {"cat": 17}), tmp_path, "x")
    got = {(r["class"], r["sha1"], r["path"], r["index"]) for r in spark.read.parquet(str(tmp_path / "out-x")).collect()}
    every = spark.createDataFrame([r[:3] for r in rows if r[0] and r[1]], "class string, sha1 string, path string")
    once = every.groupBy("class", "sha1").agg(F.min("path").alias("path"))
    batch = reconcile.numbered_on(once, spark.createDataFrame([("cat", 17)], "class string, index int"), ["class"], [F.col("path")])
    assert got == {(r["class"], r["sha1"], r["path"], r["index"]) for r in batch.collect()}


def test_contents_are_forgotten_but_numbers_are_not(spark, tmp_path):
    for part, rows in enumerate(([("cat", "1", "a", "2024-01-01"), ("cat", "2", "b", "2024-01-02")], [("dog", "1", "c", "2024-03-01")], [("dog", "2", "d", "2024-03-02")], [("cat", "1", "e", "2024-03-03")])):
        spark.createDataFrame(rows, "class string, sha1 string, path string, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(ingest.increments(spark.readStream.schema(ASSET).parquet(str(tmp_path / "in")), "class", "sha1", "path", "t", {}, keep="2 days"), tmp_path, "y")
    got = {(r["path"], r["index"]) for r in spark.read.parquet(str(tmp_path / "out-y")).collect()}
    assert got == {("a", 1), ("b", 2), ("c", 1), ("d", 2), ("e", 3)}
