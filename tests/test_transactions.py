"""File actions: the same files and statuses, however often tasks fail, are tried again or the driver dies."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from granary.sources import filetree, sinks, transactions

ROOT = Path(__file__).resolve().parents[1]


def listing(top):
    return {str(p.relative_to(top)): p.read_text() for p in sorted(Path(top).rglob("*")) if p.is_file()}


def made(top, n=40):
    for i in range(n):
        (top / "in").mkdir(exist_ok=True, parents=True)
        (top / f"in/{i}.txt").write_text(f"text {i}")
    rows = []
    for i in range(n):
        source, target = str(top / f"in/{i}.txt"), str(top / f"out/{i % 3}/{i}.txt")
        rows.append((["copy", "move", "delete", "write"][i % 4], source if i % 4 < 3 else None, target if i % 4 != 2 else None, f"new {i}" if i % 4 == 3 else None))
    return rows + [("move", str(top / "in/none.txt"), str(top / "out/none.txt"), None), ("delete", str(top / "in/none2.txt"), None, None)]


def wanted(n=40):
    files = {f"in/{i}.txt": f"text {i}" for i in range(n) if i % 4 in (0, 3)}
    return files | {f"out/{i % 3}/{i}.txt": f"new {i}" if i % 4 == 3 else f"text {i}" for i in range(n) if i % 4 != 2}


PLAN = "action string, source string, target string, content string"


def test_a_plan_is_carried_out_once(spark, tmp_path):
    top = tmp_path / "data"
    plan = spark.createDataFrame(made(top), PLAN).repartition(5)
    before = listing(top)
    assert {r["status"] for r in sinks.apply_plan(plan).collect()} == {"planned", "missing_source"} and listing(top) == before
    run = str(tmp_path / "run")
    done = sinks.apply_plan(plan, dry_run=False, run=run)
    first = sorted(map(tuple, done.collect()), key=repr)
    assert first == sorted(map(tuple, done.collect()), key=repr)  # reading it again does nothing again
    assert listing(top) == wanted() and sum(r[3] == "missing_source" for r in first) == 2 and len(first) == 42
    assert sorted(map(tuple, transactions.resume(spark, run).collect()), key=repr) == first and listing(top) == wanted()


def test_a_run_that_stopped_anywhere_is_resumed(spark, tmp_path):
    top, run = tmp_path / "data", str(tmp_path / "run")
    plan = spark.createDataFrame(made(top), PLAN).repartition(4)
    before = listing(top)
    transactions.staged(plan, run)
    in_place = {k: v for k, v in listing(top).items() if not k.endswith(".part")}
    assert in_place == before  # nothing has happened yet
    for name in transactions._got(run, "committed")[:2]:  # some tasks were through, one of them twice
        lines = [json.loads(x) for x in transactions._journal(run, name).read_text().splitlines()]
        for line in lines + lines[:3]:
            transactions._carried_out(line)
    stray = top / "out/0/.granary-x-0.part"
    stray.write_text("of an attempt that wasn't committed")
    transactions._journal(run, "x").write_text(json.dumps({"action": "copy", "source": "a", "target": "b", "staged": str(stray), "status": "ok"}) + '\n{"action": "co')
    statuses = [r["status"] for r in transactions.resume(spark, run).collect()]
    assert listing(top) == wanted() and statuses.count("missing_source") == 2 and len(statuses) == 42


def test_a_run_that_was_not_committed_is_taken_back(spark, tmp_path):
    top, run = tmp_path / "data", str(tmp_path / "run")
    rows = made(top)
    before = listing(top)
    with pytest.raises(ValueError, match="named twice"):
        transactions.staged(spark.createDataFrame([*rows, ("write", None, rows[0][2], "another")], PLAN).repartition(3), run)
    assert listing(top) == before and transactions.resume(spark, run) is None
    with pytest.raises(Exception, match="no action"):
        transactions.staged(spark.createDataFrame([*rows, ("link", "a", "b", "")], PLAN).repartition(3), str(tmp_path / "other"))
    assert listing(top) == before


def test_a_plan_that_lists_what_it_moves(spark, tmp_path):
    """The listing is read once: moved files aren't missing from it, and no target is listed as a source."""
    made(tmp_path / "data", 30)
    root = str(tmp_path / "data/in")
    files = filetree.list_files(spark, root) if hasattr(filetree, "list_files") else spark.read.format("binaryFile").load(root).select(F.element_at(F.split("path", "/"), -1).alias("path"))
    plan = files.select(F.lit("move").alias("action"), F.concat(F.lit(f"{root}/"), "path").alias("source"), F.concat(F.lit(f"{root}/moved-"), "path").alias("target"))
    got = sinks.apply_plan(plan, dry_run=False)
    for _ in range(2):
        assert [r["status"] for r in got.collect()] == ["ok"] * 30
    assert sorted(os.listdir(root)) == sorted(f"moved-{i}.txt" for i in range(30))


SCRIPT = """
import os, sys, tempfile
from pathlib import Path
from pyspark.sql import SparkSession
from granary.sources import sinks
top, always = Path(sys.argv[1]), sys.argv[2] == "always"
conf = {"spark.ui.enabled": "false", "spark.checkpoint.dir": str(top / "shared"), "spark.sql.execution.arrow.maxRecordsPerBatch": "3", "spark.python.worker.reuse": "false"}
spark = SparkSession.builder.master("local[2,3]").config(map=conf).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
plan = spark.read.json(str(top / "plan.jsonl"), schema="action string, source string, target string, content string").repartition(4)
def failing(batches):
    for i, rows in enumerate(batches):
        mark = top / f"failed-{rows['source'].iloc[0] or rows['target'].iloc[0]}".replace("/", "_")
        mark = top / os.path.basename(str(mark))
        if i == 2 and (always or not mark.exists()):
            mark.touch()
            raise RuntimeError("halfway")
        yield rows
try:
    found = sinks.apply_plan(plan.mapInPandas(failing, plan.schema), dry_run=False)
    print("STATUS", sorted(r["status"] for r in found.collect()).count("ok"))
except Exception as e:
    print("FAILED", "halfway" in str(e))
"""


@pytest.mark.parametrize("when,said", [("once", "STATUS 40"), ("always", "FAILED True")])
def test_tasks_that_fail_halfway(tmp_path, when, said):
    top = tmp_path / "data"
    rows = made(top)
    before = listing(top)
    (tmp_path / "plan.jsonl").write_text("\n".join(json.dumps(dict(zip(("action", "source", "target", "content"), r, strict=True))) for r in rows))
    (tmp_path / "job.py").write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(tmp_path / "job.py"), str(tmp_path), when], env=os.environ | {"PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=200)
    assert said in out.stdout, out.stdout + out.stderr[-3000:]
    assert list(tmp_path.glob("*in_*.txt")), "no task failed"
    assert listing(top) == (wanted() if when == "once" else before)
