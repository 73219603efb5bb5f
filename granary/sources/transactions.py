"""File actions as a transaction: tasks only stage and look, and nothing is moved, deleted or replaced before all have.

``staged`` writes a plan with a data source of its own. Each attempt of a task has a journal in the run's folder, and a
line there before each file that it stages under a name of its own beside the target. Spark commits one attempt of each
task; the others' files are known by their journals. ``finish`` then carries out the committed journals. Each step of it
can be repeated: what was done already is recognised. So a task that is retried or speculated, a driver that dies and
a plan that lists what it changes itself end in the same files and statuses.

The folders of the plan and of the run have to be mounted on all executors.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from granary import ship

ACTIONS = ("copy", "move", "write", "delete")
_LINE = "action string, source string, target string, staged string, status string"


@dataclass
class Attempt(WriterCommitMessage):
    """The attempt of a task that Spark commits, by its journal."""

    name: str


class FileActions(DataSource):
    """Writes a plan (action, source, target, content) as journals and staged files. Options: run, the run's folder."""

    @classmethod
    def name(cls) -> str:
        return "granary_actions"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return Stager(self.options["run"])


class Stager(DataSourceWriter):
    def __init__(self, run: str):
        self.run = run

    def write(self, iterator: Iterator[Row]) -> Attempt:
        name = uuid.uuid4().hex
        with _journal(self.run, name).open("w", encoding="utf-8") as journal:
            for i, row in enumerate(iterator):
                line = _looked_at(row, f".granary-{name}-{i}.part")
                print(json.dumps(line), file=journal, flush=True)
                if line["staged"]:
                    os.makedirs(os.path.dirname(line["staged"]), exist_ok=True)
                    if row["action"] == "write":
                        Path(line["staged"]).write_text(row["content"] or "", encoding="utf-8")
                    else:
                        shutil.copyfile(row["source"], line["staged"])
        return Attempt(name)

    def commit(self, messages: list[Attempt | None]) -> None:
        _put(self.run, "staged", [m.name for m in messages if m])

    def abort(self, messages: list[Attempt | None]) -> None:
        """Nothing is decided here: attempts may still be running. ``roll_back`` has all journals."""


def _journal(run: str, name: str) -> Path:
    return Path(run) / "journals" / f"{name}.jsonl"


def _put(run: str, name: str, attempts: list[str]) -> None:
    """A state of the run, there as a whole or not at all."""
    target = Path(run) / f"{name}.json"
    part = target.with_name(f".{name}-{uuid.uuid4().hex}")
    part.write_text(json.dumps(attempts), encoding="utf-8")
    os.replace(part, target)


def _got(run: str, name: str) -> list[str] | None:
    path = Path(run) / f"{name}.json"
    return json.loads(path.read_text(encoding="utf-8")) if path.exists() else None


def _looked_at(row: Row, part: str) -> dict[str, str | None]:
    """The journal's line of an action: its status, and where it is staged if it has to be."""
    action, source, target = row["action"], row["source"], row["target"]
    if action not in ACTIONS:
        raise ValueError(f"no action: {action}")
    staged = None
    status = "ok" if action == "write" or os.path.exists(source) else "missing_source"
    if status == "ok" and action != "delete":
        folder = os.path.dirname(target)
        if action != "move" or not _one_device(source, folder):
            staged = os.path.join(folder, part)
    return {"action": action, "source": source, "target": target, "staged": staged, "status": status}


def _one_device(source: str, folder: str) -> bool:
    while not os.path.exists(folder):
        folder = os.path.dirname(folder)
    return os.stat(source).st_dev == os.stat(folder).st_dev


def _carried_out(line: dict[str, str | None]) -> None:
    """One line of a committed journal. What an earlier or concurrent attempt has done is left."""
    if line["status"] != "ok":
        return
    source, target = line["source"], line["target"]
    if line["action"] != "delete":
        os.makedirs(os.path.dirname(target), exist_ok=True)
        try:
            os.replace(line["staged"] or source, target)
        except FileNotFoundError:
            if not os.path.exists(target):
                raise
    if line["action"] == "delete" or line["action"] == "move" and line["staged"]:
        Path(source).unlink(missing_ok=True)


def _withdrawn(line: dict[str, str | None]) -> None:
    if line["staged"]:
        Path(line["staged"]).unlink(missing_ok=True)


def _for_each_journal(spark: SparkSession, run: str, names: list[str], what: str) -> None:
    """carry_out or withdraw each line of these journals, a task a journal."""
    ship(spark)

    def work(batches):
        for rows in batches:
            for name in rows["name"]:
                path = _journal(run, name)
                if path.exists():
                    with path.open(encoding="utf-8") as lines:
                        for text in lines:
                            if text.endswith("\n"):  # the last line of an attempt that was killed may not be whole, and then nothing is staged
                                (_carried_out if what == "carry_out" else _withdrawn)(json.loads(text))
                    if what == "withdraw":
                        path.unlink(missing_ok=True)
            yield rows

    if names:
        spark.createDataFrame([(n,) for n in names], "name string").repartition(len(names), "name").mapInPandas(work, "name string").count()


def staged(plan: DataFrame, run: str) -> None:
    """Stage a plan (action, source, target, content; absent columns are null) in the run's folder. Raises, and leaves nothing staged, if a task keeps failing
    or a target is named twice: which of two files stays must not depend on the order of tasks."""
    spark = plan.sparkSession
    ship(spark)
    (Path(run) / "journals").mkdir(parents=True)
    spark.dataSource.register(FileActions)
    whole = plan.select("action", *[F.col(c) if c in plan.columns else F.lit(None).cast("string").alias(c) for c in ("source", "target", "content")])
    try:
        whole.write.format(FileActions.name()).mode("append").option("run", run).save()
        twice = journalled(spark, run).where("status = 'ok' and target is not null").groupBy("target").count().where("count > 1").select("target").limit(5).collect()
        if twice:
            raise ValueError(f"targets that are named twice: {', '.join(sorted(r[0] for r in twice))}")
    except Exception:
        roll_back(spark, run)
        raise
    _put(run, "committed", _got(run, "staged"))


def journalled(spark: SparkSession, run: str) -> DataFrame:
    """(action, source, target, staged, status) of the attempts that Spark committed."""
    paths = [str(_journal(run, n)) for n in _got(run, "committed") or _got(run, "staged") or []]
    return spark.read.schema(_LINE).json(paths) if paths else spark.createDataFrame([], _LINE)


def finish(spark: SparkSession, run: str) -> DataFrame:
    """Carry out a committed run, as often as need be, and clean up what other attempts staged; returns (action, source, target, status)."""
    committed = _got(run, "committed")
    if committed is None:
        raise ValueError(f"{run} isn't committed")
    if _got(run, "done") is None:
        _for_each_journal(spark, run, committed, "carry_out")
        _for_each_journal(spark, run, sorted({p.stem for p in (Path(run) / "journals").glob("*.jsonl")} - set(committed)), "withdraw")
        _put(run, "done", committed)
    return journalled(spark, run).select("action", "source", "target", "status")


def roll_back(spark: SparkSession, run: str) -> None:
    """Remove all that a run which isn't committed has staged."""
    if _got(run, "committed") is not None:
        raise ValueError(f"{run} is committed: finish it")
    _for_each_journal(spark, run, sorted(p.stem for p in (Path(run) / "journals").glob("*.jsonl")), "withdraw")


def resume(spark: SparkSession, run: str) -> DataFrame | None:
    """After the driver died: finish a run that is committed; any other is rolled back, and None."""
    if _got(run, "committed") is not None:
        return finish(spark, run)
    roll_back(spark, run)
    return None
