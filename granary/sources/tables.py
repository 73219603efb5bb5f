"""CSV, JSON and YAML as the curation tools write them."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources import pieces


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None, empty_if_missing: bool = False, ordered: bool = True) -> DataFrame:
    """All columns as text, absent values as "". Quoted line breaks, doubled quotes and a byte order mark are understood.

    Files are read in splits, whatever their quotes (``pieces.csv_records``). ordered: rows come sorted by file and place
    (a sort by ranges); without it they come in any order.
    Names are those of the first file's first record. No file, if that is allowed, and nothing in it: no rows.
    """
    import csv
    import io

    nothing = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or ("empty",)]))
    if empty_if_missing and not os.path.exists(path):
        return nothing
    records = pieces.csv_records(spark, path)
    first = records.where("head").orderBy("file").select("record").first()
    if first is None:
        return nothing
    names = next(csv.reader(io.StringIO(first["record"], newline="")), [])
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    records = records.where("not head")
    records = records.orderBy("file", "block", "place") if ordered else records
    parsed = records.select(F.from_csv("record", schema, {"quote": '"', "escape": '"'}).alias("x"))
    return parsed.select(*[F.coalesce(F.col(f"x.c{i}"), F.lit("")).alias(c) for i, c in enumerate(names)])


def read_config(path: str) -> dict:
    """A JSON file, with or without a byte order mark."""
    return json.loads(Path(path).read_text(encoding="utf-8-sig"))


def read_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The images, annotations and categories of a COCO document, which is read in splits."""
    return pieces.json_arrays(spark, path, ("images", "annotations", "categories"))


def read_runs(spark: SparkSession, files: dict[str, str], metrics: dict[str, str]) -> DataFrame:
    """(run, epoch, metrics): results files, one a run, united. metrics: new name to the name in the files."""
    out = None
    for run, path in files.items():
        raw = read_csv(spark, path)
        raw = raw.toDF(*[c.strip() for c in raw.columns])
        number = lambda c: F.trim(F.col(f"`{c}`")).try_cast("double")
        own = raw.select(F.lit(run).alias("run"), number("epoch").alias("epoch"), *[number(old).alias(new) for new, old in metrics.items()], F.monotonically_increasing_id().alias("line"))
        out = own if out is None else out.unionByName(own)
    return out


def last_epochs(runs: DataFrame) -> DataFrame:
    """runs (run, epoch, line, ...) with whole epochs, of each the last line of its file."""
    whole = runs.where(F.col("epoch").isNotNull()).withColumn("epoch", F.floor("epoch").cast("int"))
    row = F.struct(*[F.col(c) for c in whole.columns if c != "line"])
    return whole.groupBy("run", "epoch").agg(F.max_by(row, "line").alias("x")).select("x.*")


def decisions(spark: SparkSession, root: str, name: str = "review_reduced.csv") -> DataFrame:
    """(unique_id, decision, file, line) of all decision files below a folder; ``sequence`` orders them by path and line.

    Files that can't be read, and rows without an id or a decision, are left out. No folder: no rows.
    """
    import csv
    import io

    import pandas as pd

    from granary.sources.filetree import listing

    def read(batches):
        for files in batches:
            out = []
            for path, content in zip(files["path"], files["content"], strict=True):
                try:
                    rows = list(csv.DictReader(io.StringIO(bytes(content).decode("utf-8-sig"), newline="")))
                except (UnicodeDecodeError, csv.Error):
                    continue
                for line, row in enumerate(rows):
                    uid, decision = (row.get("unique_id") or "").strip(), (row.get("decision") or "").strip()
                    if uid and decision:
                        out.append((uid, decision, path, line))
            yield pd.DataFrame(out, columns=["unique_id", "decision", "file", "line"])

    files = listing(spark, root, content=True, endings=(name,)).where(F.element_at(F.split("path", "/"), -1) == name)
    found = files.select("path", "content").mapInPandas(read, "unique_id string, decision string, file string, line long")
    return found.withColumn("sequence", F.struct(F.split("file", "/").alias("file"), "line"))


def class_names(text: str, strict: bool = False) -> dict[int, str]:
    """The ``names`` of a dataset's YAML: a list in one line, a list, or lines of ``id: name``. strict: raise if there are none."""
    unquoted = lambda s: s.strip().strip("'\"")
    found: dict[int, str] = {}
    lines = text.lstrip("﻿").splitlines()
    for i, line in enumerate(lines):
        if not (head := re.match(r"names\s*:\s*(.*)$", line)):
            continue
        inline = head[1].split("#")[0].strip()
        if inline.startswith("["):
            found = {k: unquoted(n) for k, n in enumerate(x for x in inline.strip("[]").split(",") if x.strip())}
            break
        for below in lines[i + 1 :]:
            if below.strip() and not below[0].isspace() and not below.startswith("-"):
                break
            if entry := re.match(r"\s+(\d+)\s*:\s*(.+)$", below):
                found[int(entry[1])] = unquoted(entry[2])
            elif entry := re.match(r"\s*-\s+(.+)$", below):
                found[len(found)] = unquoted(entry[1])
        break
    if strict and not found:
        raise ValueError("no class names")
    return found


def names_of_dataset(root: str, order: tuple[str, ...] = ("data.yaml", "dataset.yaml"), strict: bool = False) -> dict[int, str]:
    """The class names of the first of these files that there is."""
    for name in order:
        if (path := Path(root, name)).exists():
            return class_names(path.read_text(encoding="utf-8-sig"), strict)
    if strict:
        raise ValueError(f"none of {', '.join(order)} in {root}")
    return {}


def registry(spark: SparkSession, entries: list[dict], default_action: str = "active") -> DataFrame:
    """Source entries as rows; absent fields are "" and the action its default."""
    fields = ("id", "type", "root", "canonical_class", "action", "source_family", "source_trust")
    rows = [tuple(str(e.get(f) or (default_action if f == "action" else "")) for f in fields) for e in entries]
    return spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fields))


def dispatched(sources: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """sources with ``route``: excluded, manual, their type, or unsupported_type with its name."""
    route = (
        F.when(F.col("action") == "exclude_for_now", F.lit("excluded")).when(F.col("action") == "manual_separation_required", F.lit("manual"))
        .when(F.col("type").isin(*types), F.col("type")).otherwise(F.concat(F.lit("unsupported_type:"), "type"))
    )
    return sources.withColumn("route", route)


def source_status(sources: DataFrame, class_map: DataFrame, found: DataFrame) -> DataFrame:
    """sources with ``files`` and ``status``: their action if it isn't active, unmapped_class, missing, or active.

    class_map: (source_folder, canonical_class). found: (id, files) of the roots that there are.
    """
    mapped = class_map.select(F.col("source_folder").alias("id"), F.col("canonical_class").alias("mapped_class")).dropDuplicates(["id"])
    out = sources.join(mapped, "id", "left").join(found, "id", "left")
    status = (
        F.when(F.col("action") != "active", F.col("action")).when(F.coalesce("mapped_class", F.lit("")) == "", F.lit("unmapped_class"))
        .when(F.col("files").isNull(), F.lit("missing")).otherwise("active")
    )
    return out.withColumns({"status": status, "files": F.coalesce("files", F.lit(0))})


def class_map_rows(rows: DataFrame, keep: str = "active") -> DataFrame:
    """Class-map rows that are active, or (not_excluded) anything but excluded; of a folder's rows the last one counts.

    rows come from ``read_csv``, in the files' order, so that their numbers are in the file's order.
    """
    status = F.lower(F.trim("status"))
    some = rows.where(status == "active") if keep == "active" else rows.where(status != "exclude")
    whole = F.struct(*[F.col(c) for c in some.columns])
    order = F.monotonically_increasing_id()
    return some.withColumn("__at", order).groupBy("source_folder").agg(F.max_by(whole, "__at").alias("x")).select("x.*")
