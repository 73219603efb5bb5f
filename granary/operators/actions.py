"""Plans of file actions (action, source, target, content), for ``sinks.apply_plan``; nothing here touches a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import paths


def _plan(rows: DataFrame, action: str, source: Column, target: Column | None = None, content: Column | None = None) -> DataFrame:
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    return rows.select(F.lit(action).alias("action"), text(source).alias("source"), text(target).alias("target"), text(content).alias("content"))


def _below(root: str, path: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), path)


def folded(path: Column) -> Column:
    """A path as the same one in any spelling: small letters, one kind of slash."""
    return F.lower(F.replace(path, F.lit("\\"), F.lit("/")))


def keep_only(files: DataFrame, kept: DataFrame, root: str) -> DataFrame:
    """Deletions of the files (path) that ``kept`` (path) doesn't name, whatever its letters' case and slashes."""
    names = kept.where(F.coalesce("path", F.lit("")) != "").select(folded(F.col("path")).alias("__kept")).distinct()
    left = files.join(names, folded(F.col("path")) == F.col("__kept"), "left_anti")
    return _plan(left, "delete", _below(root, F.col("path")))


def drop_duplicates(groups: DataFrame, root: str) -> DataFrame:
    """Deletions of the images that a group (removed: array of paths) doesn't keep, and of their label files."""
    gone = groups.select(F.explode("removed").alias("path"))
    both = gone.select("path").union(gone.select(paths.label_path(F.col("path"))))
    return _plan(both, "delete", _below(root, F.col("path")))


def to_split_first(files: DataFrame, old_root: str, new_root: str) -> DataFrame:
    """Moves of files (path) from an old layout to the one that names the split first; those that lie right already are left."""
    moved = files.withColumn("new", paths.to_split_first(F.col("path"))).where((F.col("new") != F.col("path")) | F.lit(old_root != new_root))
    return _plan(moved, "move", _below(old_root, F.col("path")), _below(new_root, F.col("new")))


def rewritten(labels: DataFrame, root: str) -> DataFrame:
    """Writes of label files (path, content, changed) that changed."""
    return _plan(labels.where("changed"), "write", F.lit(None), _below(root, F.col("path")), F.col("content"))


def exported(rows: DataFrame, image_source: str, image_target: str, label_target: str, lines: str, out_root: str) -> DataFrame:
    """Copies of images and writes of their label files. lines: an array column."""
    text = F.when(F.size(lines) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    images = _plan(rows, "copy", F.col(image_source), _below(out_root, F.col(image_target)))
    return images.union(_plan(rows, "write", F.lit(None), _below(out_root, F.col(label_target)), text))


REVIEW_FIELDS = (
    "priority_rank", "batch_rank", "decision", "notes", "reason", "current_label", "source_dataset", "original_filename", "source_relpath", "copied_image", "copy_status", "unique_id",
)


def review_package(rows: DataFrame, files: DataFrame, root: str, out_root: str) -> tuple[DataFrame, DataFrame]:
    """The reduced table of a review batch, and the copies of its images.

    rows: a batch (text columns priority_rank, batch_rank, unique_id, source_dataset, original_filename, source_relpath,
    mapped_label, reason). files: (path), what there is below root; other images are ``missing_source``.
    """
    ending = F.lower(paths.suffix(F.col("original_filename")))
    ending = F.when(ending != "", ending).when(paths.suffix(F.col("source_relpath")) != "", F.lower(paths.suffix(F.col("source_relpath")))).otherwise(".jpg")
    rank = F.col("priority_rank").cast("string")
    padded = F.when(F.length(rank) < 4, F.lpad(rank, 4, "0")).otherwise(rank)
    image = F.concat(F.concat_ws("__", padded, paths.safe_stem(F.col("source_dataset")), F.col("unique_id")), ending)
    there = files.select(F.col("path").alias("__file"), F.lit("ok").alias("__status")).distinct()
    out = rows.join(there, F.col("source_relpath") == F.col("__file"), "left").withColumns(
        {
            "decision": F.col("mapped_label"), "current_label": F.col("mapped_label"), "notes": F.lit(""), "copied_image": F.concat(F.lit("images/"), image),
            "copy_status": F.coalesce("__status", F.lit("missing_source")),
        }
    ).select(*REVIEW_FIELDS)
    return out, _plan(out.where("copy_status = 'ok'"), "copy", _below(root, F.col("source_relpath")), _below(out_root, F.col("copied_image")))
