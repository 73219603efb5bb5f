"""Expressions on paths with ``/``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Image endings, folders that are never scanned, and split names with their old alias.
IMAGE_ENDINGS = (".jpg", ".jpeg", ".png", ".bmp", ".webp")
BLOCKED_FOLDERS = ("dismissed_dark", "dismissed_small", "__pycache__")
SPLITS = ("train", "valid", "test")


def parts(path: Column) -> Column:
    return F.split(path, "/")


def name(path: Column) -> Column:
    return F.element_at(parts(path), -1)


def suffix(path: Column) -> Column:
    """The last ending with its dot; empty for names that only start with a dot."""
    return F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]+)$", 1)


def stem(path: Column) -> Column:
    return F.substr(name(path), F.lit(1), F.length(name(path)) - F.length(suffix(path)))


def parent_name(path: Column) -> Column:
    return F.coalesce(F.try_element_at(parts(path), F.lit(-2)), F.lit(""))


def is_image(path: Column) -> Column:
    return F.lower(suffix(path)).isin(*IMAGE_ENDINGS)


def is_blocked(path: Column, exact: bool = False) -> Column:
    """Whether a folder of the path (relative to its root) is never scanned: by name, or by holding ``dismis``."""
    folders = F.slice(parts(path), F.lit(1), F.size(parts(path)) - 1)
    if exact:
        return F.exists(folders, lambda p: p.isin(*BLOCKED_FOLDERS))
    return F.exists(folders, lambda p: F.lower(p).contains("dismis") | (p == "__pycache__"))


def split_of(path: Column, default: str = "train") -> Column:
    """The split that a folder of the path names; train before valid (or val) before test."""
    low = F.transform(parts(path), lambda p: F.lower(p))
    return (
        F.when(F.array_contains(low, "train"), F.lit("train"))
        .when(F.array_contains(low, "valid") | F.array_contains(low, "val"), F.lit("valid"))
        .when(F.array_contains(low, "test"), F.lit("test"))
        .otherwise(default)
    )


def label_path(path: Column, fallback_folder: str | None = None) -> Column:
    """Where an image's label file lies: the first ``images`` folder as ``labels``, with the ending .txt.

    Without such a folder: ``fallback_folder``, or beside the image.
    """
    p = parts(path)
    at = F.array_position(F.transform(p, lambda x: F.lower(x)), "images")
    renamed = F.array_join(F.transform(F.slice(p, F.lit(1), F.size(p) - 1), lambda x, i: F.when(i == at - 1, F.lit("labels")).otherwise(x)), "/")
    folder = F.when(at > 0, renamed).otherwise(
        F.lit(fallback_folder) if fallback_folder is not None else F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), "/")
    )
    return F.concat(F.when(folder == "", F.lit("")).otherwise(F.concat(folder, F.lit("/"))), stem(path), F.lit(".txt"))


def planned_path(label: Column, batch: Column, kind: str, md5: Column, ending: Column) -> Column:
    return F.concat_ws("/", F.lit("class_batches"), label, batch, F.lit("train"), F.lit(kind), F.concat(md5, ending))


def unique_id(source: Column, relative: Column) -> Column:
    return F.substr(F.sha1(F.concat(source, F.lit(":"), relative).cast("binary")), F.lit(1), F.lit(16))


def export_name(source: Column, label: Column, split: Column, sha1: Column, original: Column) -> Column:
    return F.concat(F.concat_ws("__", source, label, split, F.substr(sha1, F.lit(1), F.lit(8)), stem(original)), suffix(original))


def source_of_stem(s: Column) -> Column:
    """The part before the first ``__``, or unknown."""
    first = F.get(F.split(s, "__"), F.lit(0))
    return F.when(s.contains("__") & (first != ""), first).otherwise("unknown")


def source_bucket(stem_: Column, label: Column, folder: Column) -> Column:
    """What lies between the label and the last ``__`` of a stem, or its folder."""
    start = F.concat(label, F.lit("__"))
    rest = F.when(F.startswith(stem_, start), F.substr(stem_, F.length(start) + 1)).otherwise(stem_)
    return F.when(rest.contains("__"), F.regexp_extract(rest, "^(.*)__", 1)).otherwise(folder)


def md5_of_name(n: Column) -> Column:
    return F.regexp_extract(n, "^[0-9a-f]{32}", 0)


def before_underscore(n: Column) -> Column:
    return F.substring_index(n, "_", 1)


def safe_stem(s: Column) -> Column:
    return F.regexp_replace(s, r"[^\p{L}\p{N}_-]", "_")


def is_relative(path: Column) -> Column:
    return (path != "") & ~path.startswith("/") & ~path.contains("://")


def to_split_first(path: Column) -> Column:
    """Old layouts put the split below images and labels, and call valid val."""
    moved = F.regexp_replace(path, r"(^|/)(images|labels)/(train|val|valid|test)(?=/|$)", "$1$3/$2")
    return F.regexp_replace(moved, r"(^|/)val(?=/)", "$1valid")


def path_order(path: Column) -> Column:
    """What to order paths by: component by component, not letter by letter."""
    return parts(path)
