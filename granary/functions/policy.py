"""Configuration of a dataset: policies with defaults by version, display names, class order and names of sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Misspelt parts of names that no source may have.
MISSPELT = ("batery", "tonner", "cartdrige")


@dataclass(frozen=True)
class Policies:
    """How labels are to be read, and what becomes of findings."""

    version: str
    instance_mode: str
    unlabeled_object_policy: str
    missing_instance_policy: str

    @property
    def multi_instance(self) -> bool:
        return self.instance_mode == "multi_instance"


def policies(config: dict) -> Policies:
    """The policies of a configuration. What it doesn't say is strict in version 2 and as it used to be in all others."""
    version = str(config.get("dataset_policy_version", "v1")).strip().lower()
    mode, unlabeled, missing = ("multi_instance", "warn_review_queue", "warn") if version == "v2" else ("legacy", "off", "off")

    def part(name: str) -> dict:
        given = config.get(name)
        return given if isinstance(given, dict) else {}

    annotation, qc = part("annotation_policy"), part("qc")
    return Policies(
        version, str(annotation.get("instance_mode", mode)), str(annotation.get("unlabeled_object_policy", unlabeled)), str(qc.get("missing_instance_policy", missing))
    )


def display_labels(class_map: DataFrame, configured: dict[str, str], sequence: str) -> DataFrame:
    """(canonical_class, display_label): the configured name, else the first one in the class map that isn't blank."""
    spark = class_map.sparkSession
    name, label = F.trim("canonical_class"), F.trim("portuguese_display_label")
    first = class_map.select(name.alias("canonical_class"), label.alias("display_label"), F.col(sequence).alias("__at"))
    first = first.where((F.col("canonical_class") != "") & (F.col("display_label") != "")).groupBy("canonical_class").agg(F.min_by("display_label", "__at").alias("display_label"))
    given = spark.createDataFrame(list(configured.items()), "canonical_class string, display_label string")
    return given.unionByName(first.join(given, "canonical_class", "left_anti"))


def misspelt(name: Column) -> Column:
    """Whether a name of a source, or of its folder, holds a part that is known to be misspelt."""
    return F.exists(F.array(*[F.lit(m) for m in MISSPELT]), lambda part: name.contains(part))


def refuse_misspelt(sources: DataFrame) -> None:
    """Raise if an id or root of sources is misspelt, naming the first five."""
    bad = sources.select(F.explode(F.array("id", "root")).alias("name")).where(misspelt(F.col("name"))).limit(5).collect()
    if bad:
        raise ValueError(f"misspelt sources: {', '.join(r['name'] for r in bad)}")


def class_order(rows: list[tuple[int, str]]) -> list[str]:
    """The class names by id; an error unless the ids are 0, 1, 2 and so on."""
    by_id = dict(rows)
    if len(by_id) != len(rows) or sorted(by_id) != list(range(len(rows))):
        raise ValueError("class ids are not contiguous")
    return [by_id[i] for i in range(len(rows))]


def extended_order(base: list[str], new: list[str]) -> list[str]:
    """The new class order, which has to begin with the whole old one."""
    if new[: len(base)] != base:
        raise ValueError("the class order doesn't keep that of the base")
    return new
