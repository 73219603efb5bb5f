"""Label names, review reasons and mapping policies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Review reasons of old queues that mean missing instances.
LEGACY_REASONS = ("single_object_problem", "single_object_only", "one_box_only", "single_instance_only")
POSSIBLE_MISSING, AMBIGUOUS, CROWDED = "possible_missing_instances", "ambiguous_occlusion", "crowded_scene_needs_review"


def normalize_label(label: Column) -> Column:
    """Lower case, with every run of other than letters and digits as one ``_``, and none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}]+", "_"), F.lit("_"))


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The entry of a small configured table, or null."""
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


@dataclass(frozen=True)
class Labelling:
    """How original labels become labels of the taxonomy."""

    label_map: dict[str, str] = field(default_factory=dict)
    component_source: str = ""
    component_map: dict[str, str] = field(default_factory=dict)
    negatives: tuple[str, ...] = ("negative",)
    review: dict[str, str] = field(default_factory=dict)
    taxonomy: tuple[str, ...] = ()
    multi_instance: bool = True

    def apply(self, label: Column, source: Column) -> Column:
        """struct(mapped, is_negative, status, reason) of a normalized label.

        A negative label wins over review, which is listed by the label before mapping; what is outside the taxonomy
        becomes negative and keeps its status.
        """
        component = F.coalesce(lookup(label, self.component_map), F.lit("negative"))
        mapped = F.when(source == self.component_source, component).otherwise(F.coalesce(lookup(label, self.label_map), label))
        negative = mapped.isin(*self.negatives) | (mapped == "negative")
        reason = review_reason(lookup(label, self.review), self.multi_instance)
        outside = ~negative & ~mapped.isin(*self.taxonomy) if self.taxonomy else F.lit(False)
        return F.struct(
            F.when(negative | outside, F.lit("negative")).otherwise(mapped).alias("mapped"),
            (negative | outside).alias("is_negative"),
            F.when(~negative & reason.isNotNull(), F.lit("pending")).otherwise("approved").alias("status"),
            F.when(negative, F.lit("mapped_negative")).when(outside, F.lit("out_of_taxonomy_default_negative")).otherwise(F.coalesce(reason, F.lit(""))).alias("reason"),
        )


def review_reason(reason: Column, multi_instance: bool = True) -> Column:
    """The current name of a review reason; unchanged unless images can hold several instances."""
    if not multi_instance:
        return reason
    r = F.lower(reason)
    has = lambda *words: r.rlike("|".join(words))
    return (
        F.when(r.isin(*LEGACY_REASONS), F.lit(POSSIBLE_MISSING))
        .when(has("occlusion"), F.lit(AMBIGUOUS))
        .when(has("crowd", "dense", "multiple", "multi_object"), F.lit(CROWDED))
        .when(has("single") & has("object"), F.lit(POSSIBLE_MISSING))
        .otherwise(reason)
    )


@dataclass(frozen=True)
class Policy:
    """Mapping policy: labels to map, to ignore and to review; what happens to all others."""

    targets: tuple[str, ...]
    mapping: dict[str, str]
    ignore: tuple[str, ...] = ()
    review: tuple[str, ...] = ()
    unknown: str = "review"
    trim: bool = True
    lowercase: bool = True

    def __post_init__(self):
        if self.unknown not in ("ignore", "review"):
            raise ValueError(f"unknown labels can be ignored or reviewed, not {self.unknown!r}")

    def normalized(self, label: Column) -> Column:
        """A label as the policy's lists name it."""
        name = F.regexp_replace(label, r"^\s+|\s+$", "") if self.trim else label
        return F.lower(name) if self.lowercase else name

    def apply(self, label: Column) -> Column:
        """struct(action, target): map before ignore before review before unknown; a target outside the list is reviewed."""
        name = self.normalized(label)
        target = lookup(name, self.mapping)
        known = target.isin(*self.targets)
        action = (
            F.when(target.isNotNull() & known, F.lit("map"))
            .when(target.isNotNull(), F.lit("review"))
            .when(name.isin(*self.ignore), F.lit("ignore"))
            .when(name.isin(*self.review), F.lit("review"))
            .otherwise(self.unknown)
        )
        return F.struct(action.alias("action"), F.when(known, target).alias("target"))
