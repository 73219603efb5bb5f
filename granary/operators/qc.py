"""Quality rules. Each returns findings (rule, severity, split, subject, observed, threshold); they are united as they are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import boxes, numbers
from granary.functions.labels import CROWDED, POSSIBLE_MISSING

COLUMNS = ("rule", "severity", "split", "subject", "observed", "threshold")


class QualityError(ValueError):
    """There are findings of severity error."""


def findings(rows: DataFrame, rule: str, severity: str, split: Column | None = None, subject: Column | None = None, observed: Column | None = None, threshold: float | None = None) -> DataFrame:
    """rows as findings; none if the severity is off."""
    out = rows.select(
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (split if split is not None else F.lit(None)).cast("string").alias("split"),
        (subject if subject is not None else F.lit(None)).cast("string").alias("subject"),
        (observed if observed is not None else F.lit(None)).cast("double").alias("observed"), F.lit(threshold).cast("double").alias("threshold"),
    )
    return out.where(F.lit(severity != "off"))


def united(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def fail_on_errors(found: DataFrame) -> None:
    """Raise for findings of severity error, naming the first five."""
    worst = found.where("severity = 'error'").select("rule", "split", "subject").limit(5).collect()
    if worst:
        raise QualityError("; ".join(f"{r['rule']} ({r['split']}, {r['subject']})" for r in worst))


def missing_splits(files: DataFrame, expected: tuple[str, ...], severity: str = "error") -> DataFrame:
    wanted = files.sparkSession.createDataFrame([(s,) for s in expected], "split string")
    return findings(wanted.join(files.select("split").distinct(), "split", "left_anti"), "missing_split", severity, F.col("split"))


def bad_lines(lines: DataFrame, classes: int) -> DataFrame:
    """lines (split, path, line): malformed ones (warning) and class ids out of range (error)."""
    class_id = numbers.strict_class(F.get(boxes.tokens(F.col("line")), F.lit(0)))
    rows = lines.withColumns({"malformed": (F.size(boxes.tokens(F.col("line"))) != 5) | class_id.isNull(), "class_id": class_id})
    outside = rows.where(~F.col("malformed") & ((F.col("class_id") < 0) | (F.col("class_id") >= classes)))
    return united(
        findings(rows.where("malformed"), "malformed_line", "warn", F.col("split"), F.col("path")),
        findings(outside, "class_out_of_range", "error", F.col("split"), F.col("path"), F.col("class_id"), classes - 1),
    )


def queue(files: DataFrame, crowded: int = 5, policy: str = "warn") -> DataFrame:
    """files (split, path, boxes or null) that people should look at, with the reason. policy off: none."""
    reason = F.when(F.col("boxes").isNull() | (F.col("boxes") == 0), F.lit(POSSIBLE_MISSING)).when(F.col("boxes") >= crowded, F.lit(CROWDED))
    return files.withColumn("reason", reason).where(F.col("reason").isNotNull() & F.lit(policy != "off"))


def absent_classes(present: DataFrame, expected: DataFrame, severity: str = "warn") -> DataFrame:
    """expected (split, class) of which present (split, class) has none."""
    lacking = expected.join(present.select("split", "class").distinct(), ["split", "class"], "left_anti")
    return findings(lacking, "missing_class", severity, F.col("split"), F.col("class"))


def box_ratios(files: DataFrame, group: list[str]) -> DataFrame:
    """(group, files, labelled, empty, multi, multi_ratio, empty_ratio). files: group, boxes (0: an empty label)."""
    out = files.groupBy(*group).agg(
        F.count("*").alias("files"), F.count_if(F.col("boxes") > 0).alias("labelled"), F.count_if(F.col("boxes") == 0).alias("empty"), F.count_if(F.col("boxes") > 1).alias("multi")
    )
    return out.withColumns({"multi_ratio": numbers.ratio(F.col("multi"), F.col("labelled")), "empty_ratio": numbers.ratio(F.col("empty"), F.col("files"))})


def low_multi_ratio(ratios: DataFrame, least: float = 0.01, files: int = 100, severity: str = "warn") -> DataFrame:
    bad = ratios.where((F.col("files") >= files) & (F.col("multi_ratio") < least))
    return findings(bad, "low_multi_box_ratio", severity, F.col("split"), None, F.col("multi_ratio"), least)


def high_empty_ratio(ratios: DataFrame, most: float = 0.40, files: int = 100, severity: str = "warn") -> DataFrame:
    bad = ratios.where((F.col("files") >= files) & (F.col("empty_ratio") > most))
    return findings(bad, "high_empty_ratio", severity, F.col("split"), None, F.col("empty_ratio"), most)


def source_drops(by_source: DataFrame, by_split: DataFrame, factor: float = 0.35, files: int = 30) -> DataFrame:
    """Sources (split, source, files, multi) whose share of images with several boxes is far below their split's.

    A split's share is of its labelled images, if by_split counts them, and else of all.
    """
    whole = by_split.select("split", numbers.ratio(F.col("multi"), F.col("labelled" if "labelled" in by_split.columns else "files")).alias("split_ratio"))
    own = by_source.withColumn("own_ratio", numbers.ratio(F.col("multi"), F.col("files"))).join(whole, "split")
    bad = own.where((F.col("files") >= files) & (F.col("split_ratio") > 0) & (F.col("own_ratio") < F.col("split_ratio") * factor))
    return bad.select("split", "source", "files", "own_ratio", "split_ratio")


def required_classes(present: DataFrame, required: dict[str, tuple[str, ...]], classes: tuple[str, ...]) -> DataFrame:
    """Errors for classes that a split has to have: names that no class has, and classes without a row in present (split, class)."""
    spark = present.sparkSession
    wanted = spark.createDataFrame([(s, c, c in classes) for s, names in required.items() for c in names], "split string, class string, known boolean")
    return united(
        findings(wanted.where("not known"), "required_class_unknown", "error", F.col("split"), F.col("class")),
        absent_classes(present, wanted.where("known").select("split", "class"), "error").withColumn("rule", F.lit("required_class_missing")),
    )


def negative_share(rows: DataFrame, negative: str, target: float, tolerance: float) -> DataFrame:
    """(split, share, target, tolerance): the share of negatives of each split, beside what was asked for, which nothing enforces."""
    return rows.groupBy("split").agg(numbers.ratio(F.count_if(F.col(negative)), F.count("*")).alias("share")).withColumns(
        {"target": F.lit(float(target)), "tolerance": F.lit(float(tolerance))}
    )
