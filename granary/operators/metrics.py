"""Metrics of training runs and of classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import numbers


def best_and_latest(runs: DataFrame, metric: str) -> DataFrame:
    """(run, best_epoch, best, latest_epoch, latest): the first epoch with the largest metric, and the last epoch."""
    return runs.groupBy("run").agg(
        F.max_by("epoch", F.struct(F.col(metric), -F.col("epoch"))).alias("best_epoch"), F.max(metric).alias("best"),
        F.max("epoch").alias("latest_epoch"), F.max_by(metric, "epoch").alias("latest"),
    )


def latest_epochs(runs: DataFrame, size: int, anchor: str = "each", last_run: str | None = None) -> DataFrame:
    """The last ``size`` epochs of runs: up to each run's own last epoch, the smallest of these, or that of one run."""
    ends = runs.groupBy("run").agg(F.max("epoch").alias("end"))
    if anchor == "each":
        out = runs.join(ends, "run")
    elif anchor == "shared":
        out = runs.crossJoin(F.broadcast(ends.where("end > 0").agg(F.min("end").alias("end"))))
    elif anchor == "last_run":
        out = runs.crossJoin(F.broadcast(ends.where(F.col("run") == last_run).select("end")))
    else:
        raise ValueError(f"no such anchor: {anchor}")
    return out.where((F.col("epoch") >= F.greatest(F.lit(0), F.col("end") - size + 1)) & (F.col("epoch") <= F.col("end"))).drop("end")


def against(one: DataFrame, other: DataFrame, metric: str) -> DataFrame:
    """(epoch, one, other, delta) of the epochs that both runs have."""
    joined = one.select("epoch", F.col(metric).alias("one")).join(other.select("epoch", F.col(metric).alias("other")), "epoch")
    return joined.withColumn("delta", F.col("other") - F.col("one"))


def step_changes(runs: DataFrame, metric: str) -> DataFrame:
    """runs with ``delta``, the change since the run's epoch before."""
    return runs.withColumn("delta", F.col(metric) - F.lag(metric).over(Window.partitionBy("run").orderBy("epoch")))


def confusion(rows: DataFrame) -> DataFrame:
    """(truth, predicted, n)."""
    return rows.groupBy("truth", "predicted").agg(F.count("*").alias("n"))


def top_confusions(rows: DataFrame, k: int = 12) -> DataFrame:
    return confusion(rows).where("truth <> predicted and n > 0").orderBy(F.desc("n"), "truth", "predicted").limit(k)


def class_report(rows: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) of rows (truth, predicted); 0 where nothing can be divided."""
    cells = confusion(rows)
    classes = cells.select(F.col("truth").alias("class")).union(cells.select("predicted")).distinct()
    hit = cells.where("truth = predicted").select(F.col("truth").alias("class"), F.col("n").alias("hit"))
    own = cells.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"))
    said = cells.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("said"))
    out = classes.join(hit, "class", "left").join(own, "class", "left").join(said, "class", "left").fillna(0)
    out = out.withColumns({"precision": numbers.ratio(F.col("hit"), F.col("said")), "recall": numbers.ratio(F.col("hit"), F.col("support"))})
    f1 = numbers.ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.select("class", "precision", "recall", f1.alias("f1"), "support")


def overall(rows: DataFrame) -> DataFrame:
    """(accuracy, macro_f1, weighted_f1, support) in one row."""
    report = class_report(rows)
    accuracy = rows.agg(numbers.ratio(F.count_if(F.col("truth") == F.col("predicted")), F.count("*")).alias("accuracy"))
    means = report.agg(F.avg("f1").alias("macro_f1"), numbers.ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"), F.sum("support").alias("support"))
    return accuracy.crossJoin(means)  # one row each


def per_class(names: list[str], **metrics: list[float]) -> list[tuple]:
    """(class_id, name, metrics...) zipped by position; None where a list is short."""
    return [(i, n, *(m[i] if i < len(m) else None for m in metrics.values())) for i, n in enumerate(names)]
