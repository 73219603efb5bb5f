"""Human review: priorities, batches and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prioritised(queue: DataFrame, batch_size: int = 60) -> DataFrame:
    """queue (source, reason, group_id, size, pixels, path) with ``priority_score``, ``rank``, ``batch`` and ``batch_rank``.

    Large groups, rare sources, common reasons, then large files come first. The order is that of the rounded score.
    Counts are aggregates that are joined back, so that a common group isn't one task's.
    """
    for key, name in (("source", "by_source"), ("reason", "by_reason"), ("group_id", "by_group")):
        counts = queue.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias(name))
        most = counts.agg(F.max(name).alias(f"most_{name}"))
        queue = queue.join(counts, F.col(key).eqNullSafe(F.col("__k"))).drop("__k").crossJoin(F.broadcast(most))
    log = lambda c: F.log10(F.greatest(F.col(c).cast("double"), F.lit(1.0)) + 1)
    score = (
        F.lit(60.0) * (F.col("by_group") / F.col("most_by_group")) + F.lit(20.0) * (F.col("most_by_source") / F.col("by_source"))
        + F.lit(10.0) * (F.col("by_reason") / F.col("most_by_reason")) + F.lit(5.0) * (log("size") / 5.0) + F.lit(5.0) * (log("pixels") / 6.0)
    )
    queue = queue.withColumn("priority_score", F.round(score, 4)).drop("most_by_source", "most_by_reason", "most_by_group")
    # Scores of four decimals up to about a hundred are a million values at most: those are ordered in one task, rows
    # only among those of their score.
    scores = queue.groupBy(F.col("priority_score").alias("__score")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(F.desc("__score"))) - F.col("__n")
    queue = queue.join(scores.select("__score", before.alias("__before")), F.col("priority_score").eqNullSafe(F.col("__score")))
    order = Window.partitionBy("priority_score").orderBy(F.desc("by_group"), "source", "path")
    queue = queue.withColumn("rank", (F.row_number().over(order) + F.col("__before")).cast("int")).drop("__score", "__before")
    return queue.withColumns(
        {"batch": F.floor((F.col("rank") - 1) / batch_size).cast("int") + 1, "batch_rank": (F.col("rank") - 1) % batch_size + 1}
    )


def last_of(rows: DataFrame, key: str, sequence: str) -> DataFrame:
    """The last row of each key that isn't blank, by a sequence column."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "").groupBy(key).agg(F.max_by(whole, F.col(sequence)).alias("x")).select("x.*")


def overridden(queue: DataFrame, decisions: DataFrame, key: str, columns: list[str], sequence: str) -> DataFrame:
    """queue with the columns of its last decision, an empty text included; rows without a decision stay as they are."""
    last = last_of(decisions, key, sequence).select(F.col(key).alias("__key"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = queue.join(last, F.col(key) == F.col("__key"), "left")
    out = joined.withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns})
    return out.drop("__key", "__hit", *[f"__{c}" for c in columns])


def reviewed(rows: DataFrame, decisions: DataFrame, key: str, taxonomy: tuple[str, ...], negatives: tuple[str, ...] = ("negative",)) -> DataFrame:
    """rows (mapped, is_negative, status, reason) after decisions (key, decision, sequence) on those not yet approved."""
    last = last_of(decisions, key, "sequence").select(F.col(key).alias("__key"), F.col("decision").alias("__decision"))
    joined = rows.join(last, F.col(key) == F.col("__key"), "left")
    hit = (F.col("status") != "approved") & F.col("__decision").isNotNull()
    inside, negative = F.col("__decision").isin(*taxonomy), F.col("__decision").isin(*negatives)
    decided: dict[str, Column] = {
        "mapped": F.when(hit & inside & ~negative, F.col("__decision")).when(hit, F.lit("negative")).otherwise(F.col("mapped")),
        "is_negative": F.when(hit, ~inside | negative).otherwise(F.col("is_negative")),
        "reason": F.when(hit & (inside | negative), F.lit("manual_review")).when(hit, F.lit("manual_review_out_of_taxonomy")).otherwise(F.col("reason")),
        "status": F.when(hit, F.lit("approved")).otherwise(F.col("status")),
        "applied": hit,
    }
    return joined.withColumns(decided).drop("__key", "__decision")
