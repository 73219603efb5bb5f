"""Splits, quotas and capped samples. Randomness is the order of a seeded hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RATIOS = (("train", 0.7), ("valid", 0.2), ("test", 0.1))


def seeded(seed: int, *ids: str) -> list[Column]:
    return [F.sha1(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]).cast("binary")), *[F.col(i) for i in ids]]


def placed(rows: DataFrame, groups: list[str], seed: int, id_column: str) -> DataFrame:
    """rows with ``place`` (from 1) in their group's random order, and ``n``, the group's size.

    Rows are numbered inside ranges of the hash, 4096 a group, and ranges by their counts: no task sorts a whole group.
    """
    rows = rows.withColumn("__h", seeded(seed, id_column)[0]).withColumn("__range", F.substr("__h", F.lit(1), F.lit(3)))
    keys = [*groups, "__range"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("c").over(w.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], before.alias("__before"), F.sum("c").over(w).alias("n"))
    inner = rows.withColumn("__in", F.row_number().over(Window.partitionBy(*keys).orderBy("__h", id_column)))
    same = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    out = inner.join(starts, same).withColumn("place", F.col("__in") + F.col("__before"))
    return out.drop("__h", "__range", "__in", "__before", *[f"__{i}" for i in range(len(keys))])


def apportioned(n: Column, ratios=RATIOS) -> list[Column]:
    """How many of n go to each split: the whole part of its share, and what is left by the largest remainders.

    Shares are binary fractions; of equal remainders the earlier split comes first.
    """
    shares = [n.cast("double") * F.lit(r) for _, r in ratios]
    whole = [F.floor(s).cast("long") for s in shares]
    rest = [s - w.cast("double") for s, w in zip(shares, whole, strict=True)]
    left = n.cast("long")
    for w in whole:
        left = left - w
    out = []
    for i, w in enumerate(whole):
        ahead = F.lit(0)
        for j in range(len(whole)):
            if j != i:
                ahead = ahead + F.when(rest[j] >= rest[i] if j < i else rest[j] > rest[i], 1).otherwise(0)
        out.append(w + F.when(ahead < left, 1).otherwise(0))
    return out


def assigned(rows: DataFrame, stratum: str, id_column: str, seed: int, ratios=RATIOS) -> DataFrame:
    """rows with ``split``: each stratum in random order, cut by its apportionment."""
    numbered = placed(rows, [stratum], seed, id_column)
    counts, upto, split = apportioned(F.col("n"), ratios), F.lit(0), F.lit(ratios[-1][0])
    cuts = []
    for c in counts:
        upto = upto + c
        cuts.append(upto)
    for (name, _), at in reversed(list(zip(ratios[:-1], cuts[:-1], strict=True))):
        split = F.when(F.col("place") <= at, F.lit(name)).otherwise(split)
    return numbered.withColumn("split", split).drop("place", "n")


def negative_quota(positives: Column, target: float) -> Column:
    """Negatives for so many positives, so that they are the target share; halves go to the even number."""
    return F.bround(positives.cast("double") * F.lit(target) / F.lit(1 - target)).cast("long")


def with_negatives(rows: DataFrame, id_column: str, negative: str, seed: int, target: float, ratios=RATIOS) -> DataFrame:
    """Negatives for rows that have a split (positives): split after split gets its quota while there are some left."""
    wanted = rows.where(~F.col(negative)).groupBy("split").agg(F.count("*").alias("n"))
    order = F.lit(len(ratios))
    for i, (name, _) in reversed(list(enumerate(ratios))):
        order = F.when(F.col("split") == name, F.lit(i)).otherwise(order)
    wanted = wanted.withColumns({"quota": negative_quota(F.col("n"), target), "at": order})
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = wanted.withColumn("high", F.sum("quota").over(upto)).select("split", (F.col("high") - F.col("quota")).alias("low"), "high")
    pool = placed(rows.where(F.col(negative)).drop("split"), [], seed, id_column)
    # A row a split on the right.
    return pool.join(F.broadcast(wanted), (F.col("place") > F.col("low")) & (F.col("place") <= F.col("high"))).drop("place", "n", "low", "high")


def rebalance_cap(counts: DataFrame, label: str, target: str, factor: float) -> DataFrame:
    """(cap): what a class is cut to, factor times the next largest one, at least 1. counts: (label, n)."""
    return counts.where(F.col(label) != target).agg(F.greatest(F.lit(1), F.floor(F.coalesce(F.max("n"), F.lit(0)) * F.lit(factor))).cast("long").alias("cap"))


def rebalanced(rows: DataFrame, label: str, id_column: str, target: str, factor: float, seed: int) -> DataFrame:
    """rows, with a random ``cap`` of those of the target class."""
    cap = rebalance_cap(rows.groupBy(label).agg(F.count("*").alias("n")), label, target, factor)
    own = placed(rows.where(F.col(label) == target), [label], seed, id_column)
    kept = own.join(F.broadcast(cap), F.col("place") <= F.col("cap")).drop("place", "n", "cap")  # one row on the right
    return rows.where(F.col(label) != target).unionByName(kept)


def first_n(rows: DataFrame, group: list[str], order: list[Column], limits: DataFrame, limit: str, default: int = 0) -> DataFrame:
    """The first rows of each group, as many as its limit says. limits: group columns and the limit, a row a group."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    joined = rows.withColumn("place", place).join(limits, group, "left")
    return joined.where(F.col("place") <= F.coalesce(F.col(limit), F.lit(default))).drop(limit)


def shortfalls(rows: DataFrame, group: list[str], limits: DataFrame, limit: str) -> DataFrame:
    """(group, available, limit): groups that have fewer rows than their limit."""
    have = rows.groupBy(*group).agg(F.count("*").alias("available"))
    return limits.join(have, group, "left").withColumn("available", F.coalesce("available", F.lit(0))).where(F.col("available") < F.col(limit))
