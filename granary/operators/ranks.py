"""Row numbers inside groups of any size and in any order, and rows dealt by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.lineage import cut


def numbered(rows: DataFrame, groups: list[str], order: list[Column | str], out: str) -> DataFrame:
    """rows with their number (``out``, from 1, long) in their group, in that order, which should end in something unique.

    A window over a group would sort it in one task. Here all rows are dealt out by ranges of group and order, so that a
    large group covers many ranges; rows are numbered inside of their range, and ranges by the counts of those before
    them. The ranges are written down in between, as both steps have to see the same ones. Null groups are one group.
    """
    keys = [F.asc(g) for g in groups]
    sorting = [o if isinstance(o, Column) else F.col(o) for o in order]
    dealt = cut(rows.repartitionByRange(*keys, *sorting).withColumn("__range", F.spark_partition_id()))
    inside = [*groups, "__range"]
    counts = dealt.groupBy(*inside).agg(F.count("*").alias("__c"))
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(inside)], F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__before"))
    own = dealt.withColumn("__in", F.row_number().over(Window.partitionBy(*inside).orderBy(*sorting)))
    same = F.lit(True)
    for i, k in enumerate(inside):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return own.join(starts, same).withColumn(out, F.col("__before") + F.col("__in")).drop("__range", "__in", "__before", *[f"__k{i}" for i in range(len(inside))])


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """rows by their key, in all of the session's shuffle partitions.

    Keys alone compress so well that Spark, which goes by compressed bytes, would put many partitions into one task,
    which then sorts and holds all of their rows.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
