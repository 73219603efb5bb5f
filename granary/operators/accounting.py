"""Counts by class, source and split, and how they compare with targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import numbers


def counted(rows: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def joined_key(*keys: str, by: str = "::") -> Column:
    return F.concat_ws(by, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def rare(rows: DataFrame, key: str, least: int) -> DataFrame:
    """(key, n) of those with fewer rows than asked for."""
    return counted(rows, key).where(F.col("n") < least)


def repeated(rows: DataFrame, key: str) -> DataFrame:
    return counted(rows, key).where("n > 1")


def histogram(rows: DataFrame, group: list[str], each: str) -> DataFrame:
    """(group, size, n): how many of ``each`` have so many rows."""
    return rows.groupBy(*group, each).agg(F.count("*").alias("size")).groupBy(*group, "size").agg(F.count("*").alias("n"))


def inventory(rows: DataFrame, label: str) -> DataFrame:
    """(label, raw, unique, duplicates, unused, planned) in one pass. rows: label, md5, duplicate_rank, status."""
    planned = F.col("status").contains("planned") | F.col("status").contains("staged")
    return rows.groupBy(label).agg(
        F.count("*").alias("raw_count"), F.count_distinct("md5").alias("unique_count"), F.count_if(F.col("duplicate_rank") > 1).alias("duplicate_count"),
        F.count_if((F.col("duplicate_rank") == 1) & ~planned).alias("unused_count"), F.count_if(planned).alias("planned_count"),
    )


def union_counts(one: DataFrame, other: DataFrame, label: str, content: str) -> DataFrame:
    """(label, total_unique): contents of either table, each once."""
    return one.select(label, content).unionByName(other.select(label, content)).groupBy(label).agg(F.count_distinct(content).alias("total_unique"))


def class_accounting(taxonomy: DataFrame, unlabelled: DataFrame, labelled: DataFrame, targets: DataFrame) -> DataFrame:
    """A row for each class that any of four tables knows.

    taxonomy: (class). unlabelled: (class, available, unused). labelled: (class, labelled, train, valid, test).
    targets: (class, target, batch_size), as text. Counts of tables without the class are 0; the gap to a target that
    isn't a number is null.
    """
    classes = taxonomy.select("class")
    for t in (unlabelled, labelled, targets):
        classes = classes.union(t.select("class"))
    out = classes.distinct()
    for t in (unlabelled, labelled, targets):
        out = out.join(t, "class", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("available", "unused", "labelled", "train", "valid", "test")}
    out = out.withColumns(zero)
    target = F.when(F.col("target").rlike(r"^\s*[0-9]{1,18}\s*$"), F.trim("target").try_cast("long"))
    return out.withColumns(
        {"suggested_target": F.col("labelled") + F.col("unused"), "gap_to_target": F.when(target.isNotNull(), F.greatest(F.lit(0).cast("long"), target - F.col("labelled")))}
    )


def with_ratio(rows: DataFrame, name: str, part: str, whole: str) -> DataFrame:
    return rows.withColumn(name, numbers.ratio(F.col(part), F.col(whole)))


def breakdown(rows: DataFrame, group: str, key: str) -> DataFrame:
    """(group, breakdown): a JSON object of sorted counts."""
    counts = rows.groupBy(group, key).agg(F.count("*").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("n").alias("v"))))
    return counts.where(F.col(key).isNotNull()).groupBy(group).agg(F.to_json(F.map_from_entries(entries)).alias("breakdown"))


def by_split_and_total(files: DataFrame) -> DataFrame:
    """files (split, boxes) counted for each split and, with a null split, for all."""
    files.createOrReplaceTempView("__files")
    return files.sparkSession.sql(
        "select split, count(*) as files, count_if(boxes = 0) as empty_files, count_if(boxes > 1) as multi_box_files, sum(boxes) as boxes "
        "from __files group by grouping sets ((split), ())"
    )


def with_total(rows: DataFrame, key: str, name: str = "total") -> DataFrame:
    """rows and, last, one with the sums of their numbers; other columns of it are null."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    sums = [F.sum(c).cast(t).alias(c) if t in numeric else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c != key]
    return rows.unionByName(rows.agg(*sums).withColumn(key, F.lit(name)))
