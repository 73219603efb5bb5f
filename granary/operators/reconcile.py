"""Which of two listings lacks what, and incremental merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import paths
from granary.operators.ranks import dealt, numbered


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The keys of left that right lacks."""
    return dealt(left.select(key), key).distinct().join(dealt(right.select(key), key), key, "left_anti")


def sides(images: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """(key, side): images_without_labels and labels_without_images."""
    one = missing(images, labels, key).withColumn("side", F.lit("images_without_labels"))
    return one.union(missing(labels, images, key).withColumn("side", F.lit("labels_without_images")))


def manifest_audit(expected: DataFrame, images: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """(key, finding): missing and unexpected contents among images and labels."""
    found = []
    for name, have in (("images", images), ("labels", labels)):
        found.append(missing(expected, have, key).withColumn("finding", F.lit(f"missing_{name}")))
        found.append(missing(have, expected, key).withColumn("finding", F.lit(f"unexpected_{name}")))
    return reduce(DataFrame.union, found)


def content_audit(base: DataFrame, output: DataFrame, key: str, content: str) -> DataFrame:
    """(key, finding): what of base the output lacks, or holds with another content."""
    other = output.select(key, F.col(content).alias("__other"), F.lit(True).alias("__there"))
    joined = base.select(key, content).join(other, key, "left")
    finding = F.when(F.col("__there").isNull(), F.lit("missing")).when(~F.col(content).eqNullSafe(F.col("__other")), F.lit("different"))
    return joined.select(key, finding.alias("finding")).where("finding is not null")


def attached(images: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """images with their label's columns, and ``has_label``."""
    return images.join(labels.withColumn("has_label", F.lit(True)), key, "left").withColumn("has_label", F.coalesce("has_label", F.lit(False)))


def new_rows(candidates: DataFrame, base: DataFrame, key: str) -> DataFrame:
    return candidates.join(base.select(key).distinct(), key, "left_anti")


def merged(base: DataFrame, incoming: DataFrame, content: str, order: list[Column]) -> DataFrame:
    """base and what of incoming it lacks by content; of equal incoming rows the first by order (which ends in something unique)."""
    fresh = new_rows(incoming, base, content)
    whole = F.struct(*[F.col(c) for c in fresh.columns])
    once = fresh.groupBy(content).agg(F.min_by(whole, F.struct(*order)).alias("x")).select("x.*")
    return base.withColumn("origin", F.lit("base")).unionByName(once.withColumn("origin", F.lit("incremental")))


def numbered_on(new: DataFrame, existing: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """new with ``index``, going on from each group's largest one in existing (group, index)."""
    last = existing.groupBy(*group).agg(F.max("index").alias("__last"))
    new = numbered(new, group, order, "__n").withColumn("__n", F.col("__n").cast("int"))
    return new.join(last, group, "left").withColumn("index", F.col("__n") + F.coalesce("__last", F.lit(0))).drop("__n", "__last")


def unique_names(rows: DataFrame, name: str, order: list[Column], taken: DataFrame | None = None) -> DataFrame:
    """rows with ``unique_name``, as if they were written one by one in that order: a name that is in use gets __2 before
    its ending, and if that is in use too __3, and so on. taken: names that are in use from the start.

    Whether ``a__2`` is in use when ``a`` comes again depends on whether a row of that very name came before, and the
    other way round, so names are settled from the plainest on: those without a number, those with one, with two, ...
    All that a name needs to know of a numbered one is how many of its own rows come before that one's first.
    """
    stem, ending = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    with_number = r"^(?s)(.+)__([1-9][0-9]{0,8})$"
    rows = rows.withColumns({"__stem": stem, "__ending": ending, "__order": F.struct(*order)})
    rows = numbered(rows, [name], [F.col("__order")], "__rank").withColumn("__rank", F.col("__rank").cast("int"))
    known = rows.groupBy(F.col(name).alias("__name"), "__stem", "__ending").agg(F.min("__order").alias("first"), F.count("*").alias("n"))
    used = known.select("__name").limit(0) if taken is None else taken.select(F.col(name).alias("__name")).where(F.col("__name").isNotNull()).distinct()
    used = used.select("__name", F.regexp_extract("__name", r"^(.*?)(\.[^.]*)?$", 1).alias("__s"), F.regexp_extract("__name", r"^(.*?)(\.[^.]*)?$", 2).alias("__e"), F.lit(True).alias("used"))
    names = known.join(used, "__name", "full").select("__name", F.coalesce("__stem", "__s").alias("stem"), F.coalesce("__ending", "__e").alias("ending"), "first", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("used", F.lit(False)).alias("used"))
    number = F.regexp_extract("stem", with_number, 2)
    names = names.withColumns({"base": F.concat(F.regexp_extract("stem", with_number, 1), "ending"), "k": F.when(number != "", number.cast("int"))})
    # Of the rows of a base, how many come before the first of a numbered name (none, if that is in use from the start).
    claims = names.where("k >= 2").select(F.col("base").alias("__name"), "k", "used", "first", F.col("__name").alias("claim"))
    before = rows.select(F.col(name).alias("__name"), "__order").join(claims, "__name").where(~F.col("used") & (F.col("__order") < F.col("first")))
    before = before.groupBy("claim").agg(F.count("*").alias("before"))
    claims = claims.join(before, "claim", "left").select("__name", F.struct("k", F.coalesce("before", F.lit(0)).alias("before"), "used", "claim").alias("x"))
    claims = claims.groupBy("__name").agg(F.array_sort(F.collect_list("x")).alias("claims"))
    names = names.join(claims, "__name", "left").withColumn("depth", F.size(F.split(F.regexp_extract("stem", r"((?:__[1-9][0-9]{0,8})*)$", 1), "__")) - 1)
    names = names.select("__name", "n", "used", "depth", F.coalesce("claims", F.array().cast(names.join(claims, "__name").schema["claims"].dataType)).alias("claims"))
    settled, lost = None, None
    for depth in range((names.agg(F.max("depth")).first()[0] or 0) + 1):
        own = names.where(F.col("depth") == depth)
        own = own.withColumn("shift", F.col("used").cast("int")) if lost is None else own.join(lost, "__name", "left").withColumn("shift", (F.col("used") | F.coalesce("gone", F.lit(False))).cast("int")).drop("gone")
        # Numbers that stay with rows of their own name are passed over; the others are taken before their row comes.
        start = F.struct(F.array().cast("array<int>").alias("passed"), F.array().cast("array<string>").alias("taken"))

        def step(a: Column, x: Column) -> Column:
            place = x["k"] - F.size(a["passed"]) - F.col("shift")  # the row that would get this number, counted from 1
            stays = x["used"] | (x["before"] < place)
            return F.struct(
                F.when(stays, F.concat(a["passed"], F.array(x["k"]))).otherwise(a["passed"]).alias("passed"),
                F.when(~stays & (place <= F.col("n")), F.concat(a["taken"], F.array(x["claim"]))).otherwise(a["taken"]).alias("taken"),
            )

        own = own.withColumn("x", F.aggregate("claims", start, step)).select("__name", "shift", F.col("x.passed").alias("passed"), F.col("x.taken").alias("taken"))
        gone = own.select(F.explode("taken").alias("__name"), F.lit(True).alias("gone"))
        lost = gone if lost is None else lost.unionByName(gone)
        settled = own if settled is None else settled.unionByName(own)
    out = rows.join(settled.select(F.col("__name").alias(name), "shift", "passed"), name)
    place = F.aggregate("passed", F.col("__rank") + F.col("shift"), lambda at, k: F.when(at >= k, at + 1).otherwise(at))
    made = F.when(place == 1, F.col(name)).otherwise(F.concat("__stem", F.lit("__"), place.cast("string"), "__ending"))
    return out.withColumn("unique_name", made).drop("__stem", "__ending", "__order", "__rank", "shift", "passed")


def orphans(pairs: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of pairs that a manifest doesn't list: by image and label together, or by label alone."""
    return pairs.join(manifest.select(*keys).distinct(), keys, "left_anti")


def assert_relative(rows: DataFrame, fields: list[str], order: list[Column | str]) -> None:
    """Raise, with the first five of them in that order, if any of these fields holds an absolute path. Empty and null ones are fine."""
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("field"), F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))).alias("path")) for i, f in enumerate(fields)])
    bad = rows.select(F.struct(*order).alias("at"), F.inline(entries)).where(F.col("path").startswith("/"))
    first = bad.orderBy("at", "i").select("field", "path").limit(5).collect()
    if first:
        raise ValueError(f"paths must be relative: {', '.join(f'{r.field}={r.path}' for r in first)}")


def existing(rows: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """The rows whose file a listing (path) has: relative paths of images only."""
    good = paths.is_relative(F.trim(path)) & paths.is_image(F.trim(path))
    return rows.where(good).join(files.select(F.col("path").alias("__file")).distinct(), F.trim(path) == F.col("__file"), "left_semi")
