"""Validation of batches, round trips and frozen datasets, and label files that are rewritten.

Findings are rows as in ``qc``; counts go into ``observed``. Listings: images (path, stem), labels (path, stem, lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import boxes, numbers, paths
from granary.operators import reconcile
from granary.operators.boxes import meeting
from granary.operators.qc import findings, united

MANIFEST_PATHS = ("source_path", "source_manifest", "output_image", "output_label")


def counted_finding(rows: DataFrame, rule: str, severity: str = "error", least: int = 1) -> DataFrame:
    """One finding with the number of rows, if there are ``least`` or more."""
    return findings(rows.agg(F.count("*").alias("n")).where(F.col("n") >= least), rule, severity, observed=F.col("n"))


def _unequal(rows: DataFrame, rule: str, expected: int) -> DataFrame:
    return findings(rows.agg(F.count("*").alias("n")).where(F.col("n") != expected), rule, "error", observed=F.col("n"), threshold=float(expected))


def _stems(images: DataFrame, labels: DataFrame, key: str = "stem") -> DataFrame:
    sides = reconcile.sides(images, labels, key)
    return united(*(counted_finding(sides.where(F.col("side") == s), s) for s in ("images_without_labels", "labels_without_images")))


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def batch_findings(
    images: DataFrame, labels: DataFrame, copies: DataFrame, expected: int, canonical_class: str, excluded: tuple[str, ...] = (), line: str = boxes.SEED_BOX, collapse: bool = False
) -> DataFrame:
    """What is wrong with a batch of one class. copies: (md5 and the columns of ``MANIFEST_PATHS``), a row a copied image.

    collapse: several sources of one content are one image, which is worth a warning; else it is an error, and there
    have to be as many labels as expected.
    """
    spark = images.sparkSession
    is_excluded = spark.createDataFrame([(canonical_class,)], "c string").where(F.lit(canonical_class in excluded))
    label_count = labels.agg(F.count("*").alias("n"))
    if collapse:
        stems = images.agg(F.count_distinct("stem").alias("stems"))
        label_count = findings(label_count.crossJoin(stems).where("n <> stems"), "label_count", "error", observed=F.col("n"))  # one row each
    else:
        label_count = _unequal(labels, "label_count", expected)
    repeated = counted_finding(_repeated(copies, "md5"), "duplicate_source_md5s_collapsed_in_output" if collapse else "duplicate_md5s", "warn" if collapse else "error")
    other_lines = findings(labels.where(~F.col("lines").eqNullSafe(F.array(F.lit(line)))), "unexpected_label", "error", subject=F.col("path"))
    entries = copies.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("path")) for c in MANIFEST_PATHS])).alias("x")).select("x.*")
    absolute = findings(entries.where(~paths.is_relative(F.col("path"))), "non_relative_manifest_path", "error", subject=F.concat_ws(":", "field", "path"))
    return united(
        findings(is_excluded, "excluded_class", "error", subject=F.col("c")), _unequal(images, "image_count", expected), label_count, _stems(images, labels), repeated, other_lines, absolute
    )


def _lines(labels: DataFrame) -> DataFrame:
    return labels.select("path", F.posexplode("lines").alias("at", "line"))


def _read(line: Column) -> dict[str, Column]:
    """The numbers of a line of five, whatever their range; class ids may be written as decimals."""
    t = boxes.tokens(line)
    values = {c: numbers.to_number(F.get(t, F.lit(i + 1))) for i, c in enumerate(("xc", "yc", "w", "h"))}
    return {"five": F.size(t) == 5, "class_id": numbers.truncated_class(F.get(t, F.lit(0))), **values}


def _outside(x: Column) -> Column:
    """Whether a number lies outside [0, 1]. What isn't a number lies nowhere."""
    return ~F.isnan(x) & ((x < 0) | (x > 1))


def roundtrip(images: DataFrame, labels: DataFrame, manifest: DataFrame, rows_shown: int = 50, overlaps_shown: int = 100) -> dict[str, DataFrame]:
    """What came back of a batch of one class (class 0) that was sent out for annotation.

    manifest: (md5), what was sent. Returns ``findings``; the lines behind them (``malformed``, ``out_of_range``,
    ``other_class``; path, line, total) and ``overlaps`` of one file, each cut to what a report shows, with the whole
    number as ``total``; ``nulled`` (files without a box: left out, never negatives); ``seeds`` (files with a seed line).
    """
    md5 = lambda rows: rows.select(paths.md5_of_name(paths.name(F.col("path"))).alias("md5")).where("md5 <> ''")
    audit = reconcile.manifest_audit(manifest.select("md5"), md5(images), md5(labels), "md5")
    rules = {"missing_images": "original_md5s_missing_from_images", "missing_labels": "original_md5s_missing_from_labels", "unexpected_images": "unexpected_image_md5s", "unexpected_labels": "unexpected_label_md5s"}
    lines = _lines(labels)
    lines = lines.withColumns(_read(F.col("line")))
    numeric = F.col("five") & F.col("class_id").isNotNull()
    for c in ("xc", "yc", "w", "h"):
        numeric = numeric & F.col(c).isNotNull()
    good = lines.where(numeric)
    outside = F.lit(False)
    for c in ("xc", "yc", "w", "h"):
        outside = outside | _outside(F.col(c))
    bad = {"malformed": lines.where(~F.coalesce(numeric, F.lit(False))), "out_of_range": good.where(outside), "other_class": good.where("class_id <> 0")}
    names = {"malformed": "malformed_rows", "out_of_range": "out_of_range_rows", "other_class": "nonzero_class_rows"}
    found = [_stems(images, labels), *(counted_finding(audit.where(F.col("finding") == k), rule) for k, rule in rules.items())]
    found += [counted_finding(rows, names[k]) for k, rows in bad.items()]
    return {
        "findings": united(*found), **{k: capped(rows.select("path", "at", "line"), ["path", "at"], rows_shown).drop("at") for k, rows in bad.items()},
        "overlaps": capped(label_overlaps(good), ["path", "a", "b"], overlaps_shown), "nulled": labels.where(F.size("lines") == 0).select("path"),
        "seeds": lines.where(boxes.is_seed(F.col("line"))).select("path"),
    }


def label_overlaps(rows: DataFrame, coverage: float = 0.90) -> DataFrame:
    """(path, a, b, a_covered, b_covered, smaller_covered): pairs of boxes of one file of which one covers most of the other.

    rows: (path, at, xc, yc, w, h). a and b are numbers among the file's boxes, a < b; shares are whole millionths: of
    the binary product with a million, halves rounded up. Coordinates that are no numbers cover nothing.
    """
    box = ("xc", "yc", "w", "h")
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("path").orderBy("at")) - 1)
    measures = boxes.covered({c: F.col(f"a.{c}") for c in box}, {c: F.col(f"b.{c}") for c in box})
    pairs = meeting(numbered, ["path"], "n").withColumns(measures).where((F.col("shared") > 0) & (F.greatest("a_covered", "b_covered", "smaller_covered") >= coverage))
    return pairs.select("path", F.col("a.key").alias("a"), F.col("b.key").alias("b"), *[(F.round(F.col(c) * 1_000_000) / 1_000_000).alias(c) for c in ("a_covered", "b_covered", "smaller_covered")])


def capped(rows: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first rows in that order, with the number of all of them as ``total``."""
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(*order).limit(most).crossJoin(F.broadcast(total))  # one row


def frozen_findings(images: DataFrame, labels: DataFrame, lineage: DataFrame, classes: int) -> DataFrame:
    """What is wrong with a frozen dataset. Listings also have ``split``; lineage: (md5, ...), a row an image."""
    lines = labels.select("split", "path", F.explode("lines").alias("line"))
    t = boxes.tokens(F.col("line"))
    lines = lines.withColumns({"five": F.size(t) == 5, "class_id": numbers.strict_class(F.get(t, F.lit(0))), "values": F.transform(F.slice(t, 2, 4), lambda x: numbers.to_number(x))})
    subject = F.concat_ws(":", "path", "line")
    five = lines.where("five")
    numeric = F.col("class_id").isNotNull() & F.forall("values", lambda x: x.isNotNull())
    read = five.where(numeric)
    keyed = lambda rows: rows.select(F.concat_ws("/", "split", "stem").alias("stem"))
    return united(
        findings(lines.where("not five"), "malformed_label", "error", F.col("split"), subject),
        findings(five.where(~numeric), "non_numeric_label", "error", F.col("split"), subject),
        findings(read.where((F.col("class_id") < 0) | (F.col("class_id") >= classes)), "invalid_class_id", "error", F.col("split"), F.concat_ws(":", "path", F.col("class_id").cast("string")), F.col("class_id"), classes - 1),
        findings(read.where(F.exists("values", _outside)), "out_of_range_label", "error", F.col("split"), subject),
        _stems(keyed(images), keyed(labels)), counted_finding(_repeated(lineage, "md5"), "duplicate_md5s"),
    )


def normalised_labels(files: DataFrame) -> DataFrame:
    """files (path, content) with polygons made boxes: (path, split, content, changed, and how many rows met which fate).

    Rows of five finite numbers stay to the letter, polygons become their tight boxes, and polygons that leave nothing,
    like all other rows, are dropped. A file's rows keep their order.
    """
    row = lambda line: F.struct(line.alias("line"), boxes.classify(line).alias("kind"), boxes.polygon_box(line).alias("box"))
    files = files.withColumn("rows", F.transform(boxes.lines(F.col("content")), row))
    fate = lambda x: F.when(x["kind"] == "box", F.lit("kept")).when(x["kind"] != "polygon", F.lit("malformed")).when(x["box"].isNull(), F.lit("invalid")).otherwise("converted")
    written = lambda x: F.when(x["kind"] == "box", x["line"]).otherwise(boxes.written(x["box"]))
    files = files.withColumn("rows", F.transform("rows", lambda x: F.struct(fate(x).alias("fate"), written(x).alias("line"))))
    lines = F.transform(F.filter("rows", lambda x: x["fate"].isin("kept", "converted")), lambda x: x["line"])
    new = F.when(F.size(lines) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    count = lambda name: F.size(F.filter("rows", lambda x: x["fate"] == name))
    parts = paths.parts(F.col("path"))
    return files.select(
        "path", F.when(F.size(parts) >= 3, parts[0]).otherwise("unknown").alias("split"), new.alias("content"), (~new.eqNullSafe(F.col("content"))).alias("changed"),
        count("kept").alias("box_rows_unchanged"), count("converted").alias("polygon_rows_converted"), count("malformed").alias("malformed_rows_dropped"),
        count("invalid").alias("invalid_polygon_rows_dropped"),
    )


def strict_files(files: DataFrame, source_id: int, target_id: int) -> DataFrame:
    """files (path, content) with ``lines``, renumbered and written anew; null for a file of which any line is bad."""
    lines = F.transform(boxes.lines(F.col("content")), lambda line: F.struct(boxes.strict_line(line, source_id, target_id).alias("box")))
    files = files.withColumn("read", lines)
    return files.select("path", F.when(F.forall("read", lambda x: x["box"].isNotNull()), F.transform("read", lambda x: boxes.written_short(x["box"]))).alias("lines"))
