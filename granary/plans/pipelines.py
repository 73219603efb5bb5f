"""Whole curation runs: composed operators, lazy until a sink asks for rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import boxes, hashing, numbers, paths, policy
from granary.functions.labels import Labelling, Policy
from granary.operators import accounting, actions, dedup, manifest, qc, reconcile, review, split, validation
from granary.operators import boxes as ob
from granary.sources import sinks, tables


@dataclass(frozen=True)
class UnifiedConfig:
    labelling: Labelling
    seed: int = 42
    min_size: int = 0
    near_prefix: int = 4
    near_bits: int = 5
    negative_share: float = 0.2
    rebalance: tuple[str, float] | None = None
    ratios: tuple = field(default=split.RATIOS)


def unified(assets: DataFrame, config: UnifiedConfig, decisions: DataFrame | None = None) -> dict[str, DataFrame]:
    """Classification assets (source, path, label, length, width, height, sha1, phash) to splits.

    Returns ``splits`` (unique_id, mapped, split, ...), ``review_queue``, ``exact`` and ``near`` (what stays after each
    step). Decisions come before duplicates, so a decided row can lose or win; pending rows take part in duplicates.
    """
    rows = assets.where(F.col("length") >= config.min_size)
    rows = rows.withColumns({"unique_id": paths.unique_id(F.col("source"), F.col("path")), "x": config.labelling.apply(F.col("label"), F.col("source"))})
    rows = rows.select("unique_id", "source", "path", "label", "length", "width", "height", "sha1", "phash", "x.*")
    if decisions is not None:
        rows = review.reviewed(rows, decisions, "unique_id", config.labelling.taxonomy, config.labelling.negatives).drop("applied")
    size = F.coalesce(F.col("width"), F.lit(0)).cast("long") * F.coalesce(F.col("height"), F.lit(0))
    best = [-size, -F.col("length"), F.col("unique_id")]
    exact = dedup.kept_rows(rows, "sha1", best)
    groups = dedup.leaders(exact, "unique_id", "phash", config.near_prefix, config.near_bits).withColumnRenamed("id", "unique_id")
    grouped = exact.join(groups, "unique_id", "left").withColumn("group_id", F.coalesce("group_id", "unique_id"))
    near = dedup.kept_rows(grouped, "group_id", best)
    approved = near.where("status = 'approved'")
    if config.rebalance:
        approved = split.rebalanced(approved, "mapped", "unique_id", *config.rebalance, config.seed)
    positive = split.assigned(approved.where(~F.col("is_negative")), "mapped", "unique_id", config.seed, config.ratios)
    whole = positive.unionByName(approved.where("is_negative").withColumn("split", F.lit(None).cast("string")))
    negative = split.with_negatives(whole, "unique_id", "is_negative", config.seed, config.negative_share, config.ratios)
    return {"splits": positive.unionByName(negative), "review_queue": near.where("status <> 'approved'"), "exact": exact, "near": near}


def detection(candidates: DataFrame, target_ids: dict[str, int]) -> dict[str, DataFrame]:
    """Detection candidates (source_id, path, md5, split, canonical_class, content, names: map of id to name) to one row a content.

    Lines keep their coordinates and get the taxonomy's class ids; unreadable ones are ``warnings``, and images whose
    lines are all unreadable are left out. Boxes of equal images are united.
    """
    ids = F.create_map(*[F.lit(x) for pair in target_ids.items() for x in pair])
    lines = candidates.withColumn("line", F.explode(boxes.lines(F.col("content")))).withColumn("new", boxes.remapped(F.col("line"), F.col("names"), ids))
    warnings = lines.where("new is null").select("source_id", "path", "line")
    per_image = lines.where("new is not null").groupBy("source_id", "path").agg(F.array_distinct(F.collect_list("new")).alias("label_lines"))
    usable = candidates.drop("content", "names").join(per_image, ["source_id", "path"])
    usable = usable.withColumns({"split": F.coalesce("split", hashing.split_by_hash(F.col("md5"))), "annotation_status": F.lit("labelled")})
    order = [F.col("source_id"), F.col("path")]
    merged = dedup.merged_payload(usable, "md5", order, "label_lines", "canonical_class", "annotation_status")
    kept = dedup.kept_rows(usable.drop("label_lines", "canonical_class", "annotation_status"), "md5", order)
    return {"images": kept.join(merged, "md5"), "warnings": warnings}


def box_review(queue: DataFrame, decisions: DataFrame, classes: tuple[str, ...], source_order: tuple[str, ...], loser: str, winner: str) -> dict[str, DataFrame]:
    """The reviewed queue (review_box_id, md5, source_id, box_source, xc, yc, w, h, decision_class, review_status) to label lines.

    Returns ``sources`` (a row an image), ``boxes`` (with kept) and ``labels`` (md5, lines).
    """
    rows = review.overridden(queue, decisions, "review_box_id", ["decision_class", "review_status"], "sequence")
    accepted = ob.accepted_boxes(rows, classes).withColumn("box_id", F.col("review_box_id"))
    sources = ob.merged_sources(accepted, "md5", source_order, loser, winner)
    going = sources.select(F.explode("dropped_boxes").alias("box_id"))
    left = accepted.join(going, "box_id", "left_anti").withColumn("seq", F.col("box_id"))
    found = ob.deduplicated(left.withColumnRenamed("decision_class", "class"), ["md5", "class"])
    place = {c: i for i, c in enumerate(classes)}
    ids = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    line = F.concat_ws(" ", ids[F.col("class")].cast("string"), "xc", "yc", "w", "h")
    kept = found.where("kept").join(left.select("box_id", "xc", "yc", "w", "h"), "box_id")
    labels = kept.groupBy("md5").agg(F.transform(F.array_sort(F.collect_list(F.struct("box_id", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    return {"sources": sources, "boxes": found, "labels": labels}


def incremental(base: DataFrame, candidates: DataFrame, content: str, caps: DataFrame, seed: int) -> dict[str, DataFrame]:
    """New candidates (path, class, split, content) up to a cap for each split and class, numbered on from base (index)."""
    fresh = reconcile.new_rows(reconcile.new_rows(candidates, base, "path"), base, content)
    order = split.seeded(seed, "path")
    picked = split.first_n(fresh, ["split", "class"], order, caps, "cap").drop("place")
    numbered = reconcile.numbered_on(picked, base.select("split", "class", "index"), ["split", "class"], [F.col("path")])
    return {"added": numbered, "short": split.shortfalls(fresh, ["split", "class"], caps, "cap"), "counts": accounting.counted(numbered, "split", "class")}


def frozen(reviewed: DataFrame, boosts: DataFrame, manual: DataFrame, targets: DataFrame) -> dict[str, DataFrame]:
    """Three producers (md5, class, path) in this order; the first to bring a content keeps it.

    Boosts and manual rows are picked up to their target before that, so a duplicate isn't replaced by another row.
    targets: (class, boost_target, manual_target).
    """
    def pick(rows: DataFrame, column: str) -> DataFrame:
        return split.first_n(rows, ["class"], [F.col("path"), F.col("md5")], targets.select("class", column), column).drop("place")

    stages = [reviewed.select("md5", "class", "path"), pick(boosts, "boost_target").select("md5", "class", "path"), pick(manual, "manual_target").select("md5", "class", "path")]
    rows = None
    for i, stage in enumerate(stages):
        stage = stage.withColumn("stage", F.lit(i))
        rows = stage if rows is None else rows.unionByName(stage)
    kept, lost = dedup.first_writer(rows, "md5", [F.col("stage"), F.col("path")])
    kept = kept.withColumn("split", hashing.split_by_key(F.col("class"), F.col("md5")))
    return {"images": kept, "warnings": lost.select("md5", "class", "path", "stage")}


@dataclass(frozen=True)
class QualityLimits:
    """From when on ratios of boxes are findings, and of which severity (warn, error or off)."""

    severity: str = "warn"
    least_multi: float = 0.01
    most_empty: float = 0.40
    least_files: int = 100
    drop_factor: float = 0.35
    least_source_files: int = 30


def validated(images: DataFrame, labels: DataFrame, classes: tuple[str, ...], limits: QualityLimits = QualityLimits(), required: dict[str, tuple[str, ...]] | None = None, coverage: bool = True) -> dict[str, DataFrame]:
    """A dataset of images (split, path) and labels (path, content) held against the quality rules.

    Returns ``findings``, ``queue`` (images that people should look at), ``instances`` (split, class, n) and
    ``histogram`` (split, size, n: how many images have so many boxes). Lines that can't be read are warnings and count
    for nothing, class ids out of range are errors.
    """
    files = images.withColumns({"label_path": paths.label_path(F.col("path")), "source": paths.source_of_stem(paths.stem(F.col("path")))})
    content = labels.select(F.col("path").alias("label_path"), "content", F.lit(True).alias("has_label"))
    files = files.join(content, "label_path", "left").withColumn("has_label", F.coalesce("has_label", F.lit(False)))
    tokens = lambda line: boxes.tokens(line)
    class_of = lambda line: F.when(F.size(tokens(line)) == 5, numbers.strict_class(F.get(tokens(line), F.lit(0))))
    read = F.filter(F.transform(boxes.lines(F.coalesce("content", F.lit(""))), class_of), lambda c: (c >= 0) & (c < len(classes)))
    files = files.withColumn("ids", read).withColumn("boxes", F.size("ids"))
    names = F.array(*[F.lit(c) for c in classes]) if classes else F.array().cast("array<string>")
    instances = files.select("split", F.explode("ids").alias("id")).groupBy("split", F.get(names, F.col("id")).alias("class")).agg(F.count("*").alias("n"))
    ratios = qc.box_ratios(files, ["split"])
    counts = lambda *keys: files.groupBy(*keys).agg(F.count("*").alias("files"), F.count_if(F.col("boxes") > 1).alias("multi"))
    drops = qc.source_drops(counts("split", "source"), ratios, limits.drop_factor, limits.least_source_files)
    lines = files.select("split", F.col("label_path").alias("path"), F.explode(boxes.lines(F.coalesce("content", F.lit("")))).alias("line"))
    absent = files.where(~F.col("has_label")).groupBy("split").agg(F.count("*").alias("n"))
    spark = images.sparkSession
    expected = spark.createDataFrame([(s, c) for s in ("valid", "test") for c in classes], "split string, class string").join(files.select("split").distinct(), "split", "left_semi")
    found = [
        qc.missing_splits(files, paths.SPLITS), qc.bad_lines(lines, len(classes)), qc.findings(absent, "images_without_label", "warn", F.col("split"), observed=F.col("n")),
        qc.low_multi_ratio(ratios, limits.least_multi, limits.least_files, limits.severity), qc.high_empty_ratio(ratios, limits.most_empty, limits.least_files, limits.severity),
        qc.findings(drops, "source_multi_box_drop", limits.severity, F.col("split"), F.col("source"), F.col("own_ratio")),
    ]
    if coverage:
        found.append(qc.absent_classes(instances, expected))
    if required:
        found.append(qc.required_classes(instances, required, classes))
    notes = F.when(~F.col("has_label"), F.lit("missing_label_file")).when(F.col("boxes") == 0, F.lit("empty_label_file")).otherwise("high_box_density")
    queue = qc.queue(files, policy=limits.severity).select("split", "source", "path", "label_path", "reason", "boxes", notes.alias("notes"))
    return {"findings": qc.united(*found), "queue": queue, "instances": instances, "histogram": files.groupBy("split", F.col("boxes").alias("size")).agg(F.count("*").alias("n"))}


def audited(files: DataFrame, limits: QualityLimits = QualityLimits()) -> dict[str, DataFrame]:
    """Label files (split, path, content) by what their rows are: ``files``, ``splits`` (and, with a null split, all), ``histogram`` and ``findings``."""
    text = F.regexp_replace("content", r"(\r\n|\r|\n)\z", "")
    raw = F.when(F.col("content") == "", F.array().cast("array<string>")).otherwise(F.split(text, r"\r\n|\r|\n", -1))
    rows = files.withColumn("kinds", F.transform(raw, lambda line: boxes.classify(line)))
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind))
    rows = rows.select("split", "path", count("box").alias("boxes"), *[count(k).alias(f"{k}_rows") for k in ("polygon", "malformed", "empty")])
    sums = [F.sum(c).alias(n) for c, n in (("boxes", "box_rows"), *((f"{k}_rows",) * 2 for k in ("polygon", "malformed", "empty")))]
    measures = [F.count("*").alias("files_scanned"), F.count_if(F.col("polygon_rows") > 0).alias("files_with_polygons"), *sums]
    whole = rows.groupBy("split").agg(*measures)
    whole = whole.unionByName(rows.agg(*measures).withColumn("split", F.lit(None).cast("string")))
    ratios = qc.box_ratios(rows, ["split"])
    found = qc.united(qc.low_multi_ratio(ratios, limits.least_multi, limits.least_files, limits.severity), qc.high_empty_ratio(ratios, limits.most_empty, limits.least_files, limits.severity))
    return {"files": rows, "splits": whole, "histogram": rows.groupBy("split", F.col("boxes").alias("size")).agg(F.count("*").alias("n")), "findings": found}


def accounted(inventory: DataFrame, labelled: DataFrame, taxonomy: DataFrame, targets: DataFrame) -> dict[str, DataFrame]:
    """Scraped assets (canonical_class, md5, duplicate_role, status) and labelled ones (class, split, md5) by class.

    Returns ``classes`` (all that taxonomy, targets or either table knows), ``total_unique`` (contents of both, once) and
    ``totals`` (with a row of sums).
    """
    scraped = inventory.where(F.coalesce(F.trim("canonical_class"), F.lit("")) != "").withColumn("class", F.trim("canonical_class"))
    unused = scraped.groupBy("class").agg(F.count_if(F.col("duplicate_role") == "canonical").alias("available"), F.count_if(F.col("status") == "scraped_unused").alias("unused"))
    have = labelled.groupBy("class").agg(F.count("*").alias("labelled"), *[F.count_if(F.col("split") == s).alias(s) for s in paths.SPLITS])
    classes = accounting.class_accounting(taxonomy, unused, have, targets)
    unique = accounting.union_counts(scraped.where("duplicate_role = 'canonical'"), labelled, "class", "md5")
    return {"classes": classes, "total_unique": unique, "totals": accounting.with_total(classes.select("class", "available", "unused", "labelled", *paths.SPLITS), "class")}


def scraped_plan(assets: DataFrame, class_of: DataFrame, targets: DataFrame, batch: str, most: int | None = None) -> dict[str, DataFrame]:
    """Scraped assets (source_id, source_family, source_path, md5, extension) to an inventory, and the next batch of each class.

    class_of: (source_id, canonical_class). targets: (canonical_class, batch_size as text); a class without a batch size
    takes ``most``, one that isn't a number nothing. Only a content's first asset, by path and source, can be planned.
    """
    rows = dedup.ranked(assets.join(class_of, "source_id"), "md5", [F.col("source_path"), F.col("source_id")])
    rows = rows.withColumns(
        {
            "status": F.when(F.col("duplicate_rank") == 1, F.lit("scraped_unused")).otherwise("duplicate_exact_content"),
            "future_staged_image": paths.planned_path(F.col("canonical_class"), F.lit(batch), "images", F.col("md5"), F.col("extension")),
            "future_staged_label": paths.planned_path(F.col("canonical_class"), F.lit(batch), "labels", F.col("md5"), F.lit(".txt")), "full_image_label": F.lit(boxes.SEED_BOX),
        }
    )
    size = F.trim(F.coalesce("batch_size", F.lit("")))
    limit = F.when(size.rlike("^[+-]?[0-9]{1,9}$"), F.greatest(F.lit(0), size.try_cast("int"))).when(size == "", F.lit(max(0, most or 0))).otherwise(0)
    limits = rows.select("canonical_class").distinct().join(targets.select("canonical_class", "batch_size"), "canonical_class", "left").select("canonical_class", limit.alias("limit"))
    preview = split.first_n(rows.where("duplicate_rank = 1"), ["canonical_class"], [F.col("md5"), F.col("source_path")], limits, "limit").withColumnRenamed("place", "batch_order")
    preview = preview.withColumn("status", F.lit("planned_for_future_staging"))
    first = F.col("duplicate_rank") == 1
    assessment = rows.groupBy("canonical_class").agg(
        F.count_distinct("source_id").alias("source_count"), F.count("*").alias("available_image_count"), F.count_if(first).alias("unique_image_count"),
        F.count_if(~first).alias("duplicate_image_count"),
    )
    for key in ("source_family", "extension"):
        assessment = assessment.join(accounting.breakdown(rows, "canonical_class", key).withColumnRenamed("breakdown", f"{key}_breakdown"), "canonical_class", "left")
    order = [F.col("source_path"), F.col("source_id")]
    return {"inventory": rows, "preview": preview, "assessment": assessment, "duplicates": dedup.duplicates_report(rows, "md5", "source_path", order)}


def normalised(files: DataFrame, root: str) -> dict[str, DataFrame]:
    """Label files (path, content) with polygons made boxes: ``labels``, ``splits`` (counts), and the ``plan`` of writes."""
    labels = validation.normalised_labels(files)
    fates = [c for c in labels.columns if c.endswith(("_unchanged", "_converted", "_dropped"))]
    by_split = labels.groupBy("split").agg(F.count("*").alias("files_targeted"), F.count_if("changed").alias("files_rewritten"), *[F.sum(c).alias(c) for c in fates])
    return {"labels": labels, "splits": by_split, "plan": actions.rewritten(labels, root)}


def one_class_batches(inventory: DataFrame, files: DataFrame, targets: DataFrame, in_root: str, out_root: str) -> dict[str, DataFrame]:
    """The next batch of each class that has a target, from inventory (canonical_class, duplicate_role, md5, source_path).

    files: (path), what there is. targets: (canonical_class, target). Images are named by their content and labelled by
    one seed box. Returns ``selected`` (with output_image and output_label), the ``plan`` of copies and label files, and
    ``short`` (classes with fewer images than their target).
    """
    usable = reconcile.existing(inventory.where(F.trim("duplicate_role") == "canonical"), files, "source_path")
    usable = usable.join(targets.where("target > 0").select("canonical_class"), "canonical_class", "left_semi")
    picked = split.first_n(usable, ["canonical_class"], [F.col("md5"), F.col("source_path")], targets.select("canonical_class", "target"), "target").drop("place")
    output = lambda kind, ending: F.concat(F.concat_ws("/", F.col("canonical_class"), F.lit("train"), F.lit(kind), F.col("md5")), ending)
    picked = picked.withColumns(
        {
            "output_image": output("images", F.lower(paths.suffix(F.col("source_path")))), "output_label": output("labels", F.lit(".txt")), "lines": F.array(F.lit(boxes.SEED_BOX)),
            "from": F.concat(F.lit(in_root.rstrip("/") + "/"), F.trim("source_path")),
        }
    )
    plan = actions.exported(picked, "from", "output_image", "output_label", "lines", out_root)
    return {"selected": picked.drop("lines", "from"), "plan": plan, "short": split.shortfalls(usable, ["canonical_class"], targets.where("target > 0").select("canonical_class", "target"), "target")}


def review_queue(files: DataFrame, defaults: dict[str, str]) -> dict[str, DataFrame]:
    """Files (md5, source_id, path, content or null) as a queue of boxes to review, in the order that people get it.

    defaults: the decision that a source's boxes start with. Returns ``queue`` and ``counts`` (source_id, status, images, boxes).
    """
    from granary.functions.labels import lookup

    rows = ob.review_rows(files).withColumns({"decision_class": F.coalesce(lookup(F.col("source_id"), defaults), F.lit("uncertain")), "review_status": F.lit("pending")})
    counts = rows.groupBy("source_id", "status").agg(F.count_distinct("md5").alias("images"), F.count("*").alias("boxes"))
    return {"queue": rows.orderBy("source_id", "path", "box_index"), "counts": counts}


def merged_datasets(base: DataFrame, incoming: DataFrame, base_names: list[str], names: list[str], base_root: str, in_root: str, out_root: str) -> dict[str, DataFrame]:
    """Two datasets (path, label_path, content_hash) as one: base as it is, and of incoming what it lacks by content.

    The class order has to extend the base's. Incoming files whose names are in use are numbered on. Returns ``rows``
    (path, label_path, content_hash, origin, unique_name) and the ``plan`` of copies of images and labels.
    """
    policy.extended_order(base_names, names)
    rows = reconcile.merged(base.select("path", "label_path", "content_hash"), incoming.select("path", "label_path", "content_hash"), "content_hash", [F.col("path")])
    own = rows.where("origin = 'base'").withColumn("unique_name", F.col("path"))
    new = reconcile.unique_names(rows.where("origin = 'incremental'"), "path", [F.col("path"), F.col("content_hash")], base.select("path"))
    rows = own.unionByName(new)
    root = F.when(F.col("origin") == "base", F.lit(base_root)).otherwise(F.lit(in_root))
    copies = lambda source, target: rows.select(F.lit("copy").alias("action"), F.concat_ws("/", root, F.col(source)).alias("source"), F.concat_ws("/", F.lit(out_root), target).alias("target"), F.lit(None).cast("string").alias("content"))
    return {"rows": rows, "plan": copies("path", F.col("unique_name")).union(copies("label_path", paths.label_path(F.col("unique_name"))))}


def mapped_categories(images: DataFrame, annotations: DataFrame, categories: DataFrame, mapping: Policy, supercategory: str = "") -> dict[str, DataFrame]:
    """The tables of an annotated dataset (as ``tables.read_coco`` gives them) with the categories of a mapping policy.

    Returns ``images`` that keep an annotation; ``annotations`` that are mapped, with the new category_id; ``categories``,
    the targets numbered from 1; and ``counts`` (kind, label, n) of annotations by source label, target, and labels that
    are ignored and to be reviewed. An annotation whose category isn't listed has the empty label.
    """
    names = categories.select(F.col("id").alias("category_id"), mapping.normalized(F.col("name")).alias("label"))
    named = annotations.join(names, "category_id", "left").withColumn("label", F.coalesce("label", F.lit("")))
    decided = named.withColumn("x", mapping.apply(F.col("label"))).select(*annotations.columns, "label", "x.action", "x.target")
    ids = F.create_map(*[F.lit(x) for pair in zip(mapping.targets, range(1, len(mapping.targets) + 1), strict=True) for x in pair])
    kept = decided.where("action = 'map'").withColumn("category_id", ids[F.col("target")].cast(annotations.schema["category_id"].dataType))
    counted = lambda kind, rows, label: rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "label", "n")
    counts = counted("source", decided, "label").union(counted("target", kept, "target"))
    for action in ("ignore", "review"):
        counts = counts.union(counted(action, decided.where(F.col("action") == action), "label"))
    new = images.sparkSession.createDataFrame([(i, n, supercategory) for i, n in enumerate(mapping.targets, 1)], "id long, name string, supercategory string")
    return {"images": manifest.kept_images(images, decided), "annotations": kept.select(*annotations.columns), "categories": new, "counts": counts}


def map_document(spark: SparkSession, document: str, out: str, mapping: Policy, supercategory: str = "") -> dict:
    """Map a COCO document, write the new one, and return the report: numbers of images and annotations, and counts of labels.

    The document is read in splits; the report holds a row for each label.
    """
    images, annotations, categories = tables.read_coco(spark, document)
    new = mapped_categories(images, annotations, categories, mapping, supercategory)
    sinks.write_document({k: new[k] for k in ("images", "annotations", "categories")}, out)
    by_kind = sinks.nested(new["counts"].groupBy("kind", "label").agg(F.sum("n").alias("n")), "kind", "label")
    report = {"input_file": document, "output_file": out, "unknown_action": mapping.unknown, "input_images": images.count(), "input_annotations": annotations.count()}
    report |= {"output_images": new["images"].count(), "output_annotations": new["annotations"].count()}
    return report | {f"{name}_label_counts": by_kind.get(kind, {}) for name, kind in (("source", "source"), ("target", "target"), ("ignored", "ignore"), ("review", "review"))}


def baseline_report(train: DataFrame, test: DataFrame, side: int = 48, rounds: int = 2000) -> dict[str, DataFrame]:
    """The baseline classifier, fitted on train and asked about test, both (image, label): its ``classes``, ``overall`` figures,
    ``confusion`` and ``worst`` confusions."""
    from granary.functions import pixels
    from granary.operators import learning, metrics

    model = learning.train_baseline(pixels.features(train.select("image", "label"), side), rounds)
    said = learning.predicted(model, pixels.features(test.select("image", "label"), side)).select(F.col("label").alias("truth"), "predicted")
    return {"classes": metrics.class_report(said), "overall": metrics.overall(said), "confusion": metrics.confusion(said), "worst": metrics.top_confusions(said)}


def compared_runs(files: dict[str, str], columns: dict[str, str], spark, metric: str, window: int = 0) -> dict[str, DataFrame]:
    """Results files of training runs, one a run: ``epochs`` (the last line of each, of the latest ``window`` epochs if given),
    ``summary`` (best and latest of the metric) and ``changes`` from epoch to epoch."""
    from granary.operators import metrics
    from granary.sources import tables

    if metric not in columns:
        raise ValueError(f"no such metric: {metric}")
    epochs = tables.last_epochs(tables.read_runs(spark, files, columns))
    if epochs.isEmpty():
        raise ValueError("no epochs")
    shown = metrics.latest_epochs(epochs, window, "shared") if window else epochs
    return {"epochs": shown, "summary": metrics.best_and_latest(epochs, metric), "changes": metrics.step_changes(shown, metric)}
