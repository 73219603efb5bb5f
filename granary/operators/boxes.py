"""Boxes of one image against each other, and across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import boxes
from granary.lineage import cut

_BOX = ("xc", "yc", "w", "h")


#: Cells of level l are 4**-l wide. Boxes wider than a quarter are on level 0, which is one cell; those of the last level may be as small as they like.
LEVELS = 6
#: Boxes of a group that are compared where they are collected; larger groups meet on the grid.
GROUP_BOXES = 64


def meeting(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """(group, a, b): the pairs of boxes of a group that share an area, as structs of key, xc, yc, w and h, with a's key before b's.

    A grid of several levels: a box is at home in the (at most four) cells that it touches on the level of its size, and
    looks for larger ones in the cells that it touches there and on all coarser levels. A pair that meets in several cells
    counts in the one with the lower corner of what both share. So boxes meet neighbours, not all of their group. Null
    groups are one group; boxes without a width, a height or finite numbers share nothing. Keys are unique in a group.
    """
    finite = F.lit(True)
    for c in _BOX:
        finite = finite & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    side = F.greatest("w", "h")
    level = F.lit(LEVELS - 1)
    for n in range(LEVELS - 2, -1, -1):
        level = F.when(side > F.lit(0.25 ** (n + 1)), n).otherwise(level)
    corner = boxes.corners(*(F.col(c) for c in _BOX))
    own = rows.where(finite & (F.col("w") > 0) & (F.col("h") > 0)).select(
        *group, F.struct(F.col(key).alias("key"), *[F.col(c).cast("double").alias(c) for c in _BOX]).alias("box"), F.struct(*[corner[c].alias(c) for c in corner]).alias("at"), level.alias("level")
    )

    def cells(on: Column) -> Column:
        scale = F.pow(F.lit(4.0), on)
        along = lambda lo, hi: F.when(on == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(F.array(F.floor(F.col(lo) * scale), F.floor(F.col(hi) * scale))))
        return F.flatten(F.transform(along("at.x0", "at.x1"), lambda x: F.transform(along("at.y0", "at.y1"), lambda y: F.struct(on.cast("int").alias("level"), x.alias("x"), y.alias("y")))))

    # Most boxes of photographs are large, and on level 0 there is one cell. Cells are never empty; of the plainer function Spark infers a filter that works them out once more.
    whole = F.array(F.struct(F.lit(0).alias("level"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y")))
    home = own.select(*group, F.col("box").alias("h"), F.col("at").alias("h_at"), F.explode_outer(F.when(F.col("level") == 0, whole).otherwise(cells(F.col("level")))).alias("cell"))
    looks = own.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("box").alias("p"), F.col("at").alias("p_at"), F.col("level").alias("p_level"), F.explode_outer(F.when(F.col("level") == 0, whole).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), "level"), cells)))).alias("p_cell"))
    same = F.col("cell") == F.col("p_cell")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    lower = lambda c: F.floor(F.greatest(f"h_at.{c}0", f"p_at.{c}0") * F.pow(F.lit(4.0), F.col("cell.level"))) == F.col(f"cell.{c}")
    shares = (F.least("h_at.x1", "p_at.x1") > F.greatest("h_at.x0", "p_at.x0")) & (F.least("h_at.y1", "p_at.y1") > F.greatest("h_at.y0", "p_at.y0"))
    once = (F.col("p_level") > F.col("cell.level")) | (F.col("h.key") < F.col("p.key"))
    met = home.join(looks, same).where(once & shares & ((F.col("cell.level") == 0) | lower("x") & lower("y")))
    first = F.col("h.key") < F.col("p.key")
    return met.select(*group, F.when(first, F.col("h")).otherwise(F.col("p")).alias("a"), F.when(first, F.col("p")).otherwise(F.col("h")).alias("b"))


def _measured(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(boxes.overlap({c: F.col(f"a.{c}") for c in _BOX}, {c: F.col(f"b.{c}") for c in _BOX}))


def overlapping(rows: DataFrame, group: list[str], iou: float = 0.85, coverage: float = 0.90) -> DataFrame:
    """(group, a, b, measures): pairs of boxes a < b of a group, of which one of the measures (thresholds above 0) is reached.

    rows: group columns, box_id (unique in its group), xc, yc, w, h. Null groups have no pairs.
    """
    known = rows
    for g in group:
        known = known.where(F.col(g).isNotNull())
    pairs = _measured(meeting(known, group, "box_id")).where((F.col("iou") >= iou) | (F.col("of_smaller") >= coverage))
    return pairs.select(*group, F.col("a.key").alias("a"), F.col("b.key").alias("b"), "iou", "of_smaller", "of_a", "of_b", "area_ratio")


def deduplicated(rows: DataFrame, group: list[str], iou: float = 0.85, coverage: float = 0.90) -> DataFrame:
    """(group, box_id, kept, kept_by, reason): the boxes that stay, and for each that doesn't, why.

    The first overlapping pair in list order (``seq``) loses its worse box, and the search starts anew: synthetic boxes
    lose, then those made for missing labels, then larger ones, then later ids. So the outcome depends on the order.
    rows: group columns, box_id, seq, box_source, xc, yc, w, h. A group is an image's boxes of a class; seq and box_id
    together are unique in it.

    Nearly all groups are small: their boxes are collected once, and settled there pair by pair. Groups of more than
    ``GROUP_BOXES`` meet on a grid and are settled in rounds.
    """
    rank = F.struct(
        F.coalesce(F.col("box_source").startswith("synthetic"), F.lit(False)).alias("synthetic"), F.col("box_source").eqNullSafe("synthetic_missing_label").alias("missing"),
        (F.col("w") * F.col("h")).alias("area"), F.col("box_id").alias("id"),
    )
    rows = rows.withColumn("__key", F.struct("seq", F.col("box_id").alias("id"), rank.alias("rank")))
    of = [F.col(g).alias(f"__g{i}") for i, g in enumerate(group)] or [F.lit(0).alias("__g0")]
    large = cut(rows.groupBy(*of).count().where(F.col("count") > GROUP_BOXES).drop("count"))
    if large.isEmpty():
        return _collected(rows, group, iou, coverage)
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    small = _collected(rows.join(large, same, "left_anti"), group, iou, coverage)
    return small.union(_in_rounds(rows.join(large, same, "left_semi"), group, iou, coverage))


def _collected(rows: DataFrame, group: list[str], iou: float, coverage: float) -> DataFrame:
    """``deduplicated`` of small groups. A pair in list order counts if neither of its boxes has gone by then."""
    box = F.struct("__key", *[F.col(c).cast("double").alias(c) for c in _BOX])
    groups = rows.groupBy(*group).agg(F.array_sort(F.collect_list(box)).alias("__boxes"))

    def why(a: Column, b: Column) -> Column:
        p, q = ({c: x[c] for c in _BOX} for x in (a, b))
        sound = F.lit(True)
        for x in (*p.values(), *q.values()):
            sound = sound & ~F.isnan(x) & (F.abs(x) != float("inf"))
        for x in (p, q):
            sound = sound & (x["w"] > 0) & (x["h"] > 0)
        one, two = boxes.corners(**p), boxes.corners(**q)
        for c in "xy":
            sound = sound & (F.least(one[f"{c}1"], two[f"{c}1"]) > F.greatest(one[f"{c}0"], two[f"{c}0"]))
        m = boxes.overlap(p, q)
        return F.when(sound & (m["iou"] >= iou), F.lit("iou_threshold")).when(sound & (m["of_smaller"] >= coverage), F.lit("coverage_threshold"))

    def pair(a: Column, i: Column, b: Column, j: Column) -> Column:
        worse = a["__key"]["rank"] > b["__key"]["rank"]
        return F.struct(F.when(worse, i).otherwise(j).alias("goes"), F.when(worse, j).otherwise(i).alias("stays"), why(a, b).alias("why"))

    every = F.col("__boxes")
    after = lambda a, i: F.transform(F.slice(every, i + F.lit(2), F.size(every)), lambda b, k: pair(a, i, b, i + k + F.lit(1)))
    pairs = F.filter(F.flatten(F.transform(every, after)), lambda x: x["why"].isNotNull())
    settled = lambda lost, x: F.when(F.exists(lost, lambda y: (y["goes"] == x["goes"]) | (y["goes"] == x["stays"])), lost).otherwise(F.concat(lost, F.array(x)))
    lost = F.aggregate(pairs, F.array().cast("array<struct<goes:int,stays:int,why:string>>"), settled)
    groups = groups.select(*group, "__boxes", lost.alias("__lost"))
    out = groups.select(*group, "__boxes", "__lost", F.posexplode_outer("__boxes").alias("__at", "__box"))
    mine = F.get(F.filter("__lost", lambda x: x["goes"] == F.col("__at")), F.lit(0))
    out = out.select(*group, F.col("__box.__key.id").alias("box_id"), mine.alias("__mine"), "__boxes")
    return out.select(*group, "box_id", F.col("__mine").isNull().alias("kept"), F.get("__boxes", F.col("__mine.stays"))["__key"]["id"].alias("kept_by"), F.col("__mine.why").alias("reason"))


def _in_rounds(rows: DataFrame, group: list[str], iou: float, coverage: float) -> DataFrame:
    """``deduplicated`` of groups of any size.

    Who would lose a pair is known from the start; whether it comes to that depends on the pairs before it. A pair is
    settled once neither of its boxes can lose an earlier one: its worse box goes, and with it all later pairs of that box.
    Rounds of joins settle all such pairs at once, the first of all pairs at least.
    """
    why = F.when(F.col("iou") >= iou, F.lit("iou_threshold")).when(F.col("of_smaller") >= coverage, F.lit("coverage_threshold"))
    pairs = _measured(meeting(rows, group, "__key")).withColumn("why", why).where("why is not null")
    worse = F.col("a.key.rank") > F.col("b.key.rank")
    box = lambda c: F.struct(F.col(f"{c}.key.seq").alias("seq"), F.col(f"{c}.key.id").alias("id"))
    left = pairs.select(
        F.struct(*group).alias("g") if group else F.lit(0).alias("g"), F.struct(box("a").alias("a"), box("b").alias("b")).alias("at"), F.when(worse, box("a")).otherwise(box("b")).alias("goes"),
        F.when(worse, box("b")).otherwise(box("a")).alias("stays"), "why",
    )
    left = cut(left)
    settled = left.limit(0)
    while not left.isEmpty():
        first = left.groupBy("g", F.col("goes").alias("box")).agg(F.min("at").alias("first"))
        losing = first.select(F.col("g").alias("g1"), F.col("box").alias("box1"), F.col("first").alias("first1"))
        keeping = first.select(F.col("g").alias("g2"), F.col("box").alias("box2"), F.col("first").alias("first2"))
        now = left.join(losing, F.col("g").eqNullSafe(F.col("g1")) & (F.col("goes") == F.col("box1")) & (F.col("at") == F.col("first1")))
        now = now.join(keeping, F.col("g").eqNullSafe(F.col("g2")) & (F.col("stays") == F.col("box2")), "left").where(F.col("first2").isNull() | (F.col("at") < F.col("first2")))
        now = cut(now.select(*left.columns))
        settled = settled.union(now)
        gone = now.select(F.col("g").alias("g1"), F.col("goes").alias("box1"), F.col("at").alias("at1"))
        left = left.join(gone, F.col("g").eqNullSafe(F.col("g1")) & (F.col("goes") == F.col("box1")), "left_anti")
        left = left.join(gone, F.col("g").eqNullSafe(F.col("g1")) & (F.col("stays") == F.col("box1")) & (F.col("at") > F.col("at1")), "left_anti")
        left = cut(left)
    lost = settled.select(F.col("g").alias("__g"), F.col("goes").alias("__goes"), F.col("stays.id").alias("kept_by"), F.col("why").alias("reason"))
    mine = F.struct(*group) if group else F.lit(0)
    out = rows.join(lost, mine.eqNullSafe(F.col("__g")) & (F.struct("__key.seq", "__key.id") == F.col("__goes")), "left")
    return out.select(*group, "box_id", F.col("__goes").isNull().alias("kept"), "kept_by", "reason")


def merged_sources(rows: DataFrame, image: str, source_order: tuple[str, ...], loser: str, winner: str) -> DataFrame:
    """A row an image: its sources, classes, kept source, status, and the ids of its boxes that stay and go.

    Where several sources disagree between ``loser`` and ``winner``, the loser's boxes go. rows: image, source_id,
    decision_class, box_id.
    """
    first = F.min(F.struct(boxes.priority(F.col("source_id"), source_order).alias("p"), F.col("source_id").alias("s")))
    out = rows.groupBy(image).agg(
        F.array_sort(F.collect_set("source_id")).alias("sources"), F.array_sort(F.collect_set("decision_class")).alias("classes"),
        first.alias("first"), F.array_sort(F.collect_list(F.struct("box_id", "decision_class"))).alias("boxes"),
    )
    several = F.size("sources") > 1
    conflict = several & F.array_contains("classes", loser) & F.array_contains("classes", winner)
    status = (
        F.when(conflict, F.lit("resolved_conflict")).when(several & (F.size("classes") == 1), F.lit("deduped_same_class_labels"))
        .when(several, F.lit("merged_multiclass_labels")).otherwise("single_source")
    )
    goes = lambda b: conflict & (b["decision_class"] == loser)
    return out.select(
        image, F.col("first.s").alias("kept_source"), F.array_join("sources", "|").alias("all_sources"), F.array_join("classes", "|").alias("accepted_classes"),
        status.alias("status"),
        F.transform(F.filter("boxes", lambda b: ~goes(b)), lambda b: b["box_id"]).alias("kept_boxes"),
        F.transform(F.filter("boxes", goes), lambda b: b["box_id"]).alias("dropped_boxes"),
    )


def export_relevance(rows: DataFrame, image: str, accepted: str) -> DataFrame:
    """(image, sources, accepted_sources, relevance) of images with several sources. accepted: a boolean column."""
    out = rows.groupBy(image).agg(
        F.count_distinct("source_id").alias("sources"), F.count_distinct(F.when(F.col(accepted), F.col("source_id"))).alias("accepted_sources"),
        F.array_join(F.array_sort(F.collect_set("decision_class")), "|").alias("decisions"),
    )
    relevance = (
        F.when(F.col("accepted_sources") > 1, F.lit("accepted_cross_source")).when(F.col("accepted_sources") == 1, F.lit("accepted_single_source")).otherwise("not_export_ready")
    )
    return out.where("sources > 1").withColumn("relevance", relevance)


def review_rows(files: DataFrame) -> DataFrame:
    """files (md5, source_id, path, content or null) as a row for each box, or a full-image box where there is none.

    Adds box_index, review_box_id, box_source, status and the box. Malformed lines are left out and said so.
    """
    found = F.transform(boxes.lines(F.col("content")), lambda line: boxes.parsed(line))
    files = files.withColumns({"lines": boxes.lines(F.col("content")), "found": F.filter(found, lambda b: b.isNotNull())})
    status = (
        F.when(F.col("content").isNull(), F.lit("missing_label")).when(F.size("lines") == 0, F.lit("empty_label")).when(F.size("found") == F.size("lines"), F.lit("ok"))
        .when(F.size("found") > 0, F.lit("warning_malformed_ignored")).otherwise("malformed_label")
    )
    full = F.struct(F.lit(0).alias("class_id"), F.lit(0.5).alias("xc"), F.lit(0.5).alias("yc"), F.lit(1.0).alias("w"), F.lit(1.0).alias("h"))
    none = F.coalesce(F.size("found"), F.lit(0)) <= 0
    made = F.when(F.col("content").isNull(), F.lit("synthetic_missing_label")).otherwise("synthetic_full_image")
    rows = files.withColumns({"status": status, "box_source": F.when(none, made).otherwise("label"), "found": F.when(none, F.array(full)).otherwise(F.col("found"))})
    # Never empty; of the plainer function Spark infers a filter that works out the boxes once more.
    rows = rows.select("md5", "source_id", "path", "status", "box_source", F.posexplode_outer("found").alias("box_index", "box"))
    identity = F.concat_ws("__", "md5", "source_id", F.concat(F.lit("box"), F.lpad(F.col("box_index").cast("string"), 4, "0")))
    return rows.select("md5", "source_id", "path", "status", "box_source", "box_index", identity.alias("review_box_id"), "box.*")


def accepted_boxes(rows: DataFrame, decisions: tuple[str, ...], statuses: tuple[str, ...] = ("accepted", "reviewed", "done")) -> DataFrame:
    """Reviewed rows that go into an export: decided for a class, with a status that says so and a box inside the image."""
    inside = F.lit(True)
    for c in _BOX:
        inside = inside & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return rows.where(F.col("decision_class").isin(*decisions) & F.col("review_status").isin(*statuses) & inside)
