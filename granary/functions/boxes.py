"""Label lines and the geometry of boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions import numbers

# The line of a box that covers (almost) the whole image, as seed for annotators, and how it is written.
SEED_BOX = "0 0.5 0.5 0.95 0.95"
SEED_LINES = ("0 0.5 0.5 1 1", "0 0.5 0.5 1.0 1.0", "0 0.5 0.5 0.95 0.95")


def tokens(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda t: t != "")


def lines(content: Column) -> Column:
    """The stripped lines of a label file that are not empty."""
    return F.filter(F.transform(F.split(content, r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def is_seed(line: Column) -> Column:
    """Whether a line is a seed that no annotator has touched."""
    return line.isin(*SEED_LINES)


def classify(line: Column) -> Column:
    """empty, box (5 finite numbers), polygon (a class and 3 or more points) or malformed."""
    return numbers.named(tokens(line), _kind)


def _kind(t: Column) -> Column:
    good = F.forall(t, lambda x: numbers.finite(x).isNotNull())
    return (
        F.when(F.size(t) == 0, F.lit("empty"))
        .when(~good, F.lit("malformed"))
        .when(F.size(t) == 5, F.lit("box"))
        .when((F.size(t) >= 7) & (F.size(t) % 2 == 1), F.lit("polygon"))
        .otherwise("malformed")
    )


def parsed(line: Column) -> Column:
    """struct(class_id, xc, yc, w, h) of a line of five numbers, all four within [0, 1]; else null."""

    def box(t: Column, class_id: Column) -> Column:
        inside = lambda x: F.coalesce(x.between(0, 1), F.lit(False))
        made = lambda v: F.struct(class_id.alias("class_id"), *[F.get(v, F.lit(i)).alias(c) for i, c in enumerate(("xc", "yc", "w", "h"))])
        return numbers.named(F.transform(F.slice(t, 2, 4), numbers.finite), lambda v: F.when(class_id.isNotNull() & F.forall(v, inside), made(v)))

    read = lambda t: numbers.named(numbers.truncated_class(F.get(t, F.lit(0))), lambda class_id: box(t, class_id))
    return numbers.named(tokens(line), lambda t: F.when(F.size(t) == 5, read(t)))


def polygon_box(line: Column) -> Column:
    """struct(class_id, xc, yc, w, h): the tight box of a polygon's points, cut to [0, 1]; null if nothing is left of it."""
    return numbers.named(tokens(line), lambda t: F.when(_kind(t) == "polygon", _tight(t)))


def _tight(t: Column) -> Column:
    cut = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))

    def box(at: Column) -> Column:
        axis = lambda k, f: cut(f(F.filter(at["points"], lambda _, i: i % 2 == k)))
        ends = F.struct(axis(0, F.array_min).alias("x0"), axis(0, F.array_max).alias("x1"), axis(1, F.array_min).alias("y0"), axis(1, F.array_max).alias("y1"))
        return numbers.named(ends, lambda e: F.when(at["class_id"].isNotNull() & (e["x1"] - e["x0"] > 0) & (e["y1"] - e["y0"] > 0), F.struct(
            at["class_id"].alias("class_id"), ((e["x0"] + e["x1"]) / 2).alias("xc"), ((e["y0"] + e["y1"]) / 2).alias("yc"), (e["x1"] - e["x0"]).alias("w"), (e["y1"] - e["y0"]).alias("h"),
        )))

    points = F.transform(F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))), lambda x: numbers.finite(x))
    return numbers.named(F.struct(numbers.integral_class(F.get(t, F.lit(0))).alias("class_id"), points.alias("points")), box)


def corners(xc: Column, yc: Column, w: Column, h: Column) -> dict[str, Column]:
    return {"x0": xc - w / 2, "y0": yc - h / 2, "x1": xc + w / 2, "y1": yc + h / 2}


def overlap(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Measures of two boxes given as xc, yc, w, h. Where an area is 0, what is divided by it is 0."""
    p, q = corners(**a), corners(**b)
    zero = F.lit(0.0)
    side = lambda lo, hi: F.greatest(zero, F.least(p[hi], q[hi]) - F.greatest(p[lo], q[lo]))
    shared = side("x0", "x1") * side("y0", "y1")
    area = lambda x: F.greatest(zero, x["w"]) * F.greatest(zero, x["h"])
    one, two = area(a), area(b)
    return {
        "iou": numbers.ratio(shared, one + two - shared),
        "of_smaller": numbers.ratio(shared, F.least(one, two)),
        "of_a": numbers.ratio(shared, one),
        "of_b": numbers.ratio(shared, two),
        "area_ratio": numbers.ratio(F.least(one, two), F.greatest(one, two)),
    }


def covered(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """The shared area of two boxes, and which share of either, and of the smaller one, it is. Areas count as 1e-12 at least."""
    p, q = corners(**a), corners(**b)
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(p[hi], q[hi]) - F.greatest(p[lo], q[lo]))
    shared = side("x0", "x1") * side("y0", "y1")
    one, two = (F.greatest(x["w"] * x["h"], F.lit(1e-12)) for x in (a, b))
    return {"shared": shared, "a_covered": shared / one, "b_covered": shared / two, "smaller_covered": shared / F.least(one, two)}


def written(box: Column) -> Column:
    """The line of a struct(class_id, xc, yc, w, h), with six decimals."""
    return F.concat_ws(" ", box["class_id"].cast("string"), *[numbers.fixed6(box[c]) for c in ("xc", "yc", "w", "h")])


def written_short(box: Column) -> Column:
    """The same with at most twelve digits."""
    return F.concat_ws(" ", box["class_id"].cast("string"), *[numbers.short12(box[c]) for c in ("xc", "yc", "w", "h")])


def priority(value: Column, order: tuple[str, ...], otherwise: int = 999) -> Column:
    """The place of a value in a list."""
    out = F.lit(otherwise)
    for i, x in reversed(list(enumerate(order))):
        out = F.when(value == x, F.lit(i)).otherwise(out)
    return out


def remapped(line: Column, source_names: Column, target_ids: Column) -> Column:
    """Lenient: the line with its class renumbered by name, coordinates as they are; null if it can't be.

    source_names: map of id to name; target_ids: map of name to id.
    """
    t = tokens(line)
    found = F.try_element_at(source_names, numbers.truncated_class(F.get(t, F.lit(0))))
    new = F.coalesce(F.try_element_at(target_ids, found), F.try_element_at(target_ids, F.lower(found)))
    return F.when((F.size(t) == 5) & new.isNotNull(), F.concat_ws(" ", new.cast("string"), F.array_join(F.slice(t, 2, 4), " ")))


def strict_line(line: Column, source_id: int, target_id: int) -> Column:
    """struct(class_id, xc, yc, w, h) of a line of exactly that class, within [0, 1], renumbered; else null."""
    box = parsed(line)
    return F.when(numbers.strict_class(F.get(tokens(line), F.lit(0))) == source_id, box.withField("class_id", F.lit(target_id)))
