"""Text that only makes sense in order, read in splits: CSV with line breaks in quotes, and arrays of one JSON document.

Spark reads any text in splits, cut at a separator; what a piece means depends on all before it: whether it starts in
quotes, and how deep. Each piece is a function of the state that it starts in, and such functions can be chained: inside
a split by windows, for both states, and across splits by one row each. So no task reads more than its split, and the
splits' rows are all that is looked at in order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.lineage import cut, shared_folder

_SPLIT = ("file", "block")


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, place, piece): a text cut at each separator. block: where the split begins; place: order inside of it."""
    text = spark.read.option("lineSep", separator).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"))


def _before(*by: str, order: str) -> Window:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _chained(rows: DataFrame, by: tuple[str, ...], order: str, zero: Column, one: Column, out: str) -> DataFrame:
    """rows with ``out``: where a chain of functions stands before each row, as struct(zero, one) for both states that it may begin in.

    zero and one: the state (0 or 1) behind a row that starts in state 0 or 1. A function is constant, or leaves all as it
    is, or swaps; so the state is that of the last constant, swapped as often as swaps followed.
    """
    w = _before(*by, order=order)
    swaps = F.coalesce(F.sum(F.when((zero == 1) & (one == 0), 1).otherwise(0)).over(w), F.lit(0))
    rows = rows.withColumn("__swaps", swaps)
    last = F.last(F.when(zero == one, F.struct(zero.alias("to"), F.col("__swaps").alias("at"))), ignorenulls=True).over(w)
    rows = rows.withColumn("__last", last)
    state = lambda start: F.when(F.col("__last").isNotNull(), (F.col("__last.to") + F.col("__swaps") - F.col("__last.at")) % 2).otherwise((start + F.col("__swaps")) % 2).cast("int")
    return rows.withColumn(out, F.struct(state(0).alias("zero"), state(1).alias("one"))).drop("__swaps", "__last")


def _pick(state: Column, both: Column) -> Column:
    return F.when(state == 0, both["zero"]).otherwise(both["one"])


def _joined(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    return rows.join(blocks.select(*[F.col(c).alias(f"__{c}") for c in _SPLIT], *[c for c in blocks.columns if c not in _SPLIT]), (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block"))).drop("__file", "__block")


def with_state(rows: DataFrame, zero: str, one: str, out: str) -> DataFrame:
    """rows of ``pieces`` with the state that each starts in; a file starts in 0. zero, one: columns as in ``_chained``."""
    rows = cut(_chained(rows, _SPLIT, "place", F.col(zero), F.col(one), "__own"))
    end = F.struct(_pick(F.col("__own.zero"), F.struct(F.col(zero).alias("zero"), F.col(one).alias("one"))).alias("zero"), _pick(F.col("__own.one"), F.struct(F.col(zero).alias("zero"), F.col(one).alias("one"))).alias("one"))
    blocks = rows.groupBy(*_SPLIT).agg(F.max_by(end, "place").alias("end"))
    blocks = _chained(blocks, ("file",), "block", F.col("end.zero"), F.col("end.one"), "__start").select(*_SPLIT, F.col("__start.zero").alias("__start"))
    return _joined(rows, blocks).withColumn(out, _pick(F.col("__start"), F.col("__own"))).drop("__own", "__start")


def with_sum(rows: DataFrame, value: str, out: str) -> DataFrame:
    """rows with the sum of a column over all pieces of the file before each."""
    blocks = rows.groupBy(*_SPLIT).agg(F.sum(value).alias("__n"))
    blocks = blocks.select(*_SPLIT, F.coalesce(F.sum("__n").over(_before("file", order="block")), F.lit(0)).alias("__sum"))
    own = F.coalesce(F.sum(value).over(_before(*_SPLIT, order="place")), F.lit(0))
    return _joined(rows.withColumn("__own", own), blocks).withColumn(out, F.col("__sum") + F.col("__own")).drop("__own", "__sum")


def with_last(rows: DataFrame, value: str, out: str) -> DataFrame:
    """rows with the last value that isn't null, up to and with each."""
    blocks = rows.where(F.col(value).isNotNull()).groupBy(*_SPLIT).agg(F.max_by(value, "place").alias("__v"))
    blocks = rows.select(*_SPLIT).distinct().join(blocks, list(_SPLIT), "left")
    blocks = blocks.select(*_SPLIT, F.last("__v", ignorenulls=True).over(_before("file", order="block")).alias("__earlier"))
    own = F.last(value, ignorenulls=True).over(Window.partitionBy(*_SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return _joined(rows.withColumn("__own", own), blocks).withColumn(out, F.coalesce("__own", "__earlier")).drop("__own", "__earlier")


def _put_together(rows: DataFrame, by: list[str], separator: str) -> DataFrame:
    """(by, piece, head): the pieces of each group in order, and the first one's ``head``, if rows have one."""
    listed = F.array_sort(F.collect_list(F.struct("block", "place", "piece", (F.col("head") if "head" in rows.columns else F.lit(False)).alias("head"))))
    out = rows.groupBy(*by).agg(listed.alias("all"))
    return out.select(*by, F.array_join(F.transform("all", lambda x: x["piece"]), separator).alias("piece"), F.col("all")[0]["head"].alias("head"))


# --- CSV --------------------------------------------------------------------------------------------------------------


def _behind_line(line: Column) -> Column:
    """struct(zero, one): whether quotes are open behind a line that starts outside (zero) or inside of them (one).

    A quote opens at the start of a field only. Inside, it closes unless another one follows at once.
    """
    parts = F.split(line, '"')

    def step(at: Column, text: Column) -> Column:
        comma = text.endswith(",")
        after = lambda s: (
            F.when(s == 1, 2).when(s == 2, F.when((text == "") | comma, 1).otherwise(0)).otherwise(F.when(comma | (text == "") & at["first"], 1).otherwise(0))
        )
        return F.struct(after(at["zero"]).alias("zero"), after(at["one"]).alias("one"), F.lit(False).alias("first"))

    begin = F.struct(F.lit(0).alias("zero"), F.lit(1).alias("one"), F.lit(True).alias("first"))
    done = lambda s: F.when(s == 1, 1).otherwise(0)
    return F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), begin, step, lambda at: F.struct(done(at["zero"]).alias("zero"), done(at["one"]).alias("one")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, record, head): the records of CSV files, line breaks in quotes and all, by where they begin; head: whether it is its file's
    first. Lines end in \\n or \\r\\n.

    Records of one line stay where they are read; only those of several lines are brought together.
    """
    lines = pieces(spark, path, "\n").withColumn("behind", _behind_line(F.col("piece")))
    lines = lines.select("file", "block", "place", "piece", F.col("behind.zero").alias("zero"), F.col("behind.one").alias("one"))
    lines = with_state(lines, "zero", "one", "inside")
    behind = F.when(F.col("inside") == 0, F.col("zero")).otherwise(F.col("one"))
    number = F.row_number().over(Window.partitionBy(*_SPLIT).orderBy("place"))
    lines = lines.withColumns({"behind": behind, "head": (F.col("block") == 0) & (number == 1), "begin": F.when(F.col("inside") == 0, F.struct("block", "place"))})
    short = lines.where("inside = 0 and behind = 0").select("file", "block", "place", "piece", "head")
    long = _put_together(with_last(lines, "begin", "record").where("inside = 1 or behind = 1"), ["file", "record"], "\n")
    both = short.unionByName(long.select("file", "record.block", "record.place", "piece", "head"))
    record = F.regexp_replace(F.col("piece"), r"\r\z", "")
    record = F.when(F.col("head"), F.regexp_replace(record, "^﻿", "")).otherwise(record)
    return both.select("file", "block", "place", record.alias("record"), "head").where("record <> '' or head")


# --- JSON -------------------------------------------------------------------------------------------------------------

_SAME = "\u0001"  # no key of a document: the array stays as it was


def _walked(parts: Column, inside: Column, depth: Column) -> Column:
    """struct(container, at): of a piece that begins outside of elements, the key of the array that it ends in (empty: none, ``_SAME``: as before), and where an object begins in it, from 1."""

    def char(at: Column, c: Column) -> Column:
        opens, closes = c.isin("{", "["), c == "]"
        depth = at["depth"] + opens.cast("int") - closes.cast("int")
        container = F.when((c == "[") & (at["depth"] == 1), at["key"]).when((c == "{") & (at["depth"] == 1) | closes & (depth == 1), F.lit("")).otherwise(at["container"])
        begins = F.when((c == "{") & (at["depth"] == 2), at["place"]).otherwise(at["at"])
        return F.struct(at["outside"].alias("outside"), (at["place"] + 1).alias("place"), depth.alias("depth"), at["key"].alias("key"), container.alias("container"), begins.alias("at"))

    def part(at: Column, text: Column) -> Column:
        walked = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), at, char)
        key = F.when(at["depth"] == 1, text).otherwise(at["key"])
        skipped = F.struct(at["outside"].alias("outside"), (at["place"] + F.length(text)).alias("place"), at["depth"].alias("depth"), key.alias("key"), at["container"].alias("container"), at["at"].alias("at"))
        then = F.when(at["outside"], walked).otherwise(skipped)
        return F.struct((~at["outside"]).alias("outside"), (then["place"] + 1).alias("place"), then["depth"].alias("depth"), then["key"].alias("key"), then["container"].alias("container"), then["at"].alias("at"))

    begin = F.struct((inside == 0).alias("outside"), F.lit(1).alias("place"), depth.cast("int").alias("depth"), F.lit("").alias("key"), F.lit(_SAME).alias("container"), F.lit(None).cast("int").alias("at"))
    return F.aggregate(parts, begin, part, lambda at: F.struct(at["container"].alias("container"), at["at"].alias("at")))


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(key, element): the objects in the arrays right below the top of JSON documents, as JSON text of one line each.

    A piece ends with a closing brace. Quotes that aren't escaped say which are strings; brackets outside of these say how
    deep a piece is. An element of one piece stays where it is read; only nested ones are brought together.
    """
    rows = pieces(spark, path, "}")
    # Escapes as blanks of the same length: what is left of quotes and brackets counts. Raw line breaks lie between tokens only.
    flat = F.translate("piece", "\r\n\t", "   ")
    rows = rows.withColumn("piece", flat).withColumn("parts", F.split(F.regexp_replace("piece", r"\\.", "  "), '"'))
    odd = (F.size("parts") - 1) % 2
    rows = with_state(rows.withColumns({"zero": odd, "one": 1 - odd}), "zero", "one", "inside")
    outside = F.array_join(F.filter("parts", lambda x, i: i % 2 == F.col("inside")), '"')
    closed = F.when(F.col("inside") == 0, F.col("zero")).otherwise(F.col("one")) == 0
    rows = rows.withColumns({"outside": outside, "closed": closed})
    count = lambda c: F.length("outside") - F.length(F.translate("outside", c, ""))
    rows = rows.withColumn("change", count("{[") - count("]") - F.col("closed").cast("int"))
    rows = with_sum(rows, "change", "depth").withColumn("behind", F.col("depth") + F.col("change"))
    next_one = (F.col("depth") == 2) & (F.col("inside") == 0) & F.col("piece").rlike(r"^[\s,]*\{")
    plain = F.struct(F.lit(_SAME).alias("container"), F.when(next_one, F.length("piece") - F.length(F.regexp_replace("piece", r"^[\s,]*", "")) + 1).alias("at"))
    # Deeper than elements begin, unless brackets close that weren't opened in this piece.
    deep = (F.col("depth") >= 3) & ~F.contains(F.regexp_replace("outside", r"\[[^\[\]{]*\]", ""), F.lit("]"))
    rows = rows.withColumn("walked", F.when(deep | next_one, plain).otherwise(_walked(F.col("parts"), F.col("inside"), F.col("depth"))))
    rows = rows.withColumns({"container": F.nullif(F.col("walked.container"), F.lit(_SAME)), "at": F.col("walked.at")}).drop("walked", "parts", "outside", "zero", "one", "inside", "change")
    rows = with_last(rows, "container", "key")
    begins = F.col("at").isNotNull() & (F.coalesce("key", F.lit("")) != "")
    ends = F.col("closed") & (F.col("behind") == 2)
    rows = rows.withColumns({"begins": begins, "ends": ends, "zero": F.when(ends, 0).when(begins, 1).otherwise(0), "one": F.when(ends, 0).otherwise(1)})
    rows = with_state(rows, "zero", "one", "open")
    text = F.when(F.col("begins"), F.substr("piece", F.col("at"), F.length("piece"))).otherwise(F.col("piece"))
    rows = rows.where("open = 1 or begins").withColumns({"piece": text, "begin": F.when(F.col("begins"), F.struct("block", "place"))})
    short = rows.where("begins and ends").select("key", "piece")
    long = with_last(rows, "begin", "record").where("not (begins and ends)")
    long = _put_together(long, ["file", "key", "record"], "}").select("key", "piece")
    return short.unionByName(long).select("key", F.concat("piece", F.lit("}")).alias("element"))


def json_arrays(spark: SparkSession, path: str, keys: tuple[str, ...]) -> tuple[DataFrame, ...]:
    """The objects in these arrays of JSON documents as rows, with all fields that occur. No such objects: no rows, no columns.

    They are written to the shared folder once, a line each, so that their types are found, and they are read, in parallel.
    """
    folder = f"{shared_folder(spark)}/elements-{uuid.uuid4().hex}"
    json_elements(spark, path).where(F.col("key").isin(*keys)).select("key", F.col("element").alias("value")).write.partitionBy("key").text(folder)
    there = spark.read.text(folder)
    found = {r["key"] for r in there.select("key").distinct().collect()} if "key" in there.columns else set()  # of the given keys
    return tuple(spark.read.json(f"{folder}/key={k}") if k in found else spark.createDataFrame([], "struct<>") for k in keys)
