"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

1. A source's target is its share, by weight, of a multiple of all words, but at most ``limit`` times its own words;
   what is cut off is shared again by weight among the others (one line of the table of sources each).
2. A source takes all its documents as often as they fit whole into its target, and the rest from its documents in a
   keyed random order. Documents are placed on that line by counting in two steps of key ranges, then within small
   ranges, so that no task sorts a whole source. Every document copy that is taken is a block; the one that crosses
   the end of the target is cut there, or, if only whole documents are asked for, replaced by the nearest fit.
3. The blocks of all sources are split between the two halves of the output shards, again and again: at each node of
   the tree, how many blocks of each source go left is drawn from the multivariate hypergeometric distribution of
   what the node has, at any size. Quotas are exact: nothing is lost or doubled, and siblings differ by a block at most.
4. A source's blocks, in their random order, are dealt out by these quotas as disjoint runs, and each shard is put
   into an order of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import common

WEIGHTS, SHARE, LIMIT = (3, 1, 2), 1.5, 2.0
#: Words of an output shard, about.
SHARD_WORDS = 1 << 20
#: Key ranges of a source that are counted in each of the two steps.
RANGES = 512
#: Sources up to which their table is broadcast (some 5 MB).
BROADCAST_SOURCES = 50_000
#: The standard deviation from which draws are made by ratio of uniforms, and how often that is tried (each time it succeeds with more than one half).
WIDE_FROM, TRIES = 16.0, 64


def size_of(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


_NULL = "n"


def _key(source: Column) -> Column:
    """A source as a text that is never null, in the same order but for null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(_NULL))


def _source(key: Column) -> Column:
    return F.when(key != _NULL, F.substr(key, F.lit(2)))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, documents, target) of each source of (source, size); sources are keys of ``_key``.

    Sources get the weights in turn, in the order of their code points, null last. The table has one row a source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    in_order = F.row_number().over(Window.orderBy(F.col("source") == _NULL, "source")) - 1
    sources = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (in_order % len(weights) + 1).cast("int")))
    full = F.col("source_size") * F.lit(float(limit))
    sources = sources.withColumns({"full": full, "ratio": full / F.col("weight")})
    # Sources that stop at their limit are those with the smallest limit for their weight: fill them up in that order.
    by_ratio = Window.orderBy("ratio", F.col("source") == _NULL, "source")
    up_to, from_on = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(up_to), F.lit(0.0))
    sources = sources.withColumn("level", left / F.sum("weight").over(from_on))
    # The first source that doesn't reach its limit at its level sets the level of all that follow.
    sources = sources.withColumn("final", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"])
    target = F.when(F.col("final").isNull(), F.col("full")).otherwise(F.least("full", F.col("final") * F.col("weight")))
    return sources.select("source", "source_size", "documents", F.greatest(target, F.lit(0.0)).alias("target"))


def _line(rows: DataFrame) -> DataFrame:
    """rows with ``before``, the words of the source's rows before it, and ``place``, their number, in the order of ``h``."""
    top = F.floor(F.col("h").cast("double") / 2.0**64 * RANGES + RANGES / 2)
    rows = rows.withColumn("r1", F.least(F.greatest(top, F.lit(0)), F.lit(RANGES - 1)).cast("int"))
    rows = rows.withColumn("r2", F.pmod(F.shiftrightunsigned("h", 64 - 18), F.lit(RANGES)).cast("int"))
    # The upper 9 bits of the key (as a signed number) are r1 and the next 9 are r2.
    parts = rows.groupBy("source", "r1", "r2").agg(F.sum("size").alias("w"), F.count("*").alias("c"))
    coarse = parts.groupBy("source", "r1").agg(F.sum("w").alias("w"), F.sum("c").alias("c"))
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    w1 = until(Window.partitionBy("source").orderBy("r1"))
    coarse = coarse.select("source", "r1", F.coalesce(F.sum("w").over(w1), F.lit(0)).alias("w1"), F.coalesce(F.sum("c").over(w1), F.lit(0)).alias("c1"))
    w2 = until(Window.partitionBy("source", "r1").orderBy("r2"))
    fine = parts.select("source", "r1", "r2", F.coalesce(F.sum("w").over(w2), F.lit(0)).alias("w2"), F.coalesce(F.sum("c").over(w2), F.lit(0)).alias("c2"))
    starts = fine.join(coarse, ["source", "r1"]).select("source", "r1", "r2", (F.col("w1") + F.col("w2")).alias("w_"), (F.col("c1") + F.col("c2")).alias("c_"))
    w3 = Window.partitionBy("source", "r1", "r2").orderBy("h", "doc_id", "size", "uid")
    inner = rows.withColumns({"place": F.row_number().over(w3) - 1, "before": F.coalesce(F.sum("size").over(until(w3)), F.lit(0))})
    out = inner.join(starts, ["source", "r1", "r2"])
    return out.withColumns({"before": F.col("before") + F.col("w_"), "place": F.col("place") + F.col("c_")}).drop("r1", "r2", "w_", "c_")


def _log_factorial(n: Column) -> Column:
    """ln n! of a whole double: by table below 16, else by Stirling's series (to 1e-13 of itself)."""
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(16)])
    x = F.greatest(n, F.lit(16.0))
    series = (x + 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 16, F.get(small, n.cast("int"))).otherwise(series)


def _uniform(*seeds: Column) -> Column:
    return (F.pmod(F.xxhash64(*seeds), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _draw(pool: Column, own: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` blocks out of ``pool`` are among ``own`` ones: hypergeometric, by the uniform number u.

    Up to a standard deviation of ``WIDE_FROM`` by inversion: probabilities are added up, from the ratios of neighbouring
    ones, over 64 and ten deviations to either side of the mean (beyond lies less than 1e-30). Above, by ratio of uniforms
    (Stadlober's hat), whose uniform numbers are hashes of u: a point is taken if it lies under the probability of its
    number, by logarithms of factorials. Both are exact but for the rounding of doubles. Always a possible number.
    """
    given = F.struct(pool.cast("double").alias("n"), own.cast("double").alias("k"), drawn.cast("double").alias("m"), u.alias("u"))
    number = common.once(common.once(common.once(given, _moments), _window), lambda d: F.when(d["spread"] < WIDE_FROM, _inverted(d)).otherwise(_tried(d)))
    return F.when((own == 0) | (drawn == 0), F.lit(0).cast("long")).when(own == pool, drawn).when(drawn == pool, own).otherwise(number)


def _moments(g: Column) -> Column:
    """n, k, m and u with mean, standard deviation and the smallest and largest number there is."""
    n, k, m = g["n"], g["k"], g["m"]
    variance = m * (k / n) * (1 - k / n) * (n - m) / F.greatest(n - 1, F.lit(1.0))
    return F.struct(
        n.alias("n"), k.alias("k"), m.alias("m"), g["u"].alias("u"), (m * k / n).alias("mean"), F.sqrt(F.greatest(F.lit(0.0), variance)).alias("spread"),
        F.greatest(F.lit(0.0), m - (n - k)).alias("least"), F.least(k, m).alias("most"),
    )


def _window(d: Column) -> Column:
    """The same with the ends of the window of the inversion, the mode, and the width of the hat."""
    reach = 64 + 10 * d["spread"]
    width = 2 * math.sqrt(2 / math.e) * F.sqrt(d["spread"] * d["spread"] + 0.5) + (3 - 2 * math.sqrt(3 / math.e))
    return F.struct(
        *[d[x].alias(x) for x in ("n", "k", "m", "u", "mean", "spread", "least", "most")], F.greatest(d["least"], F.floor(d["mean"] - reach)).alias("low"),
        F.least(d["most"], F.ceil(d["mean"] + reach)).alias("high"), F.least(d["most"], F.greatest(d["least"], F.floor((d["m"] + 1) * (d["k"] + 1) / (d["n"] + 2)))).alias("mode"),
        width.alias("width"),
    )


def _inverted(d: Column) -> Column:
    """The first number up to which the probabilities reach u. Weights are relative to that of the window's first number,
    and as large as exp(150) at most: well inside a double."""
    ratio = lambda x: F.greatest((d["k"] - x) * (d["m"] - x) / ((x + 1) * (d["n"] - d["k"] - d["m"] + x + 1)), F.lit(0.0))
    steps = F.sequence(d["low"].cast("long"), d["high"].cast("long"))
    added = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum")), lambda a, x: F.struct((a["p"] * ratio(x.cast("double"))).alias("p"), (a["sum"] + a["p"]).alias("sum")), lambda a: a["sum"]
    )
    start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("at"), (d["u"] * added).alias("goal"))
    found = F.aggregate(
        steps, start,
        lambda a, x: F.struct(
            (a["p"] * ratio(x.cast("double"))).alias("p"), (a["sum"] + a["p"]).alias("sum"), F.coalesce(a["at"], F.when(a["sum"] + a["p"] >= a["goal"], x)).alias("at"), a["goal"].alias("goal")
        ),
        lambda a: a["at"],
    )
    return F.coalesce(found, d["high"].cast("long"))


def _tried(d: Column) -> Column:
    """The number of the first random point under its probability; the mode, should there be none among ``TRIES`` points."""
    # The logarithm of a number's probability, but for what is the same for all numbers.
    weight = lambda x: -(_log_factorial(x) + _log_factorial(d["k"] - x) + _log_factorial(d["m"] - x) + _log_factorial(d["n"] - d["k"] - d["m"] + x))

    def point(a: Column, i: Column) -> Column:
        x, y = _uniform(d["u"], i, F.lit(0)), _uniform(d["u"], i, F.lit(1))
        return F.struct(x.alias("x"), F.floor(d["mean"] + 0.5 + d["width"] * (y - 0.5) / x).cast("double").alias("at"), a["top"].alias("top"))

    def judged(p: Column) -> Column:
        inside = (p["at"] >= d["least"]) & (p["at"] <= d["most"])
        under = F.when(inside, 2 * F.ln(p["x"]) <= weight(F.least(d["most"], F.greatest(d["least"], p["at"]))) - p["top"]).otherwise(F.lit(False))
        return F.struct(F.when(under, p["at"].cast("long")).alias("at"), p["top"].alias("top"))

    start = F.struct(F.lit(None).cast("long").alias("at"), weight(d["mode"]).alias("top"))
    step = lambda a, i: F.when(a["at"].isNotNull(), a).otherwise(common.once(point(a, i), judged))
    return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), start, step, lambda a: a["at"]), d["mode"].cast("long"))


def quotas(sources: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source, shard, start, blocks): which run of each source's blocks goes to each of 2**depth shards.

    sources: (source, blocks), one row a source. The tree's nodes are rows with an array of the sources' counts, and
    become two rows each, level by level; nothing is shuffled.
    """
    entry = F.struct("source", F.lit(0).cast("long").alias("start"), "blocks")
    nodes = sources.agg(F.sort_array(F.collect_list(entry)).alias("own")).withColumn("shard", F.lit(0).cast("long"))
    for level in range(depth):
        if level == 8:
            nodes = nodes.repartition(256, "shard")
        total = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["blocks"])
        nodes = nodes.withColumn("total", total)
        u = lambda i: (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "shard", i), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)  # noqa: B023, E731
        # Source after source: what the node has left to draw from, what is left to draw, and the draws so far.
        begin = F.struct(
            F.col("total").alias("pool"), F.floor((F.col("total") + F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "shard"), F.lit(2))) / 2).cast("long").alias("drawn"),
            F.array().cast("array<bigint>").alias("got"),
        )
        one = lambda a, x: F.struct(
            (a["pool"] - x["blocks"]).alias("pool"), a["drawn"].alias("drawn"),
            F.concat(a["got"], F.array(_draw(a["pool"], x["blocks"], a["drawn"], u(F.size(a["got"]))))).alias("got"),
        )
        two = lambda a: F.struct(a["pool"].alias("pool"), (a["drawn"] - F.element_at(a["got"], -1)).alias("drawn"), a["got"].alias("got"))
        nodes = nodes.withColumn("left", F.aggregate("own", begin, lambda a, x: common.once(one(a, x), two), lambda a: a["got"]))
        sides = F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.zip_with("own", "left", lambda x, n: F.struct(x["source"].alias("source"), x["start"].alias("start"), n.alias("blocks"))).alias("own")),
            F.struct(
                (F.col("shard") * 2 + 1).alias("shard"),
                F.zip_with("own", "left", lambda x, n: F.struct(x["source"].alias("source"), (x["start"] + n).alias("start"), (x["blocks"] - n).alias("blocks"))).alias("own"),
            ),
        )
        nodes = nodes.select(F.explode(sides).alias("side")).select("side.own", "side.shard")
    return nodes.select("shard", F.explode("own").alias("x")).select("x.source", "shard", "x.start", "x.blocks").where("blocks > 0")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 42, shard_words: int = SHARD_WORDS, whole: bool = False,
    row: str | None = None,
) -> DataFrame:
    """The blocks of the mix: a row for each copy of a row of ``docs`` that is taken, and one without a shard for others.

    docs: (doc_id, text, source) and any other columns, which are not looked at. Returns doc_id, source, size,
    source_size, target, place (the row's number in its source's order), copy (0, 1, ...), words (those taken of this
    copy: its first ones), shard and position. A source's words add up to its target, rounded; with ``whole`` a copy
    is taken whole or not at all, and the words come as near to the target as the order and one more document allow.
    row: a column (long) that tells apart rows whose doc_id doesn't; it is returned as ``row``.
    Null and wordless texts have size 0 and are never taken. Null sources are one source, repeated rows and null
    doc_ids are rows like any other. Equal input gives equal output, but for which of two rows of one doc_id and size
    comes first. Empty table: no rows.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("source")).alias("source"), size_of(F.col("text").cast("string")).alias("size"),
        # Rows without an id would all stand at one place.
        F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("uid") if row is None else F.col(row).cast("long").alias("uid"),
    )
    sized = common.cut(sized.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size", "uid")))
    of_source = common.cut(targets(sized, weights, share, limit))
    # A table with a row a source is sent to all tasks while it is small, and joined like any other beyond.
    small = F.broadcast if of_source.count() <= BROADCAST_SOURCES else lambda df: df
    of_source = of_source.withColumn("goal", F.round("target").cast("long"))
    of_source = of_source.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0).cast("long"))
    of_source = of_source.withColumn("rest", F.col("goal") - F.col("copies") * F.col("source_size"))
    rows = _line(sized).join(small(of_source), "source").drop("h")
    rows = rows.withColumn("part", F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("size")))
    if whole:
        rows = common.cut(rows)
        # The document that crosses the end is left out, and of all that are not taken the one whose size is nearest to the gap comes in.
        gaps = rows.where("part < size and part > 0").select("source", F.col("part").alias("gap"))
        near = rows.where("size > 0 and part < size").join(small(gaps), "source").withColumn("off", F.abs(F.col("size") - F.col("gap"))).where("off < gap")
        chosen = near.groupBy("source").agg(F.min(F.struct("off", "place")).alias("x")).select("source", F.col("x.place").alias("place"), F.lit(True).alias("comes"))
        rows = rows.join(small(chosen), ["source", "place"], "left")
        rows = rows.withColumn("part", F.when(F.col("comes") | (F.col("part") == F.col("size")), F.col("size")).otherwise(0)).drop("comes")
    rows = rows.withColumn("taken", F.when(F.col("size") > 0, F.col("copies")).otherwise(0) + (F.col("part") > 0).cast("long"))
    copies = F.when(F.col("taken") > 0, F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).otherwise(F.array(F.lit(None).cast("long")))
    blocks = rows.withColumn("copy", F.explode(copies))
    blocks = blocks.withColumn("words", F.when(F.col("copy").isNull(), 0).when(F.col("copy") < F.col("copies"), F.col("size")).otherwise(F.col("part")).cast("long"))
    blocks = common.cut(blocks.select("doc_id", "uid", "source", "size", "source_size", "target", "place", "copy", "words"))
    taken = blocks.where("copy is not null")
    counts = taken.groupBy("source").agg(F.count("*").alias("blocks"))
    total = blocks.agg(F.sum("words")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / shard_words))))
    plan = quotas(counts, depth, seed + 2)
    # Runs are cut into pieces of about their own width, so that a block finds its run by an equality.
    width = counts.select("source", F.greatest(F.lit(1), F.floor(F.col("blocks") / (1 << depth))).alias("width"))
    plan = plan.join(small(width), "source")
    plan = plan.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / F.col("width")), F.floor((F.col("start") + F.col("blocks") - 1) / F.col("width")))))
    plan = plan.select("source", "bin", "shard", "start", "blocks")
    # Blocks get a random order of their own, in which the runs are dealt out.
    deal = F.xxhash64(F.lit(seed + 1), "doc_id", "size", "copy", "place")
    kept = F.struct("size", "source_size", "target", F.col("place").alias("row"), "copy", "words").alias("kept")
    lined = _line(taken.select("doc_id", "uid", "source", kept, F.lit(1).cast("long").alias("size"), deal.alias("h")))
    lined = lined.join(small(width), "source").withColumn("bin", F.floor(F.col("place") / F.col("width")))
    dealt = lined.join(plan, ["source", "bin"]).where("place >= start and place < start + blocks")
    inside = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 3), "doc_id", "kept.copy", "kept.row"), "source", "kept.row", "kept.copy")
    dealt = dealt.withColumn("position", (F.row_number().over(inside) - 1).cast("long"))
    names = ["doc_id", *(["uid"] if row else []), "source", "size", "source_size", "target", "place", "copy", "words", "shard", "position"]
    dealt = dealt.select("doc_id", "uid", "source", "kept.size", "kept.source_size", "kept.target", F.col("kept.row").alias("place"), "kept.copy", "kept.words", "shard", "position")
    others = blocks.where("copy is null").withColumns({"shard": F.lit(None).cast("long"), "position": F.lit(None).cast("long")})
    out = dealt.unionByName(others).withColumn("source", _source(F.col("source"))).select(*names)
    return out.withColumnRenamed("uid", "row") if row else out


def taken_words(blocks: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of each row of the mixed documents."""
    one = blocks.groupBy("doc_id", "source", "place", "size", "source_size", "target").agg(
        F.sum("words").cast("long").alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards")
    )
    return one.select("doc_id", "size", "source_size", "target", "taken", "shards")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them, whole documents only.

    Each row is taken or left on its own: rows with a null doc_id, and those that share one, are numbered for that.
    """
    odd_id, uid, mixed, n, copy = (common.fresh(docs, x) for x in ("__again", "__row", "__mixed", "__times", "__copy"))
    own = F.col("doc_id").cast("long")
    again = common.cut(docs.select(own.alias(odd_id)).where(F.col(odd_id).isNotNull()).groupBy(odd_id).agg(F.count("*").alias("n")).where("n > 1").select(odd_id))
    plain, odd = docs.where(own.isNotNull()), docs.where(own.isNull())
    if not again.isEmpty():
        odd = odd.unionByName(docs.join(again, own == F.col(odd_id), "left_semi"))
        plain = plain.join(again, own == F.col(odd_id), "left_anti")
    odd = common.cut(odd.withColumn(uid, F.monotonically_increasing_id()))
    slim = lambda rows, number: rows.select(own.alias("doc_id"), "source", "text", number.alias("row"))
    blocks = mix(slim(plain, F.lit(None).cast("long")).union(slim(odd, F.col(uid))), whole=True, row="row", **how)
    times = common.cut(blocks.where("copy is not null").groupBy("doc_id", "row").agg(F.count("*").cast("int").alias(n)))
    names = [F.col(f"`{c}`") for c in docs.columns]
    one = plain.join(times.where("row is null").select(F.col("doc_id").alias(mixed), n), own == F.col(mixed))
    two = odd.join(times.where("row is not null").select(F.col("row").alias(mixed), n), F.col(uid) == F.col(mixed))
    joined = one.select(*names, n).union(two.select(*names, n))
    return joined.select(*names, F.explode(F.sequence(F.lit(1), F.col(n))).alias(copy)).select(*names)
