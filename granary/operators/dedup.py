"""Exact and near duplicates, and what becomes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import hashing
from granary.lineage import cut
from granary.operators.ranks import numbered


def ranked(assets: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """assets with ``duplicate_rank`` within their content, and ``duplicate_role`` (the first is canonical). A content may have any number of copies."""
    assets = numbered(assets, [key], order, "duplicate_rank").withColumn("duplicate_rank", F.col("duplicate_rank").cast("int"))
    return assets.withColumn("duplicate_role", F.when(F.col("duplicate_rank") == 1, F.lit("canonical")).otherwise("duplicate"))


def kept_rows(assets: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row of each content: the first in that order, which has to end in something unique.

    An aggregate, not a window: copies are reduced before the shuffle, however many there are.
    """
    whole = F.struct(*[F.col(c) for c in assets.columns])
    best = assets.groupBy(key).agg(F.min_by(whole, F.struct(*order)).alias("kept"))
    return best.select("kept.*")


def duplicates_report(assets: DataFrame, key: str, id_column: str, order: list[Column]) -> DataFrame:
    """(key, kept, dropped): each row that isn't kept, with the one that is."""
    kept = kept_rows(assets.select(key, id_column, *[o.alias(f"o{i}") for i, o in enumerate(order)]), key, [F.col(f"o{i}") for i in range(len(order))])
    kept = kept.select(F.col(key), F.col(id_column).alias("kept"))
    return assets.select(key, F.col(id_column).alias("dropped")).join(kept, key).where("dropped <> kept").select(key, "kept", "dropped")


def groups_with_keeper(assets: DataFrame, key: str, id_column: str, order: list[Column]) -> DataFrame:
    """(key, keeper, removed, n): contents with several assets, the one that stays, and the sorted others."""
    every = assets.groupBy(key).agg(F.min_by(id_column, F.struct(*order)).alias("keeper"), F.array_sort(F.collect_list(id_column)).alias("ids"), F.count("*").alias("n"))
    return every.where("n > 1").select(key, "keeper", F.array_except("ids", F.array("keeper")).alias("removed"), "n")


def merged_payload(assets: DataFrame, key: str, order: list[Column], payload: str, label: str, status: str) -> DataFrame:
    """One row of each content, with the distinct payload entries of all its assets in order.

    payload: an array column. label: ``mixed`` if there are several. status: all of them, sorted, joined by ``|``. Copies
    are reduced before the shuffle, to the first place of each distinct entry.
    """
    placed = assets.select(key, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), F.posexplode(payload).alias("at", "x"))
    first = placed.groupBy(key, "x").agg(F.min(F.struct("o", "at")).alias("first"))
    entries = first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "x"))), lambda e: e["x"]).alias("all"))
    out = assets.groupBy(key).agg(F.min(label).alias("one"), F.max(label).alias("other"), F.array_sort(F.collect_set(status)).alias("statuses"))
    none = F.array().cast(assets.schema[payload].dataType)
    return out.join(entries.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key")), "left").select(
        key, F.coalesce("all", none).alias(payload), F.when(F.col("one") != F.col("other"), F.lit("mixed")).otherwise(F.col("one")).alias(label),
        F.array_join("statuses", "|").alias(status),
    )


def first_writer(rows: DataFrame, key: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Of several producers' rows of a key the first stays, by an order that ends in something unique; the others are returned beside it."""
    place = F.struct(*order)
    first = rows.groupBy(F.col(key).alias("__key")).agg(F.min(place).alias("__first"))
    others = rows.join(first, F.col(key).eqNullSafe(F.col("__key"))).where(place != F.col("__first")).drop("__key", "__first")
    return kept_rows(rows, key, order), others


def bands(bits: int, at_most: int, rows: int = 1 << 16, most_probes: int = 1024) -> list[tuple[int, int, int]]:
    """(start, width, radius) of bands of so many bits, such that two rows that differ in ``at_most`` bits agree within the radius of one band.

    With m bands and at_most = m * r + a, a + 1 bands need radius r and the others r - 1; bands whose radius is below 0 are
    left out. m is the one that costs least for buckets of so many rows: keys that a row is looked up under, and rows that
    it meets there if bits are even.
    """
    from math import comb

    best = None
    for m in range(2, max(2, min(bits, at_most + 1)) + 1):
        cuts = [i * bits // m for i in range(m + 1)]
        r, a = divmod(at_most, m)
        found = [(s, e - s, r - (i > a)) for i, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)) if r - (i > a) >= 0]
        keys = [sum(comb(w, k) for k in range(min(radius, w) + 1)) for _, w, radius in found]
        cost = sum(keys) + rows * sum(n / 2**w for n, (_, w, _) in zip(keys, found, strict=True))
        if sum(keys) <= most_probes and (best is None or cost < best[0]):
            best = (cost, found)
    if best is None:  # so wide a radius that any number of bands has too many keys: one bit each, on which such pairs can't but agree
        return [(i, 1, 0) for i in range(min(bits, at_most + 1))]
    return best[1]


def _masks(width: int, radius: int) -> list[int]:
    """All numbers of so many bits of which at most ``radius`` are set."""
    from itertools import combinations

    return [sum(1 << i for i in ones) for k in range(min(radius, width) + 1) for ones in combinations(range(width), k)]


def similar_pairs(hashes: DataFrame, id_column: str, hash_column: str, prefix: int = 4, at_most: int = 5) -> DataFrame:
    """(a, b, distance): pairs a < b of one hash prefix that differ in so many bits at most.

    Multi-index hashing: what follows the prefix is cut into ``bands``. Each row stands under its key in each band, and is
    looked up under all keys within the band's radius, so that rows that can't be near in any band never meet, whatever
    the number of bits. A pair counts in the first band that it agrees in, so none is found twice. Spark guesses sizes
    from before rows are multiplied, so joins are told not to send a side to the driver for all. Texts that aren't 16
    hexadecimal digits are near to equal ones only; null hashes and ids are near to nothing.
    """
    bits = 64 - 4 * prefix
    plan = bands(bits, at_most) if bits else [(0, 1, 0)]  # no bits are left: equal hashes only
    own = hashes.select(F.col(id_column).alias("a"), F.col(hash_column).alias("ha"), F.substr(F.col(hash_column), F.lit(1), F.lit(prefix)).alias("bucket"))
    shaped = F.col("ha").rlike("^[0-9a-fA-F]{16}$") & F.lit(bits > 0)
    odd = own.where(~shaped)
    same = odd.join(odd.select(F.col("a").alias("b"), "ha").hint("merge"), "ha").where("a < b").select("a", "b", F.lit(0).alias("distance"))
    text = hashing.bits_of(F.substr(F.col("ha"), F.lit(prefix + 1), F.lit(16)))
    own = own.where(shaped).withColumn("bits", text)
    own = own.withColumn("ka", F.array(*[F.conv(F.substr("bits", F.lit(s + 1), F.lit(w)), 2, 10).cast("long") for s, w, _ in plan])).drop("bits")
    stored = own.select(F.col("a").alias("b"), F.col("ha").alias("hb"), F.col("ka").alias("kb"), "bucket", F.posexplode("ka").alias("band", "key"))

    def keys(i: int, width: int, radius: int) -> Column:
        return F.transform(F.lit(_masks(width, radius)), lambda x: F.get("ka", F.lit(i)).bitwiseXOR(x.cast("long")))

    probes = F.array(*[keys(i, w, r) for i, (_, w, r) in enumerate(plan)])
    looked_up = own.select("a", "ha", "ka", "bucket", F.posexplode(probes).alias("band", "keys")).select("a", "ha", "ka", "bucket", "band", F.explode("keys").alias("key"))
    met = looked_up.join(stored.hint("merge"), ["bucket", "band", "key"]).where("a < b")
    before = F.lit(False)
    for i, (_, _, r) in enumerate(plan):
        agrees = F.bit_count(F.get("ka", F.lit(i)).bitwiseXOR(F.get("kb", F.lit(i)))) <= r
        before = before | (F.lit(i) < F.col("band")) & agrees
    distance = F.lit(0)
    for start in (1, 9):
        distance = distance + F.bit_count(hashing.half(F.col("ha"), start).bitwiseXOR(hashing.half(F.col("hb"), start)))
    near = met.where(~before).select("a", "b", distance.cast("int").alias("distance")).where(F.col("distance") <= at_most)
    return near.unionByName(same)


def leaders(hashes: DataFrame, id_column: str, hash_column: str, prefix: int = 4, at_most: int = 5) -> DataFrame:
    """(id, group_id): each row joins the first leader of its bucket that is near enough, in order of ids, or leads.

    A group is named by twelve digits of its leader's hash, so two leaders that share these are one group. Rows of one
    hash share their group, so the first stands for them; what is no hash has no group.

    The leaders are the first independent set of the near pairs, in order: a row leads if all its earlier neighbours
    follow, and follows if one of them leads. Rounds of joins settle all rows of which that is known: those without an
    unsettled earlier neighbour lead, and their later neighbours follow. Few rounds settle rows whose ids say nothing about
    likeness; a chain of rows that are near to the one before them only, in order of ids, takes a round for every second.
    """
    rows = hashes.select(F.col(id_column).cast("string").alias("id"), F.col(hash_column).alias("hash")).where(F.col("hash").rlike("^[0-9a-f]{16}$"))
    first = rows.groupBy("hash").agg(F.struct(F.min("id").alias("id"), F.col("hash").alias("hash")).alias("row"))
    edges = cut(similar_pairs(first, "row", "hash", prefix, at_most).select("a", "b"))
    left, follows = edges, edges.select(F.col("b").alias("row")).limit(0)
    while not left.isEmpty():
        leads = left.select("a").distinct().join(left.select(F.col("b").alias("a")).hint("merge"), "a", "left_anti")
        lost = cut(left.join(leads.hint("merge"), "a", "left_semi").select("b").distinct())
        follows = follows.union(lost.withColumnRenamed("b", "row"))
        settled = left.join(leads.hint("merge"), "a", "left_anti").join(lost.hint("merge"), "b", "left_anti")
        left = cut(settled.join(lost.withColumnRenamed("b", "a").hint("merge"), "a", "left_anti").select("a", "b"))
    led = edges.join(follows.withColumnRenamed("row", "a").hint("merge"), "a", "left_anti").groupBy(F.col("b").alias("row")).agg(F.min("a").alias("leader"))
    # A row that leads has no leader among its earlier neighbours.
    groups = first.join(led.hint("merge"), "row", "left").select("hash", F.concat(F.lit("near_"), F.substr(F.coalesce("leader.hash", "hash"), F.lit(1), F.lit(12))).alias("group_id"))
    return rows.join(groups.hint("merge"), "hash").select("id", "group_id")
