"""Embedding near-duplicates: tiles compared along principal axes, leading ones first.

The principal axes of the unit vectors come from sums over all rows (one small matrix for each partition, added up
before it reaches the driver, which gets dimension squared numbers). Vectors of one label are ordered along the first
axis into ranges, and each range is dealt into blocks of bounded size; a pair of blocks is a tile. Similar vectors lie
near each other on every axis, so tiles of blocks that lie apart on the first one are never made. A tile is compared in
parts: each adds up the products over the leading axes, bounds what the other axes can add by the product of the two
suffix norms, and goes on only with pairs that can still reach the threshold; those that reach it are confirmed on the
original vectors. A tile returns, for each of its rows with links, their number and one link to the smallest vector it
is connected to: pairs are never rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common, vectors

#: Numbers in a block of vectors, at most (8 MB); a tile holds two blocks. Rows of a part that is compared at a time.
BLOCK_NUMBERS, PART = 1 << 20, 1024
#: Ranges along the first axis, at most.
RANGES = 256
#: Labels of several blocks up to which their tables are sent to the rows (some 10 MB), so that no label's rows meet in one task.
BROADCAST_LABELS = 1000
#: Axes that are added up between two looks at the bound.
STEP = 16


def _moments(batches):
    for rows in batches:
        if not len(rows):
            continue
        x = vectors.normalised(vectors.matrix(rows["v"]))
        yield pd.DataFrame({"at": np.arange(x.shape[1] ** 2), "x": (x.T @ x).ravel()})


def axes(rows: DataFrame, size: int) -> np.ndarray:
    """Columns: the principal axes of the unit vectors of that length, largest second moment first."""
    part = rows.where(F.col("size") == size).select("v").mapInPandas(_moments, "at long, x double")
    flat = np.zeros(size * size)
    for at, x in part.groupBy("at").agg(F.sum("x")).collect():
        flat[at] = x
    _, found = np.linalg.eigh(flat.reshape(size, size))
    return found[:, ::-1]


def close_pairs(a: np.ndarray, b: np.ndarray, at_least: float, basis: np.ndarray) -> np.ndarray:
    """Boolean matrix: which rows of a and b (original vectors) have a cosine of ``at_least`` or more."""
    ua, ub = vectors.normalised(a), vectors.normalised(b)
    ra, rb = ua @ basis, ub @ basis
    left = lambda r: np.sqrt(np.maximum(0, np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1]))
    sa, sb = left(ra), left(rb)
    dims, total = basis.shape[1], np.zeros((len(a), len(b)))
    out = np.zeros((len(a), len(b)), dtype=bool)
    for start in range(0, dims, STEP):
        end = min(dims, start + STEP)
        total += ra[:, start:end] @ rb[:, start:end].T
        rest = sa[:, end][:, None] * sb[:, end][None, :] if end < dims else 0.0
        alive = total + rest >= at_least - 1e-9
        i, j = np.nonzero(alive)
        if len(i) * 8 < alive.size or end == dims:
            # Few are left: finish them one by one on the unit vectors themselves.
            for k in range(0, len(i), 65536):
                x, y = i[k : k + 65536], j[k : k + 65536]
                good = np.einsum("ij,ij->i", ua[x], ub[y]) >= at_least
                out[x[good], y[good]] = True
            break
    return out


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows is connected to by the links a - b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (a, b):
            np.minimum.at(label, before[end], least)
            np.minimum.at(label, end, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _tile(at_least: float, basis_of):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["vec_id", "uid"], kind="stable")
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        x, block, ids = vectors.matrix(rows["v"]), rows["block"].to_numpy(), rows["vec_id"].to_numpy()
        basis = basis_of[x.shape[1]]
        one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
        count, ends = np.zeros(len(rows), dtype=np.int64), [np.zeros((2, 0), dtype=np.int64)]
        for i in range(0, len(one), PART):
            for j in range(i if low == high else 0, len(two), PART):
                p, q = one[i : i + PART], two[j : j + PART]
                near = close_pairs(x[p], x[q], at_least, basis)
                if low == high and i == j:
                    near |= near.T
                    np.fill_diagonal(near, False)
                else:
                    count[q] += near.sum(axis=0)
                count[p] += near.sum(axis=1)
                mine, theirs = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                if len(mine):
                    size = len(mine) + len(theirs)
                    linked = np.zeros((size, size), dtype=bool)
                    linked[: len(mine), len(mine) :] = near[np.ix_(mine, theirs)]
                    linked[len(mine) :, : len(mine)] = linked[: len(mine), len(mine) :].T
                    rows_of = np.concatenate([p[mine], q[theirs]])
                    ends.append(np.stack([rows_of, rows_of[common.local_components(linked)]]))
        a, b = np.concatenate(ends, axis=1)
        root = joined(len(rows), a, b)
        some = count > 0
        return pd.DataFrame({"uid": rows["uid"].to_numpy()[some], "n": count[some], "a": ids[some], "b": ids[root[some]]})

    return run


def _leading(basis_of):
    def run(batches):
        for rows in batches:
            at = np.zeros(len(rows))
            for size in rows["size"].unique():
                some = np.flatnonzero(rows["size"] == size)
                at[some] = vectors.normalised(vectors.matrix(rows["v"].iloc[some])) @ basis_of[size][:, 0]
            yield pd.DataFrame({"uid": rows["uid"], "lead": at})

    return run


def _apart(valid: DataFrame, large: DataFrame, sent, basis_of, at_least: float) -> DataFrame:
    """(label, size, block, other, uid, vec_id, v): the rows of labels with several blocks, once for each block they meet."""
    rows = valid.join(sent(large), ["label", "size"])
    lead = rows.select("uid", "v", "size").mapInPandas(_leading(basis_of), "uid long, lead double")
    rows = common.cut(rows.join(lead, "uid"))
    cuts = rows.groupBy("label", "size").agg(F.max("ranges").alias("k"), F.percentile_approx("lead", [i / RANGES for i in range(1, RANGES)], 10_000).alias("q"))
    # Every (RANGES / k)th of the quantiles, each only once: equal ones would leave ranges empty.
    cuts = cuts.select("label", "size", F.array_distinct(F.filter("q", lambda _, i: F.floor((i + 1) * F.col("k") / RANGES) > F.floor(i * F.col("k") / RANGES))).alias("q"))
    rows = rows.join(sent(cuts), ["label", "size"]).withColumn("range", F.size(F.filter("q", lambda c: c <= F.col("lead"))))
    whole = rows.groupBy("label", "size", "range").agg(F.count("*").alias("n"), F.min("lead").alias("least"), F.max("lead").alias("most"))
    whole = whole.withColumn("parts", F.ceil(F.col("n") * F.col("size") / BLOCK_NUMBERS).cast("int"))
    every = whole.groupBy("label", "size").agg(F.array_sort(F.collect_list(F.struct("range", "least", "most", "parts"))).alias("all"))
    every = every.withColumn("before", F.transform("all", lambda x, i: F.aggregate(F.slice("all", F.lit(1), i), F.lit(0), lambda a, y: a + y["parts"])))
    # Vectors of a cosine of at_least are no farther apart than this, on every axis.
    reach = float(np.sqrt(max(0.0, 2 - 2 * at_least))) + 1e-9
    own = F.col("all")[F.col("place")]
    near = F.transform("all", lambda y, i: F.when((y["least"] <= own["most"] + reach) & (y["most"] >= own["least"] - reach), F.sequence(F.element_at("before", i + 1), F.element_at("before", i + 1) + y["parts"] - 1)))
    met = every.select("label", "size", "all", "before", F.explode(F.sequence(F.lit(0), F.size("all") - 1)).alias("place"))
    met = met.select("label", "size", own["range"].alias("range"), own["parts"].alias("parts"), F.col("before")[F.col("place")].alias("first"), F.flatten(F.filter(near, lambda x: x.isNotNull())).alias("others"))
    dealt = rows.join(sent(met), ["label", "size", "range"]).withColumn("block", (F.col("first") + F.pmod(F.xxhash64("uid"), F.col("parts"))).cast("int"))
    return dealt.select("label", "size", "block", F.explode("others").alias("other"), "uid", "vec_id", "v")


def near_vectors(rows: DataFrame, at_least: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label) and any other columns.

    Two vectors link if their labels are equal and not null, they are equally long and their cosine, in double
    precision, is at least ``at_least``. Vectors that are null, empty, zero or hold null or non-finite components, and
    rows with a null vec_id, link with nothing; without a vec_id the component is null and the row is kept. Rows that
    share a vec_id are compared as rows of their own (their links count each other) and share a component. Empty
    table: no rows. Other columns are not looked at.
    """
    spark = rows.sparkSession
    common.small_batches(spark, 4096)
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(vectors.kept_type(rows, "embedding")).alias("v"), F.col("label").alias("label")
    ).withColumn("uid", F.monotonically_increasing_id())
    rows = common.cut(rows.withColumn("ok", vectors.usable("v") & F.col("vec_id").isNotNull() & F.col("label").isNotNull()))
    valid = rows.where("ok").withColumn("size", F.size("v"))
    groups = valid.groupBy("label", "size").agg(F.count("*").alias("n")).where("n > 1")
    sizes = [r[0] for r in groups.select("size").distinct().collect()]
    basis_of = {size: axes(valid, size) for size in sizes}
    # Where a label's vectors are cut into ranges along the first axis; within a range, blocks are dealt by hash.
    blocks = F.ceil(F.col("n") * F.col("size") / BLOCK_NUMBERS).cast("int")
    large = groups.select("label", "size", "n", F.least(blocks, F.lit(RANGES)).alias("ranges")).where("ranges > 1")
    large = common.cut(large)
    several = large.count()
    sent = F.broadcast if several <= BROADCAST_LABELS else lambda df: df
    rest = valid.join(sent(large.select("label", "size")), ["label", "size"], "left_anti") if several else valid
    small = rest.join(groups.where(blocks == 1).select("label", "size"), ["label", "size"]).select("label", "size", F.lit(0).alias("block"), F.lit(0).alias("other"), "uid", "vec_id", "v")
    tiles = small.unionByName(_apart(valid, large, sent, basis_of, at_least)) if several else small
    tiles = tiles.select("label", "size", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "uid", "vec_id", "v")
    found = common.cut(tiles.groupBy("label", "size", "low", "high").applyInPandas(_tile(at_least, basis_of), "uid long, n long, a long, b long"))
    counts = found.groupBy("uid").agg(F.sum("n").alias("n"))
    named = common.components(found.select("a", "b"))
    out = rows.select("uid", "vec_id").join(counts, "uid", "left").join(named, F.col("vec_id") == F.col("node"), "left")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
