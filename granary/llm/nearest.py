"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree's upper levels are fitted on the driver from at most ``SAMPLE`` vectors (those with the smallest hash). Leaves
that would hold more than ``LARGE`` rows of the table are split again, all at a time, each by a task from some ``FIT`` of
its own rows, until none is left or the tree has ``MOST_LEAVES``; so leaves don't grow with the table before it has
LARGE * MOST_LEAVES rows. Every row is then put into its leaf. A search keeps the tree's nodes in a priority queue by their centre's cosine with the query,
always opens the best one, and visits the leaves it meets. How many leaves a search visits is calibrated: it is
widened until queries of the sample find ``RECALL`` of their true neighbours in the sample, and each search goes on
until it has seen at least ``LEAST`` rows. Leaves are gathered into bundles of about ``BUNDLE`` rows, a larger leaf is
split over several bundles, and queries meet the rows of a bundle in blocks, so no task depends on one leaf's size.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import common, vectors

SAMPLE, LEAF, BRANCHES = 16_384, 64, 8
RECALL, CALIBRATION_QUERIES, LEAST = 0.98, 256, 256
BUNDLE, QUERY_BLOCK = 2048, 2048
LARGE, FIT, FAN, MOST_LEAVES = 4096, 2048, 16, 16_384


@dataclass
class Tree:
    """Nodes by number: their centres, and their children or their leaf's number."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centres) - 1


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: the cluster of each row. Empty clusters are left out."""
    centres = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros((k, x.shape[1]))
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return own


def fit(x: np.ndarray, leaf: int = LEAF, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """The tree of unit vectors x."""
    tree, rng = Tree(), np.random.default_rng(seed)

    def grow(rows: np.ndarray) -> int:
        mean = x[rows].mean(axis=0)
        node = tree.add(mean / max(np.linalg.norm(mean), 1e-300))
        parts = []
        if len(rows) > leaf:
            own = k_means(x[rows], branches, rng)
            parts = [p for p in (rows[own == i] for i in range(branches)) if len(p)]
        if len(parts) > 1:
            tree.children[node] = [grow(p) for p in parts]
        else:
            tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
        return node

    grow(np.arange(len(x)))
    return tree


def _picked(tree: Tree, one_in: dict[int, int]):
    """Of the rows of those leaves one in so many, by hash: (leaf, v)."""

    def run(batches):
        for rows in batches:
            if len(rows):
                leaf = assign(tree, vectors.normalised(vectors.matrix(rows["v"])))
                every = np.array([one_in.get(int(x), 0) for x in leaf])
                some = (every > 0) & (rows["h"].to_numpy() % np.maximum(every, 1) == 0)
                yield pd.DataFrame({"leaf": leaf[some], "v": rows["v"][some]})

    return run


def _parted(rows: pd.DataFrame) -> pd.DataFrame:
    """The centres of a leaf's parts, and how many of its picked rows each has; one part if they can't be told apart."""
    x = vectors.normalised(vectors.matrix(rows["v"]))
    own = k_means(x, min(FAN, len(x)), np.random.default_rng(int(rows["leaf"].iloc[0])))
    out = []
    for i in np.unique(own):
        mean = x[own == i].mean(axis=0)
        out.append((int(rows["leaf"].iloc[0]), int((own == i).sum()), (mean / max(np.linalg.norm(mean), 1e-300)).tolist()))
    return pd.DataFrame(out, columns=["leaf", "n", "centre"])


def grown(tree: Tree, rows: DataFrame, sample: np.ndarray, total: int) -> Tree:
    """The tree with leaves split that would hold more than ``LARGE`` of the ``total`` rows (v, h)."""
    size = np.bincount(assign(tree, sample), minlength=tree.leaves) * (total / max(1, len(sample)))
    final: set[int] = set()
    while True:
        large = [i for i in np.argsort(-size, kind="stable").tolist() if size[i] > LARGE and i not in final]
        large = large[: max(0, (MOST_LEAVES - tree.leaves) // (FAN - 1))]
        if not large:
            return tree
        one_in = {i: max(1, int(size[i] // FIT)) for i in large}
        parts = rows.select("v", "h").mapInPandas(_picked(tree, one_in), f"leaf int, v {dict(rows.dtypes)['v']}")
        parts = parts.groupBy("leaf").applyInPandas(_parted, "leaf int, n long, centre array<double>").orderBy("leaf", "n", "centre").collect()
        node_of = {leaf: node for node, leaf in enumerate(tree.leaf) if leaf >= 0}
        by_leaf: dict[int, list] = {}
        for leaf, n, centre in parts:
            by_leaf.setdefault(leaf, []).append((n, np.array(centre)))
        sizes = size.tolist()
        for leaf in large:
            found = by_leaf.get(leaf, [])
            if len(found) < 2:
                final.add(leaf)  # equal rows: bundles split them
                continue
            # The first part takes the leaf's number, so that numbers stay without gaps.
            node, own = node_of[leaf], [leaf, *range(tree.leaves, tree.leaves + len(found) - 1)]
            tree.leaf[node], tree.leaves = -1, tree.leaves + len(found) - 1
            sizes += [0.0] * (len(found) - 1)
            for number, (n, centre) in zip(own, found, strict=True):
                child = tree.add(centre)
                tree.children[node].append(child)
                tree.leaf[child], sizes[number] = number, float(n * one_in[leaf])
        size = np.array(sizes)


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row: down the tree, to the nearest child each time."""
    out = np.zeros(len(x), dtype=np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if tree.leaf[node] >= 0:
            out[rows] = tree.leaf[node]
            continue
        children = tree.children[node]
        own = (x[rows] @ np.array([tree.centres[c] for c in children]).T).argmax(axis=1)
        todo += [(c, rows[own == i]) for i, c in enumerate(children) if (own == i).any()]
    return out


def visits(tree: Tree, query: np.ndarray, near: np.ndarray):
    """The leaves, best bin first. near: the cosine of the query with each node's centre."""
    queue = [(-near[0], 0)]
    while queue:
        _, node = heapq.heappop(queue)
        if tree.leaf[node] >= 0:
            yield tree.leaf[node]
        for child in tree.children[node]:
            heapq.heappush(queue, (-near[child], child))


def calibrate(tree: Tree, x: np.ndarray, k: int, recall: float = RECALL) -> int:
    """The leaves that queries of the sample have to visit until they find that part of their k neighbours in it."""
    if len(x) <= k + 1 or tree.leaves == 1:
        return tree.leaves
    pick = np.linspace(0, len(x) - 1, min(CALIBRATION_QUERIES, len(x))).astype(int)
    own, near = assign(tree, x), x[pick] @ np.array(tree.centres).T
    needed = []
    for i, q in enumerate(pick):
        cosines = x @ x[q]
        cosines[q] = -np.inf
        rank = np.empty(tree.leaves, dtype=np.int64)
        rank[list(visits(tree, x[q], near[i]))] = np.arange(tree.leaves)
        needed += list(rank[own[np.argpartition(-cosines, k)[:k]]] + 1)
    return int(np.quantile(needed, recall, method="higher"))


def _leaf_of(tree: Tree):
    def run(batches):
        for rows in batches:
            if len(rows):
                yield pd.DataFrame({"vec_id": rows["vec_id"], "v": rows["v"], "uid": rows["uid"], "leaf": assign(tree, vectors.normalised(vectors.matrix(rows["v"])))})

    return run


def _route(tree: Tree, leaves: int, count: np.ndarray, bundles_of: list[list[int]]):
    centres = np.array(tree.centres).T

    def run(batches):
        for rows in batches:
            if not len(rows):
                continue
            x = vectors.normalised(vectors.matrix(rows["v"]))
            out, near = [], x @ centres
            for i in range(len(rows)):
                seen, wanted = 0, {}
                for n, leaf in enumerate(visits(tree, x[i], near[i])):
                    if n >= leaves and seen >= LEAST:
                        break
                    seen += count[leaf]
                    for b in bundles_of[leaf]:
                        wanted.setdefault(b, []).append(leaf)
                out += [(rows["vec_id"].iloc[i], rows["v"].iloc[i], b, w) for b, w in wanted.items()]
            yield pd.DataFrame(out, columns=["query_id", "q", "bundle", "leaves"])

    return run


def _search(k: int):
    def run(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        rows = rows.sort_values(["vec_id", "uid"], kind="stable")
        x, ids = vectors.normalised(vectors.matrix(rows["v"])), rows["vec_id"].to_numpy(dtype=np.int64)
        known, leaf = np.unique(rows["leaf"].to_numpy(), return_inverse=True)
        out = []
        for start in range(0, len(queries), 256):
            asked = queries.iloc[start : start + 256]
            q, own = vectors.normalised(vectors.matrix(asked["q"])), asked["query_id"].to_numpy(dtype=np.int64)
            visited = np.array([np.isin(known, wanted) for wanted in asked["leaves"]])
            score = np.where(visited[:, leaf] & (ids[None, :] != own[:, None]), q @ x.T, -np.inf)
            for i in range(len(asked)):
                bound = np.partition(score[i], len(ids) - k)[len(ids) - k] if len(ids) > k else -2.0
                some = np.flatnonzero(score[i] >= max(bound, -2.0) - 1e-9)
                # Row by row, so that equal vectors get the same sum to the last bit and ties go to the smaller id.
                exact = (x[some] * q[i]).sum(axis=1)
                best = np.lexsort((ids[some], -exact))[:k]
                out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[some[best]], "score": exact[best]}))
        return pd.concat(out, ignore_index=True)

    return run


def _one_size(rows: DataFrame, k: int, is_query) -> DataFrame:
    spark = rows.sparkSession
    picked = rows.select("v", F.xxhash64("vec_id", "uid").alias("h")).orderBy("h").limit(SAMPLE).toPandas()
    sample = vectors.normalised(vectors.matrix(picked["v"]))
    kind = dict(rows.dtypes)["v"]
    hashed = rows.select("v", F.pmod(F.xxhash64("vec_id", "uid"), F.lit(1 << 40)).alias("h"))
    tree = grown(fit(sample), hashed, sample, rows.count())
    leaves = calibrate(tree, sample, k)
    index = common.cut(rows.select("vec_id", "v", "uid").mapInPandas(_leaf_of(tree), f"vec_id long, v {kind}, uid long, leaf int"))
    count = np.zeros(tree.leaves, dtype=np.int64)
    for leaf, n in index.groupBy("leaf").agg(F.count("*")).collect():
        count[leaf] = n
    # Bundles in order of the leaves, which neighbour each other in the tree.
    bundles_of, room, bundle = [], BUNDLE, 0
    for n in count:
        if n > BUNDLE:
            bundles_of.append(list(range(bundle + 1, bundle + 1 + -(-int(n) // BUNDLE))))
            bundle, room = bundles_of[-1][-1] + 1, BUNDLE
            continue
        if n > room:
            bundle, room = bundle + 1, BUNDLE
        room -= n
        bundles_of.append([bundle])
    at = spark.createDataFrame([(i, b[0], len(b)) for i, b in enumerate(bundles_of)], "leaf int, first int, parts int")
    dealt = index.join(F.broadcast(at), "leaf").select(
        "vec_id", "v", "uid", "leaf", (F.col("first") + F.pmod(F.xxhash64("uid"), F.col("parts"))).cast("int").alias("bundle")
    )
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min_by("v", "uid").alias("v"))
    common.small_batches(spark, 2048)
    routed = common.cut(asked.mapInPandas(_route(tree, leaves, count, bundles_of), f"query_id long, q {kind}, bundle int, leaves array<int>"))
    # A row a bundle: few, and cut so that both sides can be joined with it.
    blocks = common.cut(routed.groupBy("bundle").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks")))
    routed = routed.join(blocks, "bundle").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).drop("blocks")
    dealt = dealt.join(blocks.select("bundle", "blocks").toDF("bundle", "blocks"), "bundle").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return routed.groupBy("bundle", "block").cogroup(dealt.groupBy("bundle", "block")).applyInPandas(_search(k), "query_id long, vec_id long, score double")


def nearest(rows: DataFrame, k: int = 5, is_query=None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, nearest first, ties to smaller vec_id.

    rows: (vec_id, embedding) and any other columns, which are not looked at. is_query: a condition on vec_id (all
    rows, if none). Nearness is the cosine, in double precision, of the original vectors. A query's own row, and rows
    with its vec_id, are no candidates; of a query's rows with one vec_id the first is asked for. Vectors that are
    null, empty, zero or hold null or non-finite components, and rows without a vec_id, take no part; vectors of
    another length are no candidates. With fewer than k candidates all are returned. Empty table: no rows.
    """
    spark = rows.sparkSession
    common.small_batches(spark, 4096)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(vectors.kept_type(rows, "embedding")).alias("v"))
    rows = rows.where(vectors.usable("v") & F.col("vec_id").isNotNull()).withColumns({"uid": F.monotonically_increasing_id(), "size": F.size("v")})
    rows = common.cut(rows)
    is_query = F.lit(True) if is_query is None else is_query
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for (size,) in rows.select("size").distinct().collect():
        found = found.union(_one_size(rows.where(F.col("size") == size), k, is_query))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
