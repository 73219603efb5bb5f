"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: round after round, each feature in turn gets one shallow tree on its bins, and the tree's leaf values,
shrunken, are added to the feature's lookup table; then the pairs of features whose joint table would gain most get
shallow trees of their own. A text's score is the logistic function of the intercept and one table entry for each
feature and pair, added up for whole batches at once. Features are counts and ratios of bytes, words and lines of the
whole text; nothing else about a document is looked at.

The model is fitted on the driver from a sample of labelled rows of bounded size: the ``SAMPLE`` with the smallest hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common

#: Labelled rows that a model is fitted on, at most.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 8, 6, 120, 60, 0.15

FEATURES = (
    "log_words", "word_length", "longest_word", "distinct_words", "top_word", "lower", "upper", "digits", "marks", "symbols", "bars", "shouts",
    "other_bytes", "upper_words", "line_words", "repeated_lines", "repeated_shingles", "symbol_ends",
)

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "marks": b".,;:?'\"()-",
    "symbols": b"#$%&*@^~=+<>{}[]\\/_`", "bars": b"|", "shouts": b"!", "other_bytes": bytes(range(128, 256)), "lines": b"\n",
}


def _tables() -> dict[str, np.ndarray]:
    out = {}
    for name, members in _CLASSES.items():
        out[name] = np.zeros(256, dtype=np.uint8)
        out[name][list(members)] = 1
    return out


_TABLES = _tables()


def _between(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:], dtype=np.int64)
    return (sums[first[1:]] - sums[first[:-1]]).astype(np.float64)


def _distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: its distinct values, and how often the commonest occurs."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(values)))
    most = np.zeros(n)
    np.maximum.at(most, row[at], runs)
    return np.bincount(row[at], minlength=n).astype(np.float64), most


def features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text. Null and empty texts: all zeros."""
    raw, offsets = common.text_bytes(column)
    starts, ends, first = common.word_bounds(raw, offsets)
    size, n = np.maximum(1, np.diff(offsets)), np.diff(first).astype(np.float64)
    words = np.maximum(1, n)
    out = {name: _between(table[raw], offsets) for name, table in _TABLES.items()}
    lines = out.pop("lines") + 1
    out = {name: x / size for name, x in out.items()}
    long = (ends - starts).astype(np.int64)
    out["log_words"], out["line_words"] = np.log1p(n), np.log1p(n / lines)
    out["word_length"] = _between(long, first) / words
    out["longest_word"] = np.zeros(len(n))
    some = np.flatnonzero(n)
    if len(some):
        out["longest_word"][some] = np.log1p(np.maximum.reduceat(long, first[some]))
    hashes = common.word_hashes(raw, starts, ends)
    distinct, most = _distinct(hashes, first)
    out["distinct_words"], out["top_word"] = distinct / words, most / words
    out["upper_words"] = _between(_TABLES["upper"][raw[starts]] & _TABLES["upper"][raw[ends - 1 - (long > 3)]], first) / words if len(starts) else np.zeros(len(n))
    out["symbol_ends"] = _between(_TABLES["symbols"][raw[ends - 1]], first) / words if len(starts) else np.zeros(len(n))
    runs, run_first = common.shingle_hashes(hashes, first)
    got, _ = _distinct(runs, run_first)
    out["repeated_shingles"] = 1 - got / np.maximum(1, np.diff(run_first))
    out["repeated_shingles"][n == 0] = 0
    breaks = np.flatnonzero(raw == 10) if len(raw) else np.zeros(0, dtype=np.int64)
    cuts = np.unique(np.concatenate([offsets, breaks + 1])) if len(raw) else offsets[:1]
    line_starts, line_ends = cuts[:-1], cuts[1:]
    line_first = np.searchsorted(line_starts, offsets)
    if len(line_starts):
        whole = common.span_hash(common.prefix_hash(raw.astype(np.uint64) + np.uint64(1)), line_starts, np.minimum(line_ends, len(raw)))
        got, _ = _distinct(whole, line_first)
        out["repeated_lines"] = np.where(np.diff(line_first) > 0, 1 - got / np.maximum(1, np.diff(line_first)), 0)
    else:
        out["repeated_lines"] = np.zeros(len(n))
    return np.column_stack([out[f] for f in FEATURES]) if len(n) else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    """intercept, and lookup tables: by feature, and by pair of features on coarser bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]
    fitted: bool = True

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], side="right") for f in {f for p in self.pairs for f in p}}
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[f], coarse[g]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int = 2, ridge: float = 1.0) -> np.ndarray:
    """The leaf values, by bin, of a tree of that depth on the ordered bins of one feature."""
    value = gradient.sum() / (weight.sum() + ridge)
    out = np.full(len(gradient), value)
    if depth == 0 or len(gradient) < 2:
        return out
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    right_g, right_w = gradient.sum() - left_g, weight.sum() - left_w
    gain = left_g**2 / (left_w + ridge) + right_g**2 / (right_w + ridge)
    at = int(gain.argmax())
    if gain[at] <= gradient.sum() ** 2 / (weight.sum() + ridge) + 1e-12:
        return out
    return np.concatenate([_tree(gradient[: at + 1], weight[: at + 1], depth - 1, ridge), _tree(gradient[at + 1 :], weight[at + 1 :], depth - 1, ridge)])


def _pair_tree(gradient: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """The best cut of one feature, with the best cut of the other on either side: leaf values by cell, and the gain."""
    best, best_gain = np.zeros_like(gradient), 0.0
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        base = g.sum() ** 2 / (w.sum() + ridge)
        for cut in range(1, len(g)):
            value, gain = np.zeros_like(g), -base
            for part in (slice(0, cut), slice(cut, None)):
                column = _tree(g[part].sum(axis=0), w[part].sum(axis=0), 1, ridge)
                value[part] = column
                for v in np.unique(column):
                    own = column == v
                    gain += g[part][:, own].sum() ** 2 / (w[part][:, own].sum() + ridge)
            if gain > best_gain:
                best, best_gain = (value.T if turned else value), gain
    return best, best_gain


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of label 1. Without rows: no tables, and 0.5 for everything."""
    count = x.shape[1]
    prior = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(prior / (1 - prior)))
    if not len(y):
        return Model(intercept, [np.zeros(0)] * count, [np.zeros(1)] * count, [], [np.zeros(0)] * count, [], fitted=False)
    edges, coarse = _edges(x, BINS), _edges(x, PAIR_BINS)
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    logit = np.full(len(y), intercept)
    chance = lambda: 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    for _ in range(ROUNDS):
        for f in range(count):
            p = chance()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], y - p, size), np.bincount(bins[f], p * (1 - p), size))
            tables[f] += step
            logit += step[bins[f]]
    wide = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]
    sizes = [len(e) + 1 for e in coarse]

    def joint(f: int, g: int) -> tuple[np.ndarray, np.ndarray]:
        p, cell = chance(), wide[f] * sizes[g] + wide[g]
        shape = (sizes[f], sizes[g])
        return np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape), np.bincount(cell, p * (1 - p), shape[0] * shape[1]).reshape(shape)

    gains = {(f, g): _pair_tree(*joint(f, g))[1] for f in range(count) for g in range(f)}
    pairs = sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]
    pair_tables = [np.zeros((sizes[f], sizes[g])) for f, g in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(pairs):
            step = RATE * _pair_tree(*joint(f, g))[0]
            pair_tables[k] += step
            logit += step[wide[f], wide[g]]
    return Model(intercept, edges, tables, pairs, coarse, pair_tables)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in common.pieces_of(batch, "text"):
            x = features(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("picked_id"), piece.column("label"), *(pa.array(c) for c in x.T)], ["picked_id", "label", *FEATURES])


def _apply(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces_of(batch, "__text"):
                score = pa.array(model.score(features(piece.column("__text"))))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), score], [*keep, "__score"])

    return run


def held_out(doc_id) -> F.Column:
    """The rows that no label is learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows that are not held out: the ``sample`` ones with the smallest hash of their id.

    labels: (doc_id, quality 0 or 1). Null ids, and qualities other than 0 and 1, are ignored; a document with several
    different labels counts once for each; of a document's several rows the one with the smallest features is looked at.
    No usable label: an unfitted model.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample).collect()
    empty = np.zeros((0, len(FEATURES)))
    if not picked:
        return fit(empty, np.zeros(0))
    chosen = spark.createDataFrame([(r[0], r[1]) for r in picked], "picked_id long, label int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen.distinct()), F.col("doc_id") == F.col("picked_id")).select("picked_id", "label", "text")
    schema = "picked_id long, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    # One row for each id and label, however many rows the table has for it.
    got = rows.mapInArrow(_measure, schema).groupBy("picked_id", "label").agg(F.min(F.struct(*FEATURES)).alias("x"))
    got = got.select("picked_id", "label", "x.*").toPandas().sort_values(["picked_id", "label"])
    return fit(got[list(FEATURES)].to_numpy(), got["label"].to_numpy(dtype=float)) if len(got) else fit(empty, np.zeros(0))


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of docs, and ``__score`` between 0 and 1 for each row's whole text.

    Null and empty texts are scored like a text of no words; an unfitted model scores everything 0.5. Columns may have
    any names but ``__text`` and ``__score``.
    """
    common.small_batches(docs.sparkSession)
    some = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("__text"))
    schema = some.drop("__text").schema.add("__score", "double")
    return some.mapInArrow(_apply(model, keep), schema)


def accepted(docs: DataFrame, model: Model, at_least: float = 0.7) -> DataFrame:
    """The rows of docs, with all their columns, that score ``at_least`` or more. An unfitted model rejects nothing."""
    if not model.fitted:
        return docs
    renamed = docs
    for c in docs.columns:
        if c.lower() in ("__text", "__score"):
            renamed = renamed.withColumnRenamed(c, common.fresh(renamed, c + "_"))
    kept = scored(renamed, model, renamed.columns).where(F.col("__score") >= at_least).select(*[F.col(f"`{c}`") for c in renamed.columns])
    return kept.toDF(*docs.columns)
