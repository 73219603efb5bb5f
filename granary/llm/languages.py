"""Language identification: inference of each document's mixture of languages.

A language is a distribution of trigrams of letters (hashed to ``BUCKETS``; what isn't a letter is a border), counted over
all texts that may be learnt from and smoothed by what all languages have in common. A document's trigrams come from a
mixture of languages, whose proportions expectation-maximisation finds, for all documents of a batch at once. The set of
languages is then chosen by penalised likelihood: languages in order of their proportions are added as long as the
logarithm of the likelihood gains more than ``PENALTY`` times that of the number of letters for each. The largest
proportion in the set is the prediction.

The model is a table of languages times buckets, whatever the number of documents.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from granary.llm import common

BITS = 15
BUCKETS = 1 << BITS
PENALTY, ROUNDS, SET_ROUNDS = 3.0, 15, 10
#: What a language is smoothed by: so many trigrams, dealt as in all languages together, and that share of them evenly.
SMOOTH, EVEN = 500.0, 0.05
#: Letters of a batch that are looked at together, and of a text at a time.
LETTERS, PART = 1 << 21, 1 << 20
#: Languages whose counts a task of the training holds at a time.
HELD = 64

_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@functools.cache
def _kinds() -> np.ndarray:
    """For each code point: 1 for letters, 2 for marks on letters, else 0."""
    return np.array([1 if (k := unicodedata.category(chr(i))[0]) == "L" else 2 if k == "M" else 0 for i in range(sys.maxunicode + 1)], dtype=np.uint8)


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram around each letter of a lower-cased text, and where the letters stand."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = np.where(_kinds()[codes] > 0, codes, 0).astype(np.uint64)
    at = np.flatnonzero(symbols[1:-1])
    mixed = symbols[at] * _MULTIPLIERS[0] + symbols[at + 1] * _MULTIPLIERS[1] + symbols[at + 2] * _MULTIPLIERS[2]
    return (common.mix(mixed) >> np.uint64(64 - BITS)).astype(np.int64), at


def _lettered(text: str) -> bool:
    return bool((_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)] == 1).any())


def _counted(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts with letters: which they are, and each one's buckets in order with their counts; first: where its own begin.

    Texts are looked at together as long as they are short; a long one is counted part by part.
    """
    pending: list[int] = []

    def together() -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        lowered = [texts[i].lower() for i in pending]
        buckets, at = _grams(" ".join(lowered))
        ends = np.cumsum([len(t) + 1 for t in lowered])
        key, count = np.unique(np.searchsorted(ends, at, side="right") << BITS | buckets, return_counts=True)
        first = np.searchsorted(key, np.arange(len(pending)) << BITS)
        return pending.copy(), key & (BUCKETS - 1), count, first

    total = 0
    for i, text in enumerate(texts):
        if len(text) > PART:
            lowered, sums = text.lower(), np.zeros(BUCKETS, dtype=np.int64)
            for start in range(0, len(lowered), PART):
                begin = max(0, start - 1)
                buckets, at = _grams(lowered[begin : start + PART + 1])
                inside = (at + begin >= start) & (at + begin < start + PART)
                sums += np.bincount(buckets[inside], minlength=BUCKETS)
            key = np.flatnonzero(sums)
            yield [i], key, sums[key], np.zeros(1, dtype=np.int64)
            continue
        pending.append(i)
        total += len(text)
        if total > PART:
            yield together()
            pending, total = [], 0
    if pending:
        yield together()


@dataclass
class Model:
    """languages, in order, and for each bucket the probability of its trigrams in each of them."""

    languages: list[str]
    chances: np.ndarray

    @property
    def fitted(self) -> bool:
        return bool(self.languages)

    def mixtures(self, buckets: np.ndarray, count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For documents with letters: the proportions of all languages, and those in the chosen set (0 outside)."""
        chance = self.chances[buckets]
        size = np.add.reduceat(count, first).astype(float)
        lengths = np.diff(np.append(first, len(buckets)))

        def fit(share: np.ndarray, rounds: int, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log likelihood of the documents ``some``, after so many rounds."""
            chosen = np.repeat(some, lengths)
            p, c, n = chance[chosen], count[chosen], lengths[some]
            begin = np.cumsum(n) - n
            share = share[some]
            for _ in range(rounds):
                mixed = np.einsum("ij,ij->i", p, np.repeat(share, n, axis=0))
                share = share * np.add.reduceat(p * (c / mixed)[:, None], begin) / size[some][:, None]
                share /= share.sum(axis=1, keepdims=True)
            mixed = np.einsum("ij,ij->i", p, np.repeat(share, n, axis=0))
            return share, np.add.reduceat(c * np.log(mixed), begin)

        every = np.ones(len(first), dtype=bool)
        whole, _ = fit(np.full((len(first), len(self.languages)), 1 / len(self.languages)), ROUNDS, every)
        alone = np.add.reduceat(count[:, None] * np.log(chance), first)
        best = alone.argmax(axis=1)
        share = np.zeros_like(whole)
        share[np.arange(len(first)), best] = 1
        value = alone.max(axis=1)
        rank = np.argsort(np.argsort(-whole, axis=1, kind="stable"), axis=1, kind="stable")
        active = every.copy()
        for k in range(2, len(self.languages) + 1):
            start = np.where(rank < k, np.maximum(whole, 1e-9), 0)
            got, likely = fit(start / start.sum(axis=1, keepdims=True), SET_ROUNDS, active)
            likely = likely - PENALTY * (k - 1) * np.log(size[active] + 1)
            better = likely > value[active]
            active[active] = better
            if not active.any():
                break
            share[active], value[active] = got[better], likely[better]
        return whole, share

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        """For each text: language, its proportion among all languages, and the chosen set with its proportions, largest first."""
        out: list[tuple[str, float, list[tuple[str, float]]]] = [("und", 0.0, [])] * len(texts)
        if not self.fitted:
            return out
        lettered = [i for i, t in enumerate(texts) if t and _lettered(t)]
        for which, buckets, count, first in _counted([texts[i] for i in lettered]):
            whole, share = self.mixtures(buckets, count, first)
            best = share.argmax(axis=1)
            for i, w, s, b in zip(which, whole, share, best, strict=True):
                chosen = sorted(((float(s[j]), self.languages[j]) for j in np.flatnonzero(s)), key=lambda x: (-x[0], x[1]))
                out[lettered[i]] = (self.languages[b], float(min(1.0, w[b])), [(name, x) for x, name in chosen])
        return out


def model_of(counts: dict[str, np.ndarray]) -> Model:
    """The model of each language's counts of buckets; a language without letters isn't learnt."""
    names = sorted(name for name, n in counts.items() if n.sum() > 0)
    if not names:
        return Model([], np.zeros((BUCKETS, 0)))
    n = np.array([counts[name] for name in names], dtype=float)
    total = n.sum(axis=1, keepdims=True)
    common_share = (1 - EVEN) * (n / total).mean(axis=0) + EVEN / BUCKETS
    return Model(names, np.ascontiguousarray(((n + SMOOTH * common_share) / (total + SMOOTH)).T))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for name, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])], ["lang", "bucket", "n"])
        held.clear()

    for batch in batches:
        names = batch.column("lang").to_pylist()
        texts = batch.column("text").to_pylist()
        for name in dict.fromkeys(names):
            if name not in held and len(held) >= HELD:
                yield from out()
            sums = held.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
            for _, buckets, count, _ in _counted([t for t, x in zip(texts, names, strict=True) if x == name]):
                sums += np.bincount(buckets, weights=count, minlength=BUCKETS).astype(np.int64)
    yield from out()


def train(docs: DataFrame, learn: Column) -> Model:
    """A model from the whole texts of all rows where ``learn`` holds and neither lang nor text is null.

    Counts are added up in each task, then by Spark; a row for each language and bucket comes to the driver.
    No usable row: an unfitted model.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.where(learn).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).dropna()
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, np.ndarray] = {}
    names = sums.column("lang").combine_chunks().dictionary_encode()
    which, bucket, n = names.indices.to_numpy(), sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    for i, name in enumerate(names.dictionary.to_pylist()):
        own = which == i
        counts[name] = np.bincount(bucket[own], weights=n[own], minlength=BUCKETS)
    return model_of(counts)


def held_out(doc_id: str) -> Column:
    """The rows that aren't learnt from: crc32 of the id as text (null: empty), modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def predicted(docs: DataFrame, model: Model, keep: dict[str, Column]) -> DataFrame:
    """The columns ``keep`` of docs (by their new names), and lang_pred, score and languages (array of lang and share) of each row's whole text.

    Null texts and texts without letters, and all texts if the model is unfitted, are ``und`` with score 0 and no languages.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    table = spark.sparkContext.broadcast(model)
    some = docs.select(*[c.alias(name) for name, c in keep.items()], F.col("text").cast("string").alias("__text"))
    schema = some.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("languages", ArrayType(StructType().add("lang", "string").add("share", "double")))
    names = list(keep)
    kinds = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(PART >> 4, LETTERS // max(1, len(table.value.languages)))
        for batch in batches:
            for piece in common.pieces_of(batch, "__text", most):
                found = table.value.predict(piece.column("__text").to_pylist())
                arrays = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([[{"lang": a, "share": b} for a, b in x[2]] for x in found], kinds)]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), *arrays], [*names, "lang_pred", "score", "languages"])

    return some.mapInArrow(run, schema)
