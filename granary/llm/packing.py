"""Best-fit packing by a grouping genetic algorithm.

Texts become token ids; a text longer than a sequence is cut into full pieces, and what is left of it, like a shorter
text, is an item. Items are dealt to islands of about ``ISLAND`` documents. Each island evolves a small population of
packings: the first by best fit over descending sizes, the others from disturbed orders. Crossover puts whole
well-filled bins of one parent into the other, removes the bins that hold a document twice, and best-fits the
documents that this displaced. The island's best packing gives its well-filled bins for good; the documents of the
others migrate, with one elite packing of theirs, to an island of the next, smaller, ring, which packs them again.
Token ids never leave the task that made them: only lengths are packed.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common

ISLAND, POPULATION, GENERATIONS, MIGRANTS = 4096, 4, 6, 32
#: Distinct words whose ids a worker remembers; when there are more, those not met of late are forgotten.
REMEMBERED = 500_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Words whose pre-tokens are plain: letters that are their own NFC and lower-case one by one, then punctuation.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,!?;:|&%$#*]*)")


_SPLIT = re.compile(r"[^\S\x1c-\x1f]+")


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary spells the letters of ``_PLAIN``: printable bytes as themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    spelled = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Ids(dict):
    """Token ids of words, as little-endian 32-bit integers; a missing word is looked up when it is asked for.

    This tokenizer splits at white space and drops it before anything else, so words never influence each other.
    Plain words go to the vocabulary's model directly, all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.old, self.parts = Tokenizer.from_file(path), {}, {}
        self.model, self.spelling = self.tokenizer.model, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        found = self.old.pop(word, None)
        if found is None:
            if word.isalpha() and word.islower() and word.isascii():
                found = self.part(word)
            elif plain := _PLAIN.fullmatch(word):
                letters, rest = plain.groups()
                lower = letters.lower()
                found = (b"" if not letters else self.part(lower.translate(self.spelling)) if lower == word else self[lower]) + (self.mark(rest) if rest else b"")
            else:
                found = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if 2 * len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found

    def part(self, spelled: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def mark(self, marks: str) -> bytes:
        if marks not in self.parts:
            if len(self.parts) > 10_000:
                self.parts.clear()
            self.parts[marks] = self.part(marks)
        return self.parts[marks]

    def texts(self, texts: list[str | None], end: int) -> Iterator[bytes]:
        """The ids of each text and then ``end``."""
        last, get = array("I", [end]).tobytes(), self.__getitem__
        for text in texts:
            # Python also splits at these four, which are no white space to the tokenizer.
            odd = text and any(c in text for c in "\x1c\x1d\x1e\x1f")
            yield b"".join(map(get, _SPLIT.split(text) if odd else (text or "").split())) + last


def _cut(path: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        ids = Ids(path)
        for batch in batches:
            for piece in common.pieces_of(batch, "text"):
                out = [[], [], [], [], []]
                for doc_id, raw in zip(piece.column("doc_id").to_pylist(), ids.texts(piece.column("text").to_pylist(), end), strict=True):
                    for n, at in enumerate(range(0, len(raw), 4 * size)):
                        part = raw[at : at + 4 * size]
                        for column, x in zip(out, (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            column.append(x)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


# --- the genetic algorithm ------------------------------------------------------------------------------------------


def best_fit(order, lengths: list[int], size: int, bins: list[list[int]]) -> list[list[int]]:
    """Put the items of ``order`` one by one into the fullest bin that still has room, or into a new one."""
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if there is a bin with r left
    for b, items in enumerate(bins):
        room = size - sum(lengths[i] for i in items)
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    for item in order:
        need = lengths[item]
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            own = by_room[room]
            b = own.pop()
            if not own:
                rooms ^= 1 << room
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(item)
        room -= need
        if room:
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
    return bins


def fitness(bins: list[list[int]], lengths: list[int], size: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    return -len(bins), sum((sum(lengths[i] for i in b) / size) ** 2 for b in bins)


def crossover(one: list[list[int]], other: list[list[int]], lengths: list[int], size: int, rng: np.random.Generator) -> list[list[int]]:
    """``one`` with some of the best-filled bins of ``other`` put in whole; what that displaces is best-fitted."""
    fill = np.array([sum(lengths[i] for i in b) for b in other])
    top = np.argsort(-fill, kind="stable")[: max(1, len(other) // 2)]
    given = [other[b] for b in rng.choice(top, max(1, len(top) // 2), replace=False)]
    taken = {i for b in given for i in b}
    child, displaced = [list(b) for b in given], []
    for b in one:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, size, child)


def evolve(lengths: list[int], size: int, seed: int, population: int = POPULATION, generations: int = GENERATIONS, elite: list[list[int]] | None = None) -> list[list[int]]:
    """The best packing found of items of those lengths; each bin is a list of item numbers."""
    if not lengths:
        return []
    rng, at = np.random.default_rng(seed), np.array(lengths)
    people = [best_fit(np.argsort(-at, kind="stable").tolist(), lengths, size, [])]
    if elite:
        people.append(elite)
    least = -(-int(at.sum()) // size)
    while len(people) < population:
        people.append(best_fit(np.argsort(-at * rng.uniform(0.85, 1.0, len(at)), kind="stable").tolist(), lengths, size, []))
    rank = lambda b: fitness(b, lengths, size)
    people.sort(key=rank, reverse=True)
    for _ in range(generations):
        if len(people[0]) <= least:
            break
        for i in range(1, len(people)):
            mate = int(rng.integers(0, i))
            child = crossover(people[i], people[mate], lengths, size, rng)
            if rank(child) > rank(people[i]):
                people[i] = child
        people.sort(key=rank, reverse=True)
    return people[0]


def _island(size: int, base: int, last: bool):
    """Pack the rows of an island. Rows of bins that are not well filled migrate, unless this is the last ring."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = rows["length"].tolist()
        whole = [i for i, n in enumerate(lengths) if n == size]
        items = [i for i, n in enumerate(lengths) if n < size]
        own = [lengths[i] for i in items]
        elite = None
        if "bin" in rows and len(items):
            elite = [list(g) for g in pd.Series(range(len(items))).groupby(rows["bin"].iloc[items].to_numpy()).apply(list)]
        bins = [[i] for i in whole] + [[items[i] for i in b] for b in evolve(own, size, int(key[0]) + 1, elite=elite)]
        number, offset, stays = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64), np.ones(len(rows), dtype=bool)
        for b, members in enumerate(bins):
            at = 0
            for i in members:
                number[i], offset[i] = base + (int(key[0]) << 32) + b, at
                at += lengths[i]
            if not last and at < 0.98 * size:
                stays[members] = False
        return rows.assign(bin=number, offset=offset, stays=stays)[[*_NAMES, "bin", "offset", "stays"]]

    return run


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of each row's text goes.

    docs: (doc_id, text) and any other columns, which are not looked at. tokenizer: the path of a tokenizer file whose
    pre-tokenizer drops white space, readable on every executor. A text's ids are followed by ``end``; null and empty
    texts are ``end`` alone. Only texts of more than ``size`` ids are cut, into pieces of ``size``. Repeated rows and
    null doc_ids are rows like any other, each with its own pieces, and texts may be of any length. In a sequence pieces follow one another without
    gaps from offset 0. Empty table: no rows.
    """
    common.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    islands = max(1, round(docs.select("doc_id").count() / ISLAND))
    pieces = docs.mapInArrow(_cut(tokenizer, size, end), _PIECES)
    # Equal rows without an id are told apart by their place, or all of them would be one island.
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    pieces = pieces.withColumn("island", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", place), F.lit(islands)).cast("long"))
    schema = f"{_PIECES}, bin long, offset long, stays boolean"
    packed = common.cut(pieces.groupBy("island").applyInPandas(_island(size, 0, islands == 1), schema))
    if islands > 1:
        ring = -(-islands // MIGRANTS)
        moving = packed.where("not stays").withColumn("island", F.pmod(F.xxhash64(F.shiftright("bin", 32)), F.lit(ring)).cast("long"))
        packed = packed.where("stays").union(moving.groupBy("island").applyInPandas(_island(size, 1 << 61, True), schema))
    return packed.select(*_NAMES, F.col("bin").alias("sequence_id"), "offset")
