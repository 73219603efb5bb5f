"""MinHash near-duplicates: a signature-coordinate inverted join.

1. Every text becomes a set of 64-bit hashes of its five-word shingles and a signature of ``coordinates`` minima.
2. Equal sets (by size and 128 bits of the set) form a class; its smallest doc_id stands for it from here on.
3. Signatures are posted under each (coordinate, value) pair. A pair of texts as similar as asked for shares at least
   ``matches`` coordinates but for a chance of about one in 50,000, so coordinates that nobody shares use up the
   first places of a text's prefix, rarest first, and only ``coordinates - matches + 1`` places are posted at all:
   a text with fewer than ``matches`` shared coordinates is skipped, and so are the longest lists.
4. The posting lists are merged by joining each entry with its list's smallest entry; what hangs together are the
   candidate groups. Lists are never expanded into pairs, so a list of any length costs one row for each entry.
5. Inside a group collisions are counted for all pairs of a block of bounded size, by merging the coordinates' lists in
   the block. Pairs with ``matches`` collisions or more are retained and confirmed on their full sets. A block gives back
   only the links needed to connect what it found linked, at most one for each row. Of what is connected only one row
   goes on to the next round, so a large group of mutual near-copies costs about one comparison of each of its blocks
   with itself.
6. What is left unconnected in a large group, outside its largest part, is compared with the whole group in tiles of
   two blocks: no retained pair of rows that aren't connected yet is missed, and no pair is ever a row.
7. Connected links are components.

The sets of the groups' members are made once, written to the shared folder, and read from there in each round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import common

COORDINATES = 64
#: Rows, and shingles, of a block. A tile holds two blocks.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 400_000
#: Rounds in which the parts of large groups are brought together, before what is left is compared in full.
ROUNDS = 5
#: Texts with so many equal sets are joined apart from others; there are at most ``HOT_CLASSES`` such sets.
HOT_ROWS, HOT_CLASSES = 1000, 100_000


def matches_needed(percent: int, coordinates: int = COORDINATES) -> int:
    """Equal coordinates that a pair of that similarity has but for 4.2 standard deviations."""
    p = percent / 100
    return max(1, math.floor(coordinates * p - 4.2 * math.sqrt(coordinates * p * (1 - p))))


def _multipliers(n: int) -> np.ndarray:
    return common.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct shingles of all rows, each row's first one): the set of each row, sorted."""
    at = 0
    for piece in common.pieces_of(batch, "text"):
        raw, offsets = common.text_bytes(piece.column("text"))
        starts, ends, first = common.word_bounds(raw, offsets)
        runs, run_first = common.shingle_hashes(common.word_hashes(raw, starts, ends), first)
        row = np.repeat(np.arange(piece.num_rows), np.diff(run_first))
        order = np.lexsort((runs, row))
        runs, row = runs[order], row[order]
        new = np.ones(len(runs), dtype=bool)
        new[1:] = (runs[1:] != runs[:-1]) | (row[1:] != row[:-1])
        runs, row = runs[new], row[new]
        yield at, runs, np.searchsorted(row, np.arange(piece.num_rows + 1))
        at += piece.num_rows


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def _sign(coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _multipliers(coordinates)
        for batch in batches:
            for at, runs, first in _sets(batch):
                n = np.diff(first)
                some = np.flatnonzero(n)
                sign = np.zeros((len(n), coordinates), dtype=np.uint32)
                if len(some):
                    for i, k in enumerate(by):
                        x = runs * k
                        x ^= x >> np.uint64(29)
                        x *= common._MIX2
                        sign[some, i] = np.minimum.reduceat(x, first[some]) >> np.uint64(32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array(_sums(common.mix(runs), first).view(np.int64)),
                        pa.array(_sums(common.mix(runs ^ common._STEP), first).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * coordinates, pa.int32()), pa.array(sign.ravel().view(np.int32))),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "sign"],
                )

    return run


def signatures(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sign) for every row of (doc_id, text)."""
    common.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sign(coordinates), "doc_id long, n_shingles long, f1 long, f2 long, sign array<int>"
    )


def candidate_groups(classes: DataFrame, matches: int, coordinates: int = COORDINATES) -> DataFrame:
    """(node, component): the candidate groups of two or more among the rows (rep, sign)."""
    posted = classes.select("rep", F.posexplode("sign").alias("i", "v")).select(
        "rep", (F.col("i").cast("long") * F.lit(1 << 32) + F.col("v").cast("long").bitwiseAND(F.lit((1 << 32) - 1))).alias("key")
    )
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    by_doc = posted.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("lists"))
    prefix = by_doc.where(F.size("lists") >= matches).select(
        "rep", F.explode(F.slice("lists", F.lit(1), F.size("lists") - F.lit(matches - 1))).alias("at")
    ).select("rep", F.col("at.key").alias("key"))
    prefix = common.cut(prefix)
    heads = prefix.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    return common.components(prefix.join(heads, "key").select(F.col("rep").alias("a"), F.col("head").alias("b")))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the bytes of its set in place of its text."""
    for batch in batches:
        others = [c for c in batch.schema.names if c != "text"]
        for at, runs, first in _sets(batch):
            n = len(first) - 1
            blob = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((first * 8).astype(np.int64).tobytes()), pa.py_buffer(runs.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, n) for c in others] + [blob.cast(pa.binary())], [*others, "shingles"])


def collisions(signs: np.ndarray) -> np.ndarray:
    """For each pair of rows, how many coordinates hold the same value in both: the lists of each coordinate, merged."""
    out = np.zeros((len(signs), len(signs)), dtype=np.int16)
    for values in signs.T:
        out += values[:, None] == values[None, :]
    return out


def linked_rows(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The symmetric matrix of which sets reach the similarity, by exact sizes of their intersections."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    everything = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(everything, return_inverse=True, return_counts=True)
    dense = np.cumsum(count > 1) - 1
    keep = count[code] > 1
    owner, code = owner[keep], dense[code[keep]]
    width = int(code.max()) + 1 if len(code) else 0
    common_size = np.zeros((len(sets), len(sets)), dtype=np.int64)
    step = max(1, 8_000_000 // max(1, len(sets)))
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for start in range(0, width, step):
        low, high = np.searchsorted(code, (start, start + step))
        part = np.zeros((len(sets), min(step, width - start)), dtype=np.float32)
        part[owner[low:high], code[low:high] - start] = 1
        common_size += np.rint(part @ part.T).astype(np.int64)
    linked = 100 * common_size >= percent * (sizes[:, None] + sizes[None, :] - common_size)
    np.fill_diagonal(linked, False)
    return linked


def _compare(percent: int, matches: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        retained = collisions(np.array(rows["sign"].tolist(), dtype=np.int32)) >= matches
        np.fill_diagonal(retained, False)
        some = np.flatnonzero(retained.any(axis=1))
        rep = rows["rep"].to_numpy(dtype=np.int64)[some]
        linked = linked_rows([np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"].iloc[some]], percent) & retained[np.ix_(some, some)]
        root = common.local_components(linked)
        moved = root != np.arange(len(rep))
        return pd.DataFrame({"a": rep[moved], "b": rep[root[moved]]})

    return run


def _blocks_for(n: Column, of: Column) -> Column:
    """Blocks that n rows with ``of`` shingles fill."""
    return F.ceil(F.greatest(n / BLOCK_ROWS, of / BLOCK_SHINGLES)).cast("int")


def _dealt(members: DataFrame, seed: int) -> DataFrame:
    """members (component, rep, n_shingles) of groups of two or more, with their group's number of blocks and their own."""
    whole = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("of")).where("n > 1")
    whole = whole.select("component", _blocks_for(F.col("n"), F.col("of")).alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit(seed), "rep"), F.col("blocks")).cast("int")
    return members.join(whole, "component").select("component", "rep", "n_shingles", "blocks", block.alias("block"))


_SETS = "component long, rep long, n_shingles long, sign array<int>, blocks int, block int"


def member_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """members (component, rep, n_shingles, sign, blocks, block) with ``shingles``, the bytes of their sets, written out.

    The only time that texts meet members: both are dealt by id, whatever their number. A document with several texts
    meets its member rows with each of them.
    """
    members = common.cut(members)
    texts = common.likely(docs.select("doc_id", "text").where("doc_id is not null"), "doc_id", members.select("rep"))
    joined = texts.join(members.hint("shuffle_hash"), F.col("rep") == F.col("doc_id"))
    return common.cut(joined.select(*members.columns, "text").mapInArrow(_gather, f"{_SETS}, shingles binary"))


def _within(sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """(a, b): links that connect what is similar within each block."""
    rows = sets.select("component", "rep", "block", "sign", "shingles")
    return rows.groupBy("component", "block").applyInPandas(_compare(percent, matches), "a long, b long")


def _across(sets: DataFrame, named: DataFrame, percent: int, matches: int) -> DataFrame:
    """(a, b): links between different parts of a group: all outside its largest part meet everyone in it.

    named: (component, rep, n_shingles, root), root being the part.
    """
    parts = named.groupBy("component", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("of"))
    whole = parts.groupBy("component").agg(F.max(F.struct("n", "of", "root")).alias("top"), F.sum("n").alias("n"), F.sum("of").alias("of"))
    whole = whole.where("n > top.n").select(
        "component", F.col("top.root").alias("main"), _blocks_for(F.col("n"), F.col("of")).alias("blocks"),
        _blocks_for(F.col("n") - F.col("top.n"), F.col("of") - F.col("top.of")).alias("others"),
    )
    own = F.when(F.col("root") != F.col("main"), F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("others"))).cast("int")
    rows = named.join(whole, "component").select(
        "component", "rep", F.pmod(F.xxhash64(F.lit(0), "rep"), F.col("blocks")).cast("int").alias("block"), "blocks", own.alias("own"), "others"
    )
    rows = rows.join(sets.select("rep", "sign", "shingles"), "rep")
    asked = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: F.struct(i.alias("own"), F.col("block").alias("block")))
    asks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.col("own").alias("own"), j.alias("block")))
    tiles = rows.withColumn("tile", F.explode(F.when(F.col("own").isNull(), asked).otherwise(F.array_union(asked, asks))))
    tiles = tiles.select("component", "rep", "sign", "shingles", F.col("tile.own").alias("own"), F.col("tile.block").alias("block"))
    return tiles.groupBy("component", "own", "block").applyInPandas(_compare(percent, matches), "a long, b long")


def links(docs: DataFrame, groups: DataFrame, signed: DataFrame, percent: int, matches: int) -> DataFrame:
    """(a, b): links that connect what is similar within each candidate group.

    docs: (doc_id, text). groups: (node, component). signed: (rep, n_shingles, sign). A group is dealt into blocks, and
    each block compared in itself. In groups of several blocks, what is connected by then counts as one part, whose
    smallest row is dealt again, for ``ROUNDS`` rounds or until the parts stay as many; last, rows of different parts
    are compared.
    """
    members = groups.join(signed, F.col("node") == F.col("rep")).select("component", "rep", "n_shingles", "sign")
    dealt = _dealt(members.drop("sign"), 0).join(members.select("rep", "sign"), "rep")
    sets = member_sets(docs, dealt.select("component", "rep", "n_shingles", "sign", "blocks", "block"))
    found = common.cut(_within(sets, percent, matches))
    large = common.cut(sets.where("blocks > 1").select("component", "rep", "n_shingles"))
    before = large.count()
    if not before:
        return found
    sets = sets.where("blocks > 1").select("rep", "sign", "shingles")

    def parts() -> DataFrame:
        near = found.join(large.select(F.col("rep").alias("a")).distinct(), "a", "left_semi")
        part = common.components(near).toDF("node", "part")
        return common.cut(large.join(part, F.col("rep") == F.col("node"), "left").select("component", "rep", "n_shingles", F.coalesce("part", "rep").alias("root")))

    for i in range(ROUNDS + 1):
        named = parts()
        roots = common.cut(_dealt(named.where("rep = root"), i + 1))
        left = roots.count()
        if not left:
            return found
        if left == before or i == ROUNDS:
            break
        before, found = left, common.cut(found.union(_within(roots.join(sets, "rep"), percent, matches)))
    return found.union(_across(sets, named, percent, matches))


def near_duplicates(docs: DataFrame, percent: int = 80, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs`` (doc_id, text, and any other columns).

    Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; a set holds the distinct five-word
    shingles, or the whole sequence if that is shorter. Sets link if 100 * intersection >= ``percent`` * union.
    Null and wordless texts: empty set, linked with nothing. Rows with one doc_id are one document: its links are
    those of all its rows, and its candidates come from any one of them in a class. Null doc_id: linked with
    nothing, component null, kept. Empty table: no rows. Other columns are not looked at.
    """
    matches = matches_needed(percent, coordinates)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = common.cut(signatures(docs, coordinates))
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    keys = ["n_shingles", "f1", "f2"]
    classes = usable.groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.any_value("sign").alias("sign"), F.count("*").alias("copies"))
    classes = common.cut(classes)
    groups = candidate_groups(classes, matches, coordinates)
    of_class = classes.select(*keys, "rep", "copies")
    # A document with several different texts: its classes hang together through it.
    several = usable.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    twice = usable.join(several, "doc_id").join(of_class, keys).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = links(docs, groups, classes.select("rep", "n_shingles", "sign"), percent, matches).union(twice)
    joined = common.components(found)
    # Components belong to classes, so that copies meet neither here nor below: sets with very many rows are few.
    named = common.cut(of_class.join(joined, F.col("rep") == F.col("node"), "left").select(*keys, "copies", F.coalesce("component", "rep").alias("component")))
    hot = F.col("copies") > max(HOT_ROWS, -(-rows.count() // HOT_CLASSES))
    often = F.broadcast(named.where(hot).drop("copies"))
    slim = rows.select("doc_id", *keys)
    out = slim.join(often, keys).unionByName(slim.join(often, keys, "left_anti").join(named.where(~hot).drop("copies"), keys, "left"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns; of a doc_id's rows, one stays.

    Rows without a doc_id all stay. The columns are those of ``docs``, whatever their names.
    """
    gone = common.cut(near_duplicates(docs, percent).where("not kept").select(F.col("doc_id").alias("__gone")).distinct())
    one, again = common.fresh(docs, "__row"), common.fresh(docs, "__again")
    own = F.col("doc_id")
    left = docs.join(gone, own == F.col("__gone"), "left_anti")
    # Which ids have several rows is found without the texts; rarely is there any, and only those rows are brought together.
    several = docs.select(own).where(own.isNotNull()).join(gone, own == F.col("__gone"), "left_anti").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    several = common.cut(several.select(own.alias(again)))
    if several.isEmpty():
        return left
    rows = left.join(several, own == F.col(again), "left_semi").withColumn(one, F.struct(*[F.col(f"`{c}`") for c in left.columns if c != "doc_id"]))
    rows = rows.groupBy("doc_id").agg(F.max_by(one, F.coalesce(F.col("text"), F.lit(""))).alias(one))
    rows = rows.select(*[own if c == "doc_id" else F.col(f"{one}.`{c}`").alias(c) for c in left.columns])
    return left.join(several, own == F.col(again), "left_anti").unionByName(rows)
