"""What the training-data operators share: cutting lineage, bounded Arrow batches, word hashing and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import ship

#: Rows, and bytes, that go to Python at a time, about. Texts differ in length, so a batch holds few of them.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see. Only where it is unset and the master local (tests) is one made."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="granary-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, with its lineage cut there: a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder. Unlike a checkpoint it is known to be as small as it is, which
    matters where tables are joined again and again: estimates of sizes multiply with each join."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table in the shared folder that nothing reads any more, on whatever file system that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Before Python runs: lower the session's Arrow batch to ``rows`` and ``BATCH_BYTES`` if it is larger, so that long texts don't fill a
    worker's memory, and see to it that the executors have this package's code."""
    ship(spark)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out, and written into the plan, once wherever the result takes it."""
    return F.transform(F.array(value), use)[0]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --- which rows are wanted -------------------------------------------------------------------------------------------

#: Bits of a filter of ids (8 MB), whatever their number, and the hashes of an id.
FILTER_BITS, FILTER_HASHES = 1 << 26, 2


def _slot(value: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(i)), F.lit(FILTER_BITS))


def likely(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` (long) is among ``ids`` (its only column), and a few more: for joins that want only those.

    A Bloom filter of fixed size is built by the cluster and sent to all tasks, so that rows that the join would drop
    aren't shuffled. Five million ids let 2 % of the others through; the more ids there are the more it lets through,
    and it never drops a row that is wanted.
    """
    spark, name = rows.sparkSession, ids.columns[0]
    slots = ids.select(F.explode(F.array(*[_slot(F.col(name), i) for i in range(FILTER_HASHES)])).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    every = spark.range(FILTER_BITS >> 6).join(words, F.col("id") == F.col("word"), "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    parts = every.groupBy(F.shiftright("id", 10).alias("part")).agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"]).alias("bits"))
    whole = parts.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "bits"))), lambda x: x["bits"])).alias(fresh(rows, "__filter")))
    whole = cut(whole)
    held = F.col(whole.columns[0])
    inside = F.lit(True)
    for i in range(FILTER_HASHES):
        slot = _slot(F.col(column), i)
        inside = inside & (F.lit(1) == F.call_function("shiftrightunsigned", F.get(held, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)))
    return rows.join(F.broadcast(whole), inside, "inner").drop(held)  # one row on the right


# --- words of a batch of texts, without a Python object for each -------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE`` to the powers 0 to n, and those of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = 1 << max(20, int(n + 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, and the offsets of its rows in them. Null: no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(offsets) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words ``[^\\x20\\x09-\\x0D]+``, and each row's first word (one more at the end)."""
    if not len(raw):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    space = _SPACE[raw]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before = np.empty(len(raw), dtype=bool)
    before[0], before[1:] = True, space[:-1]
    before[cuts] = True
    after = np.empty(len(raw), dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    after[cuts - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span of the symbols."""
    up, _ = _power(len(symbols))
    sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * up[: len(symbols)], dtype=np.uint64, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans: equal for equal spans, wherever they stand."""
    _, down = _power(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    symbols = (_LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)
    return span_hash(prefix_hash(symbols), starts, ends)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words in each row, in order, and each row's first run.

    A row with fewer words, but at least one, has its whole sequence as its only run; a row without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_first = np.zeros(len(first), dtype=np.int64)
    np.cumsum(runs, out=out_first[1:])
    starts = np.repeat(first[:-1] - out_first[:-1], runs) + np.arange(out_first[-1])
    ends = starts + np.repeat(np.minimum(counts, width), runs)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), out_first
    return span_hash(prefix_hash(words), starts, ends), out_first


def pieces_of(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each (a single longer text is a slice of its own)."""
    at = batch.column(column)
    if isinstance(at, pa.ChunkedArray):
        at = at.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(at.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


# --- components ---------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); a component is named by its smallest node.

    Each round every node with a smaller neighbour moves onto its smallest one, moves are followed twice more, and
    the edges are rewritten to where their ends went; ends that met drop out. Edges and moves stay distributed, and
    each round's edges are written to the shared folder. A node with very many edges is a join key on a side that
    Spark can split, or is summed up before the shuffle. Null ends and loops are ignored; no edges give no rows.
    """
    left = cut(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi > lo and lo is not null").distinct()
    )
    nodes = left.select(F.col("hi").alias("node")).union(left.select(F.col("lo").alias("node"))).distinct()
    moves = []
    while not left.isEmpty():
        move = left.groupBy(F.col("hi").alias("from")).agg(F.min("lo").alias("to"))
        for _ in range(2):
            then = move.select(F.col("from").alias("at"), F.col("to").alias("next"))
            move = move.join(then, F.col("to") == F.col("at"), "left").select("from", F.coalesce("next", "to").alias("to"))
        move = cut(move)
        moves.append(move)
        for end in ("hi", "lo"):
            left = left.join(move, F.col(end) == F.col("from"), "left").withColumn(end, F.coalesce("to", end)).select("hi", "lo")
        left = cut(
            left.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).where("hi > lo").distinct()
        )
    out = nodes.select("node", F.col("node").alias("component"))
    for move in moves:
        out = out.join(move, F.col("component") == F.col("from"), "left").select("node", F.coalesce("to", "component").alias("component"))
    return out


def local_components(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: each row's component, as the smallest index in it."""
    n = len(linked)
    label = np.arange(n)
    while True:
        around = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, around)
        new = new[new]
        if (new == label).all():
            return label
        label = new
