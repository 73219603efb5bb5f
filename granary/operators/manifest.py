"""Digests of datasets, and COCO documents under a mapping policy."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary import ship
from granary.functions import sha256
from granary.functions.labels import Policy
from granary.functions.paths import path_order
from granary.lineage import cut, shared_folder
from granary.operators.ranks import dealt

#: A piece of a sorted listing holds two to the power of this many files, and a task reads about so much of a folder at a time.
PIECE_BITS, ROUND_BYTES = 17, 64 << 20


def digest(files: DataFrame) -> DataFrame:
    """(sha256): of all paths with their contents' hashes, in path order. files: (path, sha256), a manifest's listing.

    One row holds the whole listing, so it is for millions of files at most; ``streamed_digest`` is for any number.
    """
    entries = F.array_sort(F.collect_list(F.struct(path_order(F.col("path")).alias("order"), "path", "sha256")))
    return files.agg(F.sha2(F.array_join(F.transform(entries, lambda e: F.concat(e["path"], e["sha256"])), "").cast("binary"), 256).alias("sha256"))


def _read_on(rows: pa.Table) -> pa.Table:
    """A folder's state (piece -1, if there is one) and its next pieces, as the state behind them."""
    state = sha256.START
    rows = rows.sort_by("piece")
    for piece, content in zip(rows["piece"], rows["content"], strict=True):
        state = content.as_py() if piece.as_py() < 0 else sha256.read_on(state, content.as_py())
    return pa.table({"folder": rows["folder"][:1], "files": [sum(rows["files"].to_pylist())], "content": [state], "sha256": [sha256.hex_digest(state)]})


def folder_digests(files: DataFrame) -> DataFrame:
    """(folder, files, sha256): the digest of each folder's own files, by name.

    Files are sorted by the cluster and cut into pieces. A folder inside of one piece is one row; of larger ones, one task
    after the other reads ``ROUND_BYTES``, all folders at a time, and hands on the state of the hash. So no task holds a
    folder of any size, but its digest, that of one sequence, takes as long as reading it does.
    """
    spark = files.sparkSession
    ship(spark)
    folder = F.array_join(F.slice(path_order(F.col("path")), F.lit(1), F.size(path_order(F.col("path"))) - 1), "/")
    order = ["folder", "path", "sha256"]
    rows = files.select(folder.alias("folder"), "path", "sha256").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("piece", F.shiftright(F.monotonically_increasing_id(), PIECE_BITS)).repartition("piece")
    entries = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    content = F.array_join(F.transform(entries, lambda e: F.concat(e["path"], e["sha256"])), "").cast("binary")
    rows = rows.groupBy("piece", "folder").agg(F.count("*").alias("files"), content.alias("content")).withColumn("bytes", F.length("content"))
    table = f"{shared_folder(spark)}/pieces-{uuid.uuid4().hex}"
    rows.write.partitionBy("piece").parquet(table)
    pieces = spark.read.schema(rows.schema).parquet(table)

    own = Window.partitionBy("folder")
    before = F.coalesce(F.sum("bytes").over(own.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = pieces.select(F.col("folder").alias("of"), F.col("piece").alias("at"), (F.count("*").over(own) > 1).alias("several"), F.floor(before / ROUND_BYTES).alias("round"))
    places = cut(places.where("several"))  # a row a piece, of large folders only
    here = F.col("folder").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("at"))
    small = pieces.join(F.broadcast(places), here, "left_anti").select("folder", "files", F.sha2("content", 256).alias("sha256"))
    states = None
    for (k,) in places.select("round").distinct().orderBy("round").collect():
        now = places.where(F.col("round") == k)
        some = pieces.where(F.col("piece").isin([r["at"] for r in now.select("at").distinct().collect()]))
        some = some.join(F.broadcast(now), here).select("folder", "piece", "files", "content")
        if states is not None:
            some = some.union(states.select("folder", F.lit(-1).cast("long"), "files", "content"))
        states = cut(some.groupBy("folder").applyInArrow(_read_on, "folder string, files long, content binary, sha256 string"))
    return small if states is None else small.union(states.select("folder", "files", "sha256"))


def streamed_digest(files: DataFrame) -> str:
    """What ``digest`` gives, for listings of any length: sorted by the cluster, and hashed as rows come in, partition by partition."""
    import hashlib

    out = hashlib.sha256()
    for row in files.select("path", "sha256").orderBy(path_order(F.col("path"))).toLocalIterator():
        out.update((row["path"] + row["sha256"]).encode())
    return out.hexdigest()


def mapped_annotations(annotations: DataFrame, categories: DataFrame, policy: Policy) -> DataFrame:
    """annotations (category_id, ...) with what the policy says of their category's name: ``action`` and ``target``."""
    decided = categories.select(F.col("id").alias("category_id"), policy.apply(F.col("name")).alias("x"))
    # A row a class goes to all tasks: dealt by category, all annotations of one would be sorted by one task.
    return annotations.join(F.broadcast(decided), "category_id", "left").select(*annotations.columns, F.coalesce("x.action", F.lit(policy.unknown)).alias("action"), F.col("x.target").alias("target"))


def kept_images(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Images with at least one mapped annotation."""
    return dealt(images, "id").join(dealt(annotations.where("action = 'map'").select(F.col("image_id").alias("id")), "id"), "id", "left_semi")
