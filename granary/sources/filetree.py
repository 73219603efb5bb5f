"""A Python data source that lists the files below a folder, as a table or as a stream.

Spark's own readers skip files without content, which here mean "no objects" or "not yet annotated"; this one keeps
them. Folders are cut into ranges of names with about as many files and bytes each, and small ones are put together, so
that neither one large folder nor thousands of small ones are one task's or a task each. Contents are only read if asked
for. The root has to be readable on every executor, as a mounted folder is.

As a stream, a batch has the files that came (or were written anew and renamed) in a span of time, by the clock of the
file system; the offset is a point in time, however many files there are, and folders that haven't changed aren't looked
at again.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from granary.functions import paths

#: Files and bytes of a task, about, and entries that the driver looks at before it leaves whole folders to tasks.
FILES, BYTES, ENTRIES = 5_000, 128 << 20, 500_000
#: Nanoseconds that a file has to be there before a stream takes it, as clocks and writers aren't exact.
SETTLE = 2_000_000_000


@dataclass
class Names:
    """The files of a folder (relative to the root) from one name to another; deep: all below it instead."""

    folder: str
    first: str = ""
    last: str = ""
    deep: bool = False


class Tree:
    """What readers of tables and streams share."""

    def __init__(self, options):
        self.root = options["path"]
        self.content = str(options.get("content", "false")).lower() == "true"
        self.endings = tuple(e for e in options.get("endings", "").split(",") if e)
        self.files, self.bytes = int(options.get("files", FILES)), int(options.get("bytes", BYTES))

    def _wanted(self, name: str) -> bool:
        return not self.endings or name.lower().endswith(self.endings)

    def ranges(self, since: int | None = None) -> list[InputPartition]:
        """The tasks of a listing. since: leave out the files of folders that haven't changed after that time."""
        out: list[list[Names]] = [[]]
        count = size = looked = 0
        queue = [""] if os.path.isdir(self.root) else []

        def put(part: Names, n: int, b: int) -> None:
            nonlocal count, size
            if out[-1] and (count + n > self.files or size + b > self.bytes):
                out.append([])
                count = size = 0
            out[-1].append(part)
            count, size = count + n, size + b

        while queue:
            folder = queue.pop(0)
            if looked > ENTRIES:
                put(Names(folder, deep=True), self.files, self.bytes)
                continue
            full = os.path.join(self.root, folder)
            own = since is None or max(os.stat(full).st_mtime_ns, os.stat(full).st_ctime_ns) > since
            names, folders = [], []
            for e in os.scandir(full):
                looked += 1
                if e.is_dir(follow_symlinks=False):
                    folders.append(os.path.join(folder, e.name))
                elif own and self._wanted(e.name):
                    names.append((e.name, e.stat().st_size if self.content else 0))
            queue += sorted(folders)
            names.sort()
            start = n = b = 0
            for i, (_, length) in enumerate(names):
                if n and (n >= self.files or b + length > self.bytes):
                    put(Names(folder, names[start][0], names[i - 1][0]), n, b)
                    start, n, b = i, 0, 0
                n, b = n + 1, b + length
            if n:
                put(Names(folder, names[start][0], names[-1][0]), n, b)
        return [InputPartition(part) for part in out if part]

    def rows(self, part: list[Names], after: int = 0, until: int | None = None) -> Iterator[tuple]:
        """(path, length, content) of the files of a task; after, until: only those that came in that span of time."""
        for own in part:
            for folder, folders, names in os.walk(os.path.join(self.root, own.folder)):
                folders.sort()
                if not own.deep:
                    folders.clear()
                for name in sorted(names):
                    if not self._wanted(name) or not own.deep and not own.first <= name <= own.last:
                        continue
                    full = os.path.join(folder, name)
                    if until is not None:
                        try:
                            came = os.stat(full).st_ctime_ns
                        except FileNotFoundError:
                            continue
                        if not after < came <= until:
                            continue
                    content = None
                    if self.content:
                        with open(full, "rb") as f:
                            content = f.read()
                    yield os.path.relpath(full, self.root).replace(os.sep, "/"), os.path.getsize(full), content


class FileTree(DataSource):
    """Options: path (the root), content (true to read contents), endings (comma-separated, lower case; none for all), files and bytes (of a task, about)."""

    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self) -> str:
        return "path string, length long, content binary"

    def reader(self, schema) -> FileTreeReader:
        return FileTreeReader(self.options)

    def streamReader(self, schema) -> FileTreeStream:  # noqa: N802
        return FileTreeStream(self.options)


class FileTreeReader(Tree, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.ranges() or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.rows(partition.value)


class FileTreeStream(Tree, DataSourceStreamReader):
    last: int | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"until": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        """Now, or what it was if no folder has changed since, so that there is no batch."""
        if self.last is None or self.ranges(since=self.last):
            self.last = time.time_ns() - SETTLE
        return {"until": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        span = (start["until"], end["until"])
        return [InputPartition((p.value, *span)) for p in self.ranges(since=start["until"])] or [InputPartition(([], *span))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        part, after, until = partition.value
        yield from self.rows(part, after, until)


def listing(spark: SparkSession, root: str, content: bool = False, endings: tuple[str, ...] = ()) -> DataFrame:
    """(path relative to root, length, content): all files below root, empty ones too; no rows if there is no root."""
    spark.dataSource.register(FileTree)
    return spark.read.format("filetree").options(path=root, content=str(content).lower(), endings=",".join(endings)).load()


def stream(spark: SparkSession, root: str, content: bool = False, endings: tuple[str, ...] = ()) -> DataFrame:
    """``listing`` as a stream: each file once, when it has come. Rewriting a file in its place isn't coming; renaming a new one over it is."""
    spark.dataSource.register(FileTree)
    return spark.readStream.format("filetree").options(path=root, content=str(content).lower(), endings=",".join(endings)).load()


def images(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """Images outside blocked folders, with ``label``, the normalized name of their folder."""
    from granary.functions.labels import normalize_label

    found = listing(spark, root, content, paths.IMAGE_ENDINGS).where(paths.is_image(F.col("path")) & ~paths.is_blocked(F.col("path")))
    return found.withColumn("label", normalize_label(paths.parent_name(F.col("path"))))


def label_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, content as text) of label files."""
    found = listing(spark, root, True, (".txt",))
    return found.select("path", F.decode("content", "UTF-8").alias("content"))


def split_first(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Images and labels of a dataset laid out as split/images and split/labels, with split and stem."""
    def part(kind: str, endings: tuple[str, ...], content: bool) -> DataFrame:
        found = listing(spark, root, content, endings).where(F.lower(F.get(paths.parts(F.col("path")), F.lit(1))) == kind)
        return found.withColumns({"split": paths.split_of(F.col("path")), "stem": paths.stem(F.col("path"))})

    return part("images", paths.IMAGE_ENDINGS, False), part("labels", (".txt",), True).withColumn("content", F.decode("content", "UTF-8"))


def negatives_of(files: DataFrame, allowed: list[int], blocked: list[int]) -> DataFrame:
    """Label files (path, content) that hold allowed classes only, at least one of them, and none that is blocked."""
    from granary.functions import boxes, numbers

    ids = F.transform(boxes.lines(F.col("content")), lambda line: numbers.truncated_class(F.get(boxes.tokens(line), F.lit(0))))
    inside = F.forall(ids, lambda x: x.isin(*allowed)) & ~F.exists(ids, lambda x: x.isin(*blocked)) if blocked else F.forall(ids, lambda x: x.isin(*allowed))
    return files.where((F.size(ids) > 0) & F.coalesce(inside, F.lit(False)))


def with_images(labels: DataFrame, images: DataFrame) -> DataFrame:
    """Label files (split, stem, ...) with the ``image`` (path) of their split and stem: a .jpg, else the first by name; only images count."""
    place = F.struct((F.lower(paths.suffix(F.col("path"))) != ".jpg").alias("other"), "path")
    first = images.groupBy("split", "stem").agg(F.min(place)["path"].alias("image"))
    return labels.join(first, ["split", "stem"]).where(paths.is_image(F.col("image")))


def in_order(files: DataFrame) -> DataFrame:
    """Files by path, whatever the letters' case; equal ones by their letters."""
    return files.orderBy(F.lower("path"), "path")
