"""CSV files of a folder: their headers, which can be read, and their rows bound by name.

Everything is read by Spark's own readers in the tasks, which reach any store;
the driver opens no file.  One list of files serves every step: all data files
below the folder, sub-folders included, whatever their compression and column
order.

Few files, large ones and odd ones are read so:

1. :func:`first_lines`: a text scan of the files, in which the first line of a
   file's first split is its header; a task reads many small files.  The
   scan goes to the end of each file, so it also proves that the file can be
   read at all.
2. :func:`inspect`: headers that bind, and rejects with a reason.  If files
   may be skipped, a scan that fails is repeated without the file that the
   error names, in two halves, until what is left reads to the end: a damaged
   file gives no row and one reject, and costs a reread of its own group.
3. :func:`rows_by_name`: one CSV scan per column order, united by name.

Spark's text and CSV readers copy the whole configuration and build a parser
for each file, some milliseconds a file.  Of more than ``FEW`` files, the
small plain and gzip ones are therefore read whole, thousands by a task, and
unpacked and cut into lines there; ``from_csv`` is the same parser, built once
a task.  The driver gets the column orders, the rejects and the paths of the
other files.  More than ``MANY`` files of the local file system are also listed
and opened by the tasks: a listing in the driver's memory takes more than a
kilobyte per file.
"""

from __future__ import annotations

import csv
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.session import scratch_path
from barlake.sources.folder_files import local_path, read_checked


@dataclass
class CsvFiles:
    """Files by their column names, in header order, and (file, reason) of those left out."""
    groups: dict[tuple[str, ...], list[str]] = field(default_factory=dict)
    rejects: list[tuple[str, str]] = field(default_factory=list)
    small: DataFrame | None = None  # files read whole, with those of the rejects that are small
    orders: list[tuple[str, ...]] = field(default_factory=list)  # their columns' orders


FEW, MANY = 256, 1 << 14
SMALL_BYTES = 1 << 20
SMALL_NAMES = r"\.csv(\.gz)?$"
TASK_FILES, TASK_BYTES = 1 << 12, 1 << 25
MANY_FOLDERS = 1 << 10  # so many in one are listed by other tasks
SPLITS = 32  # of Spark's scan, each of some 30 small files with its default settings, read by one task
CHUNK_BYTES, CHUNK_LINES = 1 << 20, 1 << 14
MARK = b"\xef\xbb\xbf"  # UTF-8 byte order mark
SPACES = bytes(range(33))  # what Java's trim removes
UNREADABLE = "cannot be read to its end"

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Spark's listing of many paths as a few tasks per core, instead of a task per path."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def below(spark: SparkSession, path: str) -> DataFrame:
    """All data files below ``path`` that are not empty; hidden files and folders are left out."""
    with listing(spark):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False)
                .load(path).where("length > 0"))


def paths_of(files: DataFrame) -> list[str]:
    return sorted(r[0] for r in files.select("path").collect())  # the content is not read


def listed(spark: SparkSession, path: str) -> list[str]:
    """The paths of :func:`below`."""
    return paths_of(below(spark, path))


def as_glob(file: str) -> str:
    """The path with the characters escaped that Spark's readers take as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", file)


def first_lines(spark: SparkSession, files: list[str]) -> list[tuple[str, str]]:
    """(file, header line) of all files, read to their ends; files of blank lines only have none."""
    own = spark.newSession()  # for settings that hold for this scan only
    own.conf.set("spark.sql.files.ignoreCorruptFiles", False)
    own.conf.set("spark.sql.files.ignoreMissingFiles", False)
    with listing(own):
        text = own.read.text([as_glob(f) for f in files])
    lines = (text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
             .where((F.col("at") == 0) & (F.trim(F.regexp_replace("value", "﻿", "")) != "")))
    # a split is read in order by one task, so its lines are numbered in order
    heads = (lines.withColumn("number", F.monotonically_increasing_id())
             .groupBy("file").agg(F.min_by("value", "number").alias("value")))
    return [(unquote(r["file"]), r["value"]) for r in heads.collect()]  # one row per file, as the listing


def names_of(line: str) -> tuple[str, ...]:
    """Column names of a header line."""
    return tuple(n.strip() for n in next(csv.reader([line.lstrip("﻿")]), []))


def unreadable(error: Exception, files: list[str]) -> list[str]:
    """The files that a failed scan names as damaged or gone."""
    text = str(error)
    if "FAILED_READ_FILE" not in text and "FileNotFoundException" not in text and "PATH_NOT_FOUND" not in text:
        return []
    named = {unquote(p) for p in re.findall(r"(?:reading file |file: ?|path does not exist: ?|File )(\S+)", text)}
    bare = {re.sub(r"^\w+:/*", "/", n.rstrip(".,;")) for n in named}
    return [f for f in files if re.sub(r"^\w+:/*", "/", f) in bare]


def readable_first_lines(spark: SparkSession, files: list[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """(header lines of the files that read to their end, the other files)."""
    heads, bad, todo = [], [], [files] if files else []
    while todo:
        group = todo.pop()
        try:
            heads += first_lines(spark, group)
        except Exception as error:  # raised again unless it is a file's fault
            lost = unreadable(error, group)
            if not lost and "FAILED_READ_FILE" not in str(error):
                raise
            if not lost and len(group) == 1:
                lost = group
            bad += lost
            rest = [f for f in group if f not in set(lost)]
            half = (len(rest) + 1) // 2
            todo += [part for part in (rest[:half], rest[half:]) if part]
    return heads, bad


def lacking(names: Sequence[str], wanted: Sequence[str]) -> str | None:
    """Why a file with these columns is left out, if it is."""
    wrong = [c for c in wanted if names.count(c) != 1]
    return "lacks or repeats " + ", ".join(wrong) if wrong else None


# --- small files, read whole ---------------------------------------------------------
LISTED = pa.schema([("path", pa.string()), ("length", pa.int64())])
FOLDER = -1  # instead of a length


def hidden(name: str) -> bool:
    """Files and folders that Spark's readers leave out."""
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


def walk(folder: str, most: float = MANY_FOLDERS) -> Iterator[tuple[str, int]]:
    """(path, length) of the files below that are not empty; folders of one with ``most`` are left to the caller."""
    todo = [folder]
    while todo:
        with os.scandir(todo.pop()) as entries:
            folders = []
            for entry in entries:
                try:
                    if entry.is_dir():
                        if not hidden(entry.name) or entry.name.startswith(("_metadata", "_common_metadata")):
                            folders.append(entry.path)
                    elif not hidden(entry.name) and (length := entry.stat().st_size):
                        yield entry.path, length
                except FileNotFoundError:  # a link to nothing, or gone by now
                    pass
        if len(folders) < most:
            todo += folders
        else:
            yield from ((f, FOLDER) for f in folders)


def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task that lists what is below folders."""
    for batch in batches:
        found = ((path, length) for folder in batch.column(0).to_pylist() for path, length in walk(folder))
        while part := list(islice(found, CHUNK_LINES)):
            paths = [os.fsencode(path).decode(errors="replace") for path, _ in part]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([n for _, n in part], pa.int64())],
                                             schema=LISTED)


def many_local(spark: SparkSession, path: str) -> DataFrame | None:
    """The listing of :func:`below`, kept as a table, if these are more than ``MANY`` files of the local file system.

    It is made in rounds: folders of a folder with very many are shared out
    among the tasks of the next.
    """
    root = None if re.search(r"[\\*?\[\]{}]", path) else local_path(spark, path)
    if root is None or not os.path.isdir(root):
        return None
    if len(list(islice(walk(root, float("inf")), MANY + 1))) <= MANY:
        return None
    try:
        table = scratch_path(spark, "csv_listing")
    except RuntimeError:  # no folder that all executors share
        return None
    folders, tasks, done = spark.createDataFrame([(root,)], "path string"), 1, 0
    while True:
        folders.repartition(tasks).mapInArrow(list_folders, "path string, length long").write.parquet(f"{table}/{done}")
        folders = spark.read.parquet(f"{table}/{done}").where(F.col("length") == FOLDER).select("path")
        left = folders.count()
        if not left:
            break
        done, tasks = done + 1, max(4 * spark.sparkContext.defaultParallelism, left // TASK_FILES)
    files = (spark.read.parquet(*[f"{table}/{i}" for i in range(done + 1)]).where(F.col("length") != FOLDER)
             .select(F.concat(F.lit("file:"), "path").alias("path"), "length"))
    return files.withColumn("content", F.lit(None).cast("binary"))  # the tasks that need it open the file


def shared_out(spark: SparkSession, files: DataFrame, local: bool) -> tuple[DataFrame, int]:
    """The files, and in how many tasks they are read."""
    least = 4 * spark.sparkContext.defaultParallelism
    if not local:
        return files, max(least, files.select("path").rdd.getNumPartitions() // SPLITS)
    count, size = files.agg(F.count("path"), F.sum("length")).first()
    tasks = max(least, count // TASK_FILES, size // TASK_BYTES)
    return files.repartition(tasks), tasks


def content_of(path: str, content: pa.BinaryScalar) -> bytes:
    return content.as_py() if content.is_valid else read_checked(path.removeprefix("file:"))


def unpacked(path: str, content: bytes) -> Iterator[bytes]:
    """The file's bytes; raises ``EOFError`` or ``zlib.error`` if its packed data are not whole."""
    if not path.endswith(".gz"):
        yield content
        return
    while content:  # one or more packed parts
        unpack = zlib.decompressobj(wbits=31)
        while not unpack.eof:
            chunk = unpack.decompress(content, CHUNK_BYTES)
            content = unpack.unconsumed_tail
            if chunk:
                yield chunk
            elif not content and not unpack.eof:
                raise EOFError("packed data end too early")
        content = unpack.unused_data


def lines_of(chunks: Iterable[bytes]) -> Iterator[list[bytes]]:
    """The lines, ended by \\n, \\r or both as Spark's readers have it; a byte order mark at the start is left out."""
    rest, start = b"", True
    for chunk in chunks:
        rest += chunk
        if start and len(rest) < len(MARK):
            continue
        if start:
            rest, start = rest.removeprefix(MARK), False
        at = max(rest.rfind(b"\n"), rest.rfind(b"\r", 0, -1)) + 1
        yield rest[:at].splitlines()
        rest = rest[at:]
    yield rest.splitlines()


def header_and_rows(path: str, content: bytes) -> Iterator[tuple[tuple[str, ...] | None, list[bytes]]]:
    """(column names, lines) of a file, part by part; no names and no lines as long as it is blank."""
    names = None
    for lines in lines_of(unpacked(path, content)):
        if names is None:
            head = next((i for i, line in enumerate(lines) if line.replace(MARK, b"").strip(b" ")), None)
            if head is None:
                continue
            names, lines = names_of(lines[head].decode(errors="replace")), lines[head + 1:]
        yield names, [line for line in lines if line.strip(SPACES)]


CHECKED = pa.schema([("file", pa.string()), ("reason", pa.string()), ("names", pa.list_(pa.string()))])


def check_small(wanted: Sequence[str]) -> Callable:
    """Task that reads files to their end: (file, reason) of the rejects, the others' column names once each."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            found = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                names, reason = None, None
                try:
                    for names, _ in header_and_rows(path, content_of(path, content)):
                        pass
                except (OSError, EOFError, zlib.error):
                    reason = UNREADABLE
                if reason or names is not None and (reason := lacking(names, wanted)):
                    found.append({"file": path, "reason": reason, "names": None})
                elif names is not None and names not in seen:
                    seen.add(names)
                    found.append({"file": None, "reason": None, "names": names})
            yield pa.RecordBatch.from_pylist(found, CHECKED)

    return of


def rows_of_small(orders: list[tuple[str, ...]], left_out: frozenset[str], folders: int) -> Callable:
    """Task that gives (line, number of its column order, values from the file's folders)."""
    number = {names: i for i, names in enumerate(orders)}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [[] for _ in range(2 + folders)]

        def taken() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.int32(), *[pa.string()] * folders]
            names = ["line", "columns", *[f"folder_{i}" for i in range(folders)]]
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)
            for values in out:
                values.clear()
            return batch

        for batch in batches:
            values = zip(*[batch.column(2 + i).to_pylist() for i in range(folders)]) if folders else [()] * len(batch)
            for path, content, of_file in zip(batch.column(0).to_pylist(), batch.column(1), values):
                if path in left_out:
                    continue
                try:
                    for names, lines in header_and_rows(path, content_of(path, content)):
                        if names not in number:
                            raise OSError(f"{path}: its header has changed")
                        for part, value in zip(out, (None, number[names], *of_file)):
                            part.extend(lines if part is out[0] else [value] * len(lines))
                        if len(out[0]) >= CHUNK_LINES:
                            yield taken()
                except (EOFError, zlib.error) as error:
                    raise OSError(f"{path}: {UNREADABLE}") from error
        yield taken()

    return of


def small_rows(files: CsvFiles, wanted: Sequence[str], from_folder: Sequence[str]) -> DataFrame:
    """The rows of the files that are read whole."""
    columns = [f"_{i}" for i in range(max(map(len, files.orders)))]
    folders = [f"folder_{i}" for i in range(len(from_folder))]
    lines = (files.small.select("path", "content", *[folder_value(c, "path").alias(f) for f, c in zip(folders, from_folder)])
             .mapInArrow(rows_of_small(files.orders, frozenset(f for f, _ in files.rejects), len(folders)),
                         ", ".join(["line binary", "columns int", *[f"{f} string" for f in folders]])))
    # the parser drops a byte order mark at the start of the first line it gets, which here may be any line
    fields = F.from_csv(F.concat(F.lit(","), F.col("line").cast("string")),
                        ", ".join(f"{c} string" for c in ["_start", *columns]), {"mode": "PERMISSIVE"})
    # what a generator puts out is not computed again in each expression that uses it
    rows = lines.select("columns", *folders, F.inline(F.array(fields)))

    def bound(name: str) -> Column:
        at = [names.index(name) for names in files.orders]
        if len(set(at)) == 1:
            return F.col(columns[at[0]])
        return F.get(F.array(*[F.col(c) for c in columns]), F.get(F.array(*[F.lit(i) for i in at]), F.col("columns")))

    return rows.select(*[bound(c).alias(c) for c in wanted], *[F.col(f).alias(c) for f, c in zip(folders, from_folder)])


def inspect(spark: SparkSession, path: str, wanted: Sequence[str], skip_unreadable: bool = False) -> CsvFiles:
    """The CSV files below ``path`` by column order, and those that lack or repeat a wanted column.

    A file that can't be read to its end is an error or, with
    ``skip_unreadable``, one of the rejects.
    """
    found, local = CsvFiles(), many_local(spark, path)
    files = below(spark, path) if local is None else local
    others = paths_of(files.limit(FEW + 1))
    if len(others) > FEW:
        is_small = (F.col("length") <= SMALL_BYTES) & F.col("path").rlike(SMALL_NAMES)
        files, tasks = shared_out(spark, files, local is not None)
        small = files.where(is_small).coalesce(tasks)
        try:
            checked = small.select("path", "content").mapInArrow(
                check_small(wanted), "file string, reason string, names array<string>").collect()
        except Exception as error:  # the store's fault: without the files that the errors name, if they may be skipped
            others = paths_of(files.coalesce(tasks))
            if not skip_unreadable or not (unreadable(error, others) or "FAILED_READ_FILE" in str(error)):
                raise
        else:
            bad = [r["file"] for r in checked if r["reason"] == UNREADABLE]
            if bad and not skip_unreadable:
                raise OSError(f"{min(bad)}: {UNREADABLE}")
            found.rejects = [(r["file"], r["reason"]) for r in checked if r["file"] is not None]
            found.orders = sorted({tuple(r["names"]) for r in checked if r["names"] is not None})
            found.small = small if found.orders else None
            others = paths_of(files.where(~is_small).coalesce(tasks))
    heads, bad = (readable_first_lines(spark, others) if skip_unreadable else
                  (first_lines(spark, others) if others else [], []))
    found.rejects += [(f, UNREADABLE) for f in bad]
    for file, line in sorted(heads):
        names = names_of(line)
        reason = lacking(names, wanted)
        if reason:
            found.rejects.append((file, reason))
        else:
            found.groups.setdefault(names, []).append(file)
    found.rejects.sort()
    return found


def folder_value(name: str, path: str | None = None) -> Column:
    """Value of the ``name=value`` folder that the row's file lies in; null if there is none or it is the null folder.

    Folder names and the file's URI both escape characters with ``%``; a
    column ``path`` has the folders' names as they are.
    """
    def unescaped(c: Column) -> Column:
        return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)

    value = F.regexp_extract(path or "_metadata.file_path", f"(?s).*/{re.escape(name)}=([^/]*)/", 1)
    value = unescaped(value if path else unescaped(value))
    return F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), value)


def rows_by_name(spark: SparkSession, files: CsvFiles, wanted: Sequence[str],
                 from_folder: Sequence[str] = ()) -> DataFrame:
    """Text columns ``wanted`` of the files and, from their folders' names, ``from_folder``.

    Files may have their columns in any order and extra ones, whatever these
    are called.  A file that is damaged or gone by now is an error.
    """
    parts = [small_rows(files, wanted, from_folder)] if files.small is not None else []
    for names, group in sorted(files.groups.items()):
        # unwanted columns get names of their own: theirs may be equal
        fields = [n if n in wanted else f"_unwanted_{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in fields])
        with listing(spark):
            rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                    .option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False)
                    .csv([as_glob(f) for f in group]))
        parts.append(rows.select(*wanted, *[folder_value(c).alias(c) for c in from_folder]))
    if not parts:
        return spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.StringType(), True) for c in [*wanted, *from_folder]]))
    return reduce(DataFrame.unionByName, parts)
