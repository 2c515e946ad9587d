"""One folder of CSV files per value of a column, as ``partitionBy(column)`` lays them out.

Spark's writer is made for few large files.  Where Hadoop's native library is
missing, its local file system starts a process for each folder and each file
it creates, two per file and one per folder, which is nearly all the time such
a write takes.  On that file system the tasks write the files themselves: the
lines are Spark's (``to_csv``), the folders' names, the packing and the
checksum files are the same.  On every other store, and for names that are
not ASCII (whose bytes depend on the JVM's locale), Spark's writer does it.

A task writes below a hidden folder of its own.  Only folders of tasks that
succeeded are moved in place, when all of them have, so that an attempt that
failed or ran twice leaves nothing.
"""

from __future__ import annotations

import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL = ("org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.hive.ql.io.ProxyLocalFileSystem")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
SUMS = b"crc\0"  # how a file of checksums begins
SUM_BYTES = 512  # bytes per checksum
WRITTEN = pa.schema([("folder", pa.string()), ("left", pa.bool_())])


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on this machine, if Spark's local file system is its store."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(context._jsc.hadoopConfiguration())
    return fs.makeQualified(at).toUri().getPath() if fs.getClass().getName() in LOCAL else None


def read_checked(path: str) -> bytes:
    """A file's bytes; raises ``EOFError`` if they don't fit the checksums beside it, where there are any."""
    with open(path, "rb") as file:
        data = file.read()
    folder, name = os.path.split(path)
    try:
        with open(f"{folder}/.{name}.crc", "rb") as file:
            sums = file.read()
    except OSError:
        return data
    if sums[:4] != SUMS or len(sums) < 8:
        return data
    size = max(1, struct.unpack(">i", sums[4:8])[0])
    if sums[8:] != b"".join(zlib.crc32(data[at:at + size]).to_bytes(4, "big") for at in range(0, len(data), size)):
        raise EOFError("checksum error")
    return data


def folder_name(column: str, value: str | None) -> str:
    """Name of the folder of a value, escaped as Spark does."""
    def escaped(text: str) -> str:
        return ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text)

    return f"{escaped(column)}={escaped(value) if value else NO_VALUE}"


class Checked:
    """A new file with its checksums beside it, as Hadoop's local file system reads and writes them."""

    def __init__(self, folder: str, name: str):
        self.file, self.sums_at = open(f"{folder}/{name}", "wb"), f"{folder}/.{name}.crc"
        self.sums, self.rest = bytearray(SUMS + struct.pack(">i", SUM_BYTES)), b""

    def write(self, data: bytes) -> None:
        self.file.write(data)
        data = self.rest + data
        whole = len(data) - len(data) % SUM_BYTES
        for at in range(0, whole, SUM_BYTES):
            self.sums += zlib.crc32(data[at:at + SUM_BYTES]).to_bytes(4, "big")
        self.rest = data[whole:]

    def close(self) -> None:
        self.file.close()
        if self.rest:
            self.sums += zlib.crc32(self.rest).to_bytes(4, "big")
        with open(self.sums_at, "wb") as sums:
            sums.write(self.sums)


def write_groups(staged: str, column: str, header: bytes, packed: bool, job: str) -> Callable:
    """Task that writes (value, line) rows, sorted by value, and returns its folder and whether it left rows."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own, left = f"{staged}/{part:05d}-{uuid.uuid4().hex}", False
        name = f"part-{part:05d}-{job}.c000.csv" + (".gz" if packed else "")
        rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        os.makedirs(own)
        # a null and an empty value have the same folder, and follow each other
        for value, group in groupby(rows, lambda row: row[0] or None):
            if value and not value.isascii():
                left = True
                continue
            folder = f"{own}/{folder_name(column, value)}"
            os.mkdir(folder)
            out = Checked(folder, name)
            pack = zlib.compressobj(wbits=31) if packed else None
            lines, size = [header], 0
            for _, line in group:
                lines.append(line)
                size += len(line)
                if size > 1 << 20:
                    data = b"\n".join([*lines, b""])
                    out.write(pack.compress(data) if pack else data)
                    lines, size = [], 0
            data = b"\n".join([*lines, b""]) if lines else b""
            out.write(pack.compress(data) + pack.flush() if pack else data)
            out.close()
        yield pa.RecordBatch.from_pylist([{"folder": own, "left": left}], WRITTEN)

    return of


def moved_in(source: str, target: str) -> None:
    """Move the folders of ``source`` below ``target``, their files into those that exist."""
    for folder in os.scandir(source):
        try:
            os.rename(folder.path, f"{target}/{folder.name}")
        except OSError:  # not empty: another task wrote it too
            for file in os.scandir(folder.path):
                os.rename(file.path, f"{target}/{folder.name}/{file.name}")


def write_folders(rows: DataFrame, path: str, column: str, packed: bool = False) -> None:
    """Replace ``path`` by a folder of CSV files with headers per value of the text ``column``.

    ``rows`` must have each value in one partition if it is to get one file.
    """
    def by_spark(some: DataFrame, mode: str) -> None:
        (some.write.mode(mode).partitionBy(column).option("header", True)
         .option("compression", "gzip" if packed else "none").csv(path))

    root, job = local_path(rows.sparkSession, path), str(uuid.uuid4())
    if root is None:
        by_spark(rows, "overwrite")
        return
    staged = f"{root}/_temporary-{job}"
    names = [c for c in rows.columns if c != column]
    header = rows.sparkSession.range(1).select(F.to_csv(F.struct(*[F.lit(c) for c in names]))).first()[0]
    lines = (rows.sortWithinPartitions(column)
             .select(F.col(column).cast("string").alias("value"), F.to_csv(F.struct(*names)).cast("binary").alias("line")))
    os.makedirs(staged)
    try:
        tasks = lines.mapInArrow(write_groups(staged, column, header.encode(), packed, job),
                                 "folder string, left boolean").collect()
        for name in os.listdir(root):  # what was there before
            old = f"{root}/{name}"
            if old != staged:
                shutil.rmtree(old) if os.path.isdir(old) and not os.path.islink(old) else os.remove(old)
        for task in tasks:
            moved_in(task["folder"], root)
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    if any(task["left"] for task in tasks):
        by_spark(rows.where(F.col(column).cast("string").rlike(r"[^\x00-\x7F]")), "append")
    Checked(root, "_SUCCESS").close()
