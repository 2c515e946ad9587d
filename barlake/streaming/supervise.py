"""Keep a stream going over failures (ST5): bounded restarts, and quarantine of files that cannot be read.

A run that fails is started again from its checkpoint, which plans the same
batch once more.  If that batch's input files are to blame they are found by
bisection (one read of the batch, and one per half that fails), moved aside
whole and named, and the batch goes on with all its other files.  A failure
that no file explains is retried a bounded number of times.
"""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from barlake.schema import CYCLE_ENVELOPE_SCHEMA
from barlake.streaming.commits import Files
from barlake.streaming.ingest import run_to_end, unfinished_batch

# How Spark names the failure to read a file.
READ_FAILURES = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "FileNotFoundException")


@dataclass
class Report:
    """What it took: restarts without a file to blame, and (old, new) paths of quarantined files."""
    restarts: int = 0
    quarantined: list[tuple[str, str]] = field(default_factory=list)


def planned_files(spark: SparkSession, checkpoint: str, batch: int) -> list[str]:
    """The input files that a file stream's checkpoint lists for a batch."""
    log = Files(spark, checkpoint)
    files = []
    for source in log.names("sources"):
        names = log.names(f"sources/{source}")
        # every tenth list is a compact one of all batches so far
        name = next((n for n in (str(batch), f"{batch}.compact") if n in names), None)
        if name is None:
            continue
        for line in log.read(f"sources/{source}/{name}").splitlines()[1:]:  # the first line is a version
            entry = json.loads(line)
            if entry.get("batchId", batch) == batch:
                files.append(entry["path"])
    return files


def unreadable(spark: SparkSession, files: list[str], schema=CYCLE_ENVELOPE_SCHEMA) -> list[str]:
    """The files that cannot be read, by bisection: as many passes as the damage needs, none over what is sound."""
    if not files:
        return []
    try:
        (spark.read.schema(schema).option("ignoreCorruptFiles", False).option("ignoreMissingFiles", True)
         .parquet(*files).write.format("noop").mode("overwrite").save())
        return []
    except Exception as error:  # raised again unless a file is to blame
        if not any(name in str(error) for name in READ_FAILURES):
            raise
        if len(files) == 1:
            return files
    half = len(files) // 2
    return unreadable(spark, files[:half], schema) + unreadable(spark, files[half:], schema)


def move_aside(spark: SparkSession, file: str, quarantine: str) -> str:
    """Move a file into the quarantine folder, under a name that tells where it was."""
    store = Files(spark, quarantine)
    store.fs.mkdirs(store.path())
    old = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))  # the checkpoint keeps URIs
    name = f"{zlib.crc32(old.getParent().toString().encode()):08x}-{old.getName()}"
    if not store.fs.rename(old, store.path(name)):
        raise OSError(f"could not move {file} aside")
    return f"{quarantine}/{name}"


def run_supervised(spark: SparkSession, start: Callable[[bool], StreamingQuery], checkpoint: str, quarantine: str,
                   retries: int = 3, pause_s: float = 1.0, timeout_s: int = 600) -> Report:
    """Run a file stream to the end of its input, over failures.

    ``start(skip_missing)`` starts the checkpointed query; with
    ``skip_missing`` it must read past files that are gone, which is asked for
    only once files were quarantined.  Raises the last failure after
    ``retries`` restarts that no file explains.
    """
    report = Report()
    while True:
        try:
            run_to_end(start(bool(report.quarantined)), timeout_s)
            return report
        except Exception:
            batch = unfinished_batch(spark, checkpoint)
            bad = unreadable(spark, planned_files(spark, checkpoint, batch)) if batch is not None else []
            if bad:
                report.quarantined += [(f, move_aside(spark, f, quarantine)) for f in bad]
                continue
            if report.restarts >= retries:
                raise
            time.sleep(pause_s * 2 ** report.restarts)
            report.restarts += 1
