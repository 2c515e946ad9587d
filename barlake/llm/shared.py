"""Small helpers the operators share: column access, ASCII case, cut points."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Character class shared by several contracts: ASCII space and \t \n \v \f \r.
ASCII_SPACE = r"[\x20\x09-\x0D]+"
# Spark's setting that deletes a query's shuffle files at its end.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def col(name: str) -> Column:
    """Column by its exact name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are.

    ``lower`` does exactly that on all-ASCII text, which is recognised by
    its byte length; the slower ``translate`` is left for the rest.
    """
    return (F.when(F.length(c) == F.octet_length(c), F.lower(c))
            .otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase)))


def fold_of(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % buckets


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, as a machine-local folder would
    not be seen by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/barlake-llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, free_shuffles: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    ``free_shuffles`` lets Spark delete the write's shuffle files when it has
    ended, which saves disk where a shuffle is as large as the input.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true" if free_shuffles else before)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
