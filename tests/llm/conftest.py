"""Small documents that hold every edge: nulls, empty and long texts, ties, repeats, clashing columns."""
import random

import pytest

from pyspark.sql import functions as F

WORDS = "the and of stone river Light é ñandú 42 token copper wind a.b forest under bridge".split()


def prose(n, seed):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): duplicates, null ids, null and empty texts, a long text, repeated rows."""
    rows = [(i, prose(5 + i % 40, i // 3)) for i in range(90)]
    rows += [(100, None), (101, ""), (102, "  \t\n "), (103, "one"), (104, "two words"), (105, "   one  "),
             (106, prose(30000, 7)), (107, "x" * 50000), (None, prose(12, 1)), (None, "null id"),
             (108, "same row"), (108, "same row"), (109, "same  row"), (110, "ÀÉ ÀÉ ÀÉ"), (111, "àé àé àé")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with columns whose names clash with what the operators add."""
    df = spark.createDataFrame(edge_rows, "doc_id bigint, text string").repartition(3)
    clash = ["kept", "keep_id", "score", "id", "row", "start", "n_tokens", "fp", "win", "_id", "_sha", "a.b"]
    return df.select("*", *[F.lit("x").alias(c) for c in clash], F.lit(None).cast("string").alias("lang"),
                     F.lit(None).cast("string").alias("source"), F.lit(None).cast("bigint").alias("n_chars"))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
