"""The blocked (symbol, time-block) window equals the plain per-symbol window."""
import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barlake.operators.windows import blocked_window, time_block


def _series(spark, seed, n_symbols=5):
    rng = random.Random(seed)
    rows = []
    for s in range(n_symbols):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 60))
        for _ in range(rng.randint(1, 120)):
            day += dt.timedelta(days=rng.choice([1, 1, 1, 2, 3, 17, 40]))
            rows.append((f"S{s}", day, round(rng.uniform(1, 100), 2)))
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def _compute(k_before, k_after):
    def compute(df, w):
        frame = w.rowsBetween(-k_before, k_after)
        # lag looks one row back, so it is only valid when the halo reaches back
        prev = F.lag("close", 1).over(w) if k_before > 0 else F.lead("close", 1).over(w)
        return df.select("*", F.sum("close").over(frame).alias("s"),
                         F.count("close").over(frame).alias("c"),
                         prev.alias("p"),
                         F.collect_list("close").over(frame).alias("l"))
    return compute


@pytest.mark.parametrize("seed,unit,before,after", [
    (1, "month", 2, 0), (2, "month", 5, 5), (3, "year", 2, 0), (4, "day", 3, 2), (5, "month", 0, 4),
])
def test_blocked_equals_plain(spark, seed, unit, before, after):
    df = _series(spark, seed)
    got = blocked_window(df, "symbol", "date", time_block("date", unit), before, after,
                         _compute(before, after))
    want = _compute(before, after)(df, Window.partitionBy("symbol").orderBy("date"))
    key = ["symbol", "date"]
    g = sorted(tuple(r) for r in got.orderBy(*key).collect())
    w = sorted(tuple(r) for r in want.orderBy(*key).collect())
    assert g == w


def test_tails_use_group_limit(spark):
    df = _series(spark, 9)
    got = blocked_window(df, "symbol", "date", time_block("date", "month"), 2, 0, _compute(2, 0))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_blocked_row_number_equals_row_number(spark):
    from barlake.operators.windows import blocked_row_number
    df = _series(spark, 11)
    got = blocked_row_number(df, "symbol", "date", time_block("date", "month"), "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("symbol").orderBy("date")))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
