"""Mergeable summaries: trend fits from moments, coverage from bitmaps."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.operators import catalog, moments
from barlake.operators.coverage_table import FANOUT, CoverageTable, summary
from barlake.session import scratch_path

START = dt.datetime(1999, 12, 31, 22, 0)


def series():
    """symbol -> (minutes, values): long, short, one and two points, repeated times, constant, far from zero."""
    rnd = random.Random(3)
    long = sorted(rnd.sample(range(500_000), 4000))
    return {"LONG": (long, [1e-9 * m * m - 3e-4 * m + rnd.gauss(50, 5) for m in long]),
            "BIG": (long, [1e9 + 20 * m + rnd.gauss(0, 3) for m in long]),
            "SHORT": ([0, 1, 7], [1.0, 5.0, 2.0]), "ONE": ([5], [4.0]), "TWO": ([3, 2003], [4.0, 10.0]),
            "PAIRS": ([0] * 5 + [90] * 3, [1.0, 2.0, 3.0, 4.0, 5.0, 10.0, 11.0, 12.0]), "SAME": ([9, 9, 9], [1.0, 2.0, 6.0]),
            "FLAT": (list(range(0, 9000, 9)), [7.0] * 1000)}


@pytest.fixture(scope="module")
def minutes(spark):
    rows = [(s, START + dt.timedelta(minutes=m), y) for s, (x, ys) in series().items() for m, y in zip(x, ys)]
    rows += [("LONG", None, 1.0), ("LONG", START, None)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double").repartition(5)


@pytest.mark.parametrize("parts,block", [(1, 1440), (7, 1440), (3, 100), (2, 10_000_000)])
def test_fits_equal_least_squares(minutes, parts, block):
    """However the rows are cut into summaries and these merged, in one go or one after another."""
    kept = None
    for k in range(parts):
        some = minutes.where(F.pmod(F.xxhash64("ts", "close"), F.lit(parts)) == k)
        new = moments.block_moments(some, "ts", 60, block_steps=block)
        kept = moments.merged(new if kept is None else kept.unionByName(new))
    got = {r["symbol"]: r for r in moments.fitted(kept).collect()}
    assert set(got) == set(series())
    for s, (x, ys) in series().items():
        x, y, r = np.array(x, dtype=float), np.array(ys), got[s]
        x -= x.min()
        size = max(1.0, np.abs(y).max())
        line = np.polyfit(x - x.mean(), y, 1) if len(set(x)) > 1 else [0.0, y.mean()]
        assert r["n"] == len(x) and abs(r["slope"] - line[0]) < 1e-9 * size, s
        assert abs(r["linear_last"] - np.polyval(line, x.max() - x.mean())) < 1e-9 * size, s
        if len(set(x)) > 2:
            curve = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x - x.mean(), (x - x.mean()) ** 2]), y, rcond=None)[0]
            for u, name in ((-x.mean(), "quadratic_first"), (x.max() - x.mean(), "quadratic_last")):
                assert abs(r[name] - (curve[0] + curve[1] * u + curve[2] * u * u)) < 1e-8 * size, (s, name)
        else:
            low, high = y[x == x.min()].mean(), y[x == x.max()].mean()
            assert abs(r["quadratic_first"] - low) < 1e-9 and abs(r["quadratic_last"] - high) < 1e-9, s
        if len(x) > 1 and s != "FLAT":
            fit = np.polyval(line, x - x.mean())
            assert abs(r["r2"] - (1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-6, s
    assert got["ONE"]["r2"] is None and got["FLAT"]["r2"] == 1.0


def test_moments_are_reduced_before_the_shuffle(minutes):
    plan = moments.block_moments(minutes, "ts", 60)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_coverage_after_appends_equals_coverage_of_the_bars(spark):
    """Times and days that several appends share count once, rows each; tiers are merged; nulls have no time."""
    rnd = random.Random(7)
    rows = [(rnd.choice(["A", "B", "HOT", "HOT"]), dt.datetime(1969, 12, 1) + dt.timedelta(minutes=rnd.randint(0, 60000)))
            for _ in range(5000)] + [("A", None), ("N", None)]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz")
    table = CoverageTable(spark, scratch_path(spark, "cov"))
    assert table.coverage().collect() == [] and table.symbol_count().first()[0] == 0
    number = F.pmod(F.monotonically_increasing_id(), F.lit(FANOUT + 2))
    numbered = bars.withColumn("k", number).cache()
    for k in range(FANOUT + 2):
        table.append(numbered.where(F.col("k") == k).drop("k"))
    assert sorted(p["tier"] for p in table.log.of_table("coverage")) == [0, 0, 1]
    want = {r["symbol"]: r for r in catalog.coverage(bars).collect()}
    got = {r["symbol"]: r for r in table.coverage().collect()}
    assert set(got) == set(want) and table.symbol_count().first()[0] == len(want)
    for s, r in got.items():
        assert (r["count"], r["unique_times"], r["earliest"], r["latest"], r["time_range_hours"]) == (
            want[s]["count"], want[s]["unique_times"], want[s]["earliest"], want[s]["latest"],
            want[s]["time_range_hours"]), s
        assert r["unique_dates"] == len({t.date() for x, t in rows if x == s and t})
    assert sum(r["count"] for r in got.values()) == len(rows)
    numbered.unpersist()


def test_times_between_the_steps_are_an_error(spark):
    bars = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 0, 0, 30))], "symbol string, ts timestamp_ntz")
    with pytest.raises(Exception, match="no multiple of 60 seconds"):
        summary(bars).collect()
    assert summary(bars, grain_seconds=30).count() == 2


def test_pages_of_a_directory(spark):
    """Pages anywhere equal slices of the sorted symbols; the last page reads one range of many."""
    path = scratch_path(spark, "dir")
    bars = spark.range(20000).selectExpr("concat('S', conv(id * 7919 % 10007, 10, 36)) AS symbol").union(
        spark.createDataFrame([(None,), ("zz",), ("",)], "symbol string"))
    names = sorted(r[0] for r in bars.where("symbol IS NOT NULL").distinct().collect())
    catalog.write_directory(bars, path, per_range=500)
    for offset, limit in ((0, 10), (0, len(names)), (495, 20), (len(names) - 3, 10), (len(names), 5), (777, 0), (1234, 2345)):
        page = catalog.directory_page(spark, path, offset, limit).collect()
        assert sorted(r["symbol"] for r in page) == names[offset:offset + limit], (offset, limit)
        assert all((r["total_count"], r["page_offset"], r["page_limit"]) == (len(names), offset, limit) for r in page)
    last = catalog.directory_page(spark, path, len(names) - 3, 10)
    assert len({f.split("range=")[1].split("/")[0] for f in last.inputFiles()}) == 1
    catalog.write_directory(bars.limit(0), path + "-none")
    assert catalog.directory_page(spark, path + "-none").collect() == []


def test_small_ranges_need_no_more_tasks(spark):
    """A directory of many small ranges is written by a task per many symbols, and pages over ranges are right."""
    path = scratch_path(spark, "small")
    catalog.write_directory(spark.range(3000).selectExpr("lpad(id, 6, '0') AS symbol"), path, per_range=7)
    assert len(spark.read.parquet(f"{path}/sorted").inputFiles()) == 1
    sizes = sorted((r["low"], r["n"]) for r in spark.read.parquet(f"{path}/directory").collect())
    assert [n for _, n in sizes] == [7] * 428 + [4] and sizes[1][0] == "000007"
    page = catalog.directory_page(spark, path, 1396, 20).collect()
    assert sorted(r["symbol"] for r in page) == [f"{k:06d}" for k in range(1396, 1416)]
    assert {r["total_count"] for r in page} == {3000}
