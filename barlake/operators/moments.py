"""Mergeable moments of a series, and trend fits from them (M1, M2 for any grain).

A summary row holds, for some rows of a symbol, their number, the means of x
and y and the sums centred on them: x to the fourth order, its products with y
up to ``(x - mean)^2 (y - mean)``, and y to the second.  Summaries of disjoint
rows merge into the summary of all of them by shifting each one's sums to the
common mean, so

* rows are reduced by (symbol, time block) with map-side aggregation on
  fixed-width buffers; a symbol holding a third of all rows is no hot task;
* what is left to merge is one row per symbol and block;
* new bars are appended by merging their summary with the stored one; the
  bars behind it are not read again.

x is a whole number of steps of ``grain_seconds`` since 1970; blocks are short
against it, so the sums within a block are well conditioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.models import r2_expr

SUMMARY = ["symbol", "n", "first", "last", "mean_x", "mean_y", "m2", "m3", "m4", "c1", "c2", "var_sum", "low", "high"]
BLOCK_STEPS = 1440


def step(ts: str, grain_seconds: int) -> Column:
    """Whole steps since 1970 of a TIMESTAMP_NTZ or DATE column."""
    return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                    F.col(ts).cast("timestamp_ntz")) / grain_seconds)


def block_moments(bars: DataFrame, order: str, grain_seconds: int, value: str = "close",
                  block_steps: int = BLOCK_STEPS) -> DataFrame:
    """Summaries of the bars by symbol and time block; bars without a time or a value are not part of a series."""
    rows = (bars.where(F.col(order).isNotNull() & F.col(value).isNotNull())
            .select("symbol", step(order, grain_seconds).alias("x"), F.col(value).cast("double").alias("y"))
            .withColumn("block", F.floor(F.col("x") / block_steps))
            .withColumn("u", (F.col("x") - F.col("block") * block_steps).cast("double")))
    u, y = F.col("u"), F.col("y")
    s = rows.groupBy("symbol", "block").agg(
        F.count(y).cast("double").alias("n"), F.min("x").alias("first"), F.max("x").alias("last"),
        F.avg(u).alias("_u"), F.avg(y).alias("mean_y"), F.var_pop(u).alias("_v"), F.skewness(u).alias("_s"),
        F.kurtosis(u).alias("_k"), F.covar_pop(u, y).alias("_c"), F.covar_pop(u * u, y).alias("_cc"),
        F.var_pop(y).alias("_w"), F.min(y).alias("low"), F.max(y).alias("high"))
    n, v = F.col("n"), F.col("_v")
    spread = v > 0
    return s.select(
        "symbol", "n", "first", "last", (F.col("block") * block_steps + F.col("_u")).alias("mean_x"), "mean_y",
        (n * v).alias("m2"),
        F.when(spread, n * F.col("_s") * F.pow(v, F.lit(1.5))).otherwise(F.lit(0.0)).alias("m3"),
        F.when(spread, n * (F.col("_k") + 3) * v * v).otherwise(F.lit(0.0)).alias("m4"),
        (n * F.col("_c")).alias("c1"), (n * (F.col("_cc") - 2 * F.col("_u") * F.col("_c"))).alias("c2"),
        (n * F.col("_w")).alias("var_sum"), "low", "high")


def merged(summaries: DataFrame) -> DataFrame:
    """One summary per symbol.  The window runs over summaries, a few per symbol and block, never over bars."""
    whole = Window.partitionBy("symbol")
    n = F.col("n")
    total = F.sum("n").over(whole)
    # shares instead of sums of n * mean: the mean keeps its digits however many rows there are
    s = summaries.withColumn("_t", total)
    s = (s.withColumn("_x", F.sum(n / F.col("_t") * F.col("mean_x")).over(whole))
         .withColumn("_y", F.sum(n / F.col("_t") * F.col("mean_y")).over(whole)))
    d, e = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    m2, m3, m4, c1, c2 = (F.col(c) for c in ("m2", "m3", "m4", "c1", "c2"))
    sums = {"m2": m2 + n * d * d,
            "m3": m3 + 3 * d * m2 + n * d * d * d,
            "m4": m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d,
            "c1": c1 + n * d * e,
            "c2": c2 + 2 * d * c1 + e * m2 + n * d * d * e,
            "var_sum": F.col("var_sum") + n * e * e}
    return (s.groupBy("symbol").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("_x").alias("mean_x"), F.max("_y").alias("mean_y"),
        *[F.sum(c).alias(k) for k, c in sums.items()], F.min("low").alias("low"), F.max("high").alias("high"))
        .select(*SUMMARY))


def fitted(summary: DataFrame) -> DataFrame:
    """Linear and quadratic fit of each symbol's summary: ``slope``, ``r2`` and the fits at its first and last step.

    The quadratic's coefficients are those of ``u = x - mean``: ``quad_a``,
    ``quad_b``, ``quad_c``.  With fewer than three distinct x it follows the
    minimum-norm solution on (x, x^2), x counted from the first step, as the
    daily fits do.
    """
    n, m2, m3, m4, c1, c2 = (F.col(c) for c in ("n", "m2", "m3", "m4", "c1", "c2"))
    span = (F.col("last") - F.col("first")).cast("double")
    mean = F.col("mean_x") - F.col("first")
    # sum of (x - first)(last - x): zero if no x lies between the two
    inside = n * mean * (span - mean) - m2
    several = inside > 1e-9 * n * span * span
    slope = F.when(m2 > 0, F.try_divide(c1, m2)).otherwise(F.lit(0.0))
    det = m2 * (m4 - m2 * m2 / n) - m3 * m3
    general = [F.try_divide(c1 * (m4 - m2 * m2 / n) - c2 * m3, det), F.try_divide(m2 * c2 - m3 * c1, det)]
    s = F.col("slope") * span / (1 + span * span)
    two = [F.col("mean_y") - F.col("slope") * mean + s * mean / span + s * mean * mean, s / span + 2 * s * mean, s]
    flat = F.col("low") == F.col("high")

    def branch(three: Column, pair: Column, one: Column) -> Column:
        return F.when(several, three).when(span > 0, pair).otherwise(one)

    def quadratic(u: Column) -> Column:
        return F.col("quad_a") + F.col("quad_b") * u + F.col("quad_c") * u * u

    sse = F.col("var_sum") - F.col("slope") * c1
    return (summary.withColumn("slope", slope)
            .withColumn("quad_b", branch(general[0], two[1], F.lit(0.0)))
            .withColumn("quad_c", branch(general[1], two[2], F.lit(0.0)))
            .withColumn("quad_a", branch(F.col("mean_y") - F.col("quad_c") * m2 / n, two[0], F.col("mean_y")))
            .withColumn("r2", r2_expr(sse / n, F.col("var_sum") / n, n, flat))
            .withColumn("linear_first", F.col("mean_y") - F.col("slope") * mean)
            .withColumn("linear_last", F.col("mean_y") + F.col("slope") * (span - mean))
            .withColumn("quadratic_first", quadratic(-mean))
            .withColumn("quadratic_last", quadratic(span - mean)))
