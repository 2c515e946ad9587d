"""Trend fits and forecasts for every symbol in one job (M1-M6).

Feature ``x`` is the day index (whole days since the symbol's first bar),
target ``y`` is the close.  The linear and quadratic models are Spark
aggregates and column expressions; the forest's neighbours are sorted by numpy
in the tasks.

* Linear (M1): least squares on x.  Var(x) = 0 gives slope 0 and the mean.
* Quadratic (M2): least squares on (x, x^2) from centred moments of
  ``u = x - mean(x)`` computed in a second pass after the means are known
  (two-pass centring keeps x up to thousands of days well conditioned).
  Rank-deficient inputs follow the minimum-norm least-squares solution:
  one distinct x gives the mean; two distinct x (0 and d) give
  ``y1 + (y2 - y1) / (1 + d^2) * (x / d + x^2)``.
* Bagged trees (M3): the expectation of a bagged forest of fully grown
  trees on one feature.  A full tree predicts the in-bag row nearest in x
  (ties to the lower x); in a bootstrap of n draws the nearest in-bag row
  is the k-th nearest overall with probability
  ``w_k = ((n-k+1)/n)^n - ((n-k)/n)^n``.  The prediction is
  ``sum_k w_k * y_(k)``.  Ranks beyond ``FOREST_NEIGHBOURS`` carry total
  weight ``((n-K)/n)^n <= e^-K`` (below 2e-22 for K = 50, under double
  precision), so the neighbours that matter always lie within +-K rows and
  the sum is taken over a +-K row window; what is left out is at most
  ``e^-K * max|y|``.  A seeded 100-tree forest differs from this expectation
  by its sampling noise.

Series are daily: unique on (symbol, date), so a symbol has at most one row
per calendar day and is one window partition; fits, neighbours and metrics
share one shuffle on the symbol.

Metrics (A5, A6): MSE = mean squared residual; R^2 = 1 - SSE/SST, with
R^2 = 1 when the closes are constant (every model reproduces a constant
series exactly) and NULL for fewer than two bars.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed values of the forecast page: 30 calendar days ahead, three models.
HORIZON_DAYS = 30
MODELS = ["linear", "polynomial", "random_forest"]
FOREST_NEIGHBOURS = 50
PLACES = 256  # places of a frame of at most 2 K + 1 rows
NO_NEIGHBOUR = np.iinfo("i8").max
ROWS_AT_ONCE = 8192  # rows whose neighbours are sorted at a time


def _xy(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", "date", F.col("close").alias("y"),
                       F.unix_date("date").alias("d"))


def with_linear_fit(bars: DataFrame) -> DataFrame:
    """Daily bars with their symbol's linear fit (M1) as columns, in one shuffle.

    Input: ``symbol``, ``date``, ``close`` and columns to carry along, unique
    on (symbol, date).  A daily series has at most one row per calendar day
    (some 25,000 in 70 years), so a symbol is one window partition whatever
    the size of the table.  Adds ``n``, ``anchor``, ``last_date``, ``slope``,
    ``intercept`` (at the anchor), ``mse`` and ``r2``.

    The MSE averages the squared residuals: ``var(y) - slope * cov(x, y)``
    would cancel on a close fit.
    """
    w = Window.partitionBy("symbol")
    d, y = F.unix_date("date"), F.col("close")
    s = (bars.withColumn("_d", d)
         .select("*", F.count(y).over(w).alias("n"), F.min("date").over(w).alias("anchor"),
                 F.max("date").over(w).alias("last_date"), F.avg("_d").over(w).alias("_mean_d"),
                 F.avg(y).over(w).alias("_mean_y"), F.var_pop(y).over(w).alias("_var_y"),
                 F.covar_pop(F.col("_d").cast("double"), y).over(w).alias("_cov"),
                 F.var_pop("_d").over(w).alias("_var_x"),
                 (F.max(y).over(w) == F.min(y).over(w)).alias("_flat"))
         .withColumn("slope", F.when(F.col("_var_x") > 0, F.try_divide("_cov", "_var_x")).otherwise(F.lit(0.0))))
    residual = F.when(F.col("_flat"), F.lit(0.0)).otherwise(
        y - (F.col("_mean_y") + F.col("slope") * (F.col("_d") - F.col("_mean_d"))))
    mean_x = F.col("_mean_d") - F.unix_date("anchor")
    return (s.withColumn("mse", F.avg(residual * residual).over(w))
            .withColumn("intercept", F.col("_mean_y") - F.col("slope") * mean_x)
            .withColumn("r2", r2_expr(F.col("mse"), F.col("_var_y"), F.col("n"), F.col("_flat")))
            .drop("_d", "_mean_d", "_mean_y", "_var_y", "_cov", "_var_x", "_flat"))


def linear_fit(bars: DataFrame) -> DataFrame:
    """M1, one row per symbol: slope, intercept (at day index 0), MSE, R^2.

    The aggregation needs no shuffle of its own after :func:`with_linear_fit`.
    """
    cols = ["n", "anchor", "last_date", "slope", "intercept", "mse", "r2"]
    return (with_linear_fit(bars.select("symbol", "date", "close"))
            .groupBy("symbol").agg(*[F.max(c).alias(c) for c in cols]))


def r2_expr(mse: Column, var_y: Column, n: Column, flat: Column) -> Column:
    """1 - SSE/SST with the constant-series and short-series rules."""
    return (F.when(n < 2, F.lit(None).cast("double"))
            .when(flat, F.lit(1.0))
            .otherwise(F.lit(1.0) - F.try_divide(mse, var_y)))


COEFFICIENTS = ["n", "nx", "d0", "d_last", "mean_d", "mean_y", "var_y", "flat",
                "lin_b", "quad_a", "quad_b", "quad_c"]


def with_coefficients(bars: DataFrame) -> DataFrame:
    """``symbol``, ``date``, ``y``, ``d`` and the symbol's linear and quadratic coefficients, in one shuffle.

    Daily bars, at most one per calendar day, so a symbol is one window
    partition.  The means come first and the moments centred on them second,
    over the same partition; ``nx`` is the number of distinct days capped at
    3, which selects the least-squares branch.
    """
    w = Window.partitionBy("symbol")
    s1 = _xy(bars).select(
        "*", F.count("y").over(w).alias("n"), F.min("d").over(w).alias("d0"), F.max("d").over(w).alias("d_last"),
        F.avg("d").over(w).alias("mean_d"), F.avg("y").over(w).alias("mean_y"),
        (F.max("y").over(w) == F.min("y").over(w)).alias("flat"))
    u = F.col("d") - F.col("mean_d")
    e = F.col("y") - F.col("mean_y")
    # "interior" counts days strictly between the first and last day; with
    # the day range it tells 1, 2 or >= 3 distinct days exactly, without a
    # separate distinct aggregation
    inside = (F.col("d") > F.col("d0")) & (F.col("d") < F.col("d_last"))
    moments = {"m2": u * u, "m3": u * u * u, "m4": u * u * u * u, "c1": u * e, "c2": u * u * e, "var_y": e * e}
    s2 = s1.select("*", *[F.avg(c).over(w).alias(k) for k, c in moments.items()],
                   F.sum(inside.cast("int")).over(w).alias("interior"))
    distinct_days = (F.when(F.col("d0") == F.col("d_last"), F.lit(1))
                     .when(F.col("interior") == 0, F.lit(2)).otherwise(F.lit(3)))
    c = s2.withColumn("nx", distinct_days)
    m2, m3, m4, c1, c2 = (F.col(k) for k in ("m2", "m3", "m4", "c1", "c2"))
    mean_x = F.col("mean_d") - F.col("d0")
    span = (F.col("d_last") - F.col("d0")).cast("double")
    lin_b = F.when(m2 > 0, F.try_divide(c1, m2)).otherwise(F.lit(0.0))
    # general branch (>= 3 distinct x)
    det = m2 * (m4 - m2 * m2) - m3 * m3
    g_b = F.try_divide(c1 * (m4 - m2 * m2) - c2 * m3, det)
    g_c = F.try_divide(m2 * c2 - m3 * c1, det)
    g_a = F.col("mean_y") - g_c * m2
    # two distinct x at 0 and `span`: minimum-norm solution on (x, x^2)
    y1 = F.col("mean_y") - F.col("lin_b") * mean_x
    s = F.col("lin_b") * span / (F.lit(1.0) + span * span)
    t_a = y1 + s * mean_x / span + s * mean_x * mean_x
    t_b = s / span + F.lit(2.0) * s * mean_x
    nx = F.col("nx")
    return (c.withColumn("lin_b", lin_b)
            .withColumn("quad_a", F.when(nx >= 3, g_a).when(nx == 2, t_a).otherwise(F.col("mean_y")))
            .withColumn("quad_b", F.when(nx >= 3, g_b).when(nx == 2, t_b).otherwise(F.lit(0.0)))
            .withColumn("quad_c", F.when(nx >= 3, g_c).when(nx == 2, s).otherwise(F.lit(0.0)))
            .select("symbol", "date", "y", "d", *COEFFICIENTS))


def fit_coefficients(bars: DataFrame) -> DataFrame:
    """The coefficients, one row per symbol; no shuffle beyond :func:`with_coefficients`."""
    return with_coefficients(bars).groupBy("symbol").agg(*[F.max(c).alias(c) for c in COEFFICIENTS])


def _linear_at(d: Column) -> Column:
    return F.col("mean_y") + F.col("lin_b") * (d - F.col("mean_d"))


def _quadratic_at(d: Column) -> Column:
    u = d - F.col("mean_d")
    return F.col("quad_a") + F.col("quad_b") * u + F.col("quad_c") * u * u


def _forest_weight(n: Column, k0: Column) -> Column:
    """Probability that the (k0+1)-th nearest row is the nearest in-bag row."""
    nd = n.cast("double")
    return F.pow((nd - k0) / nd, nd) - F.pow((nd - k0 - F.lit(1)) / nd, nd)


def forest_sums(d: np.ndarray, y: np.ndarray, n: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """sum_k w_k * y_(k) of each row over the rows nearest in ``d``.

    Rows are in order of symbol and date; those ``start`` to ``end`` are of the
    row's symbol.  A neighbour is one number, its distance and its place in the
    frame, and sorting these puts the nearest first (ties: the earlier day).
    The weights depend on ``n`` alone.
    """
    k = FOREST_NEIGHBOURS
    half = int(min(k, (end - start).max() - 1))
    place = np.arange(-half, half + 1)
    at = np.arange(len(d))[:, None] + place
    inside = (at >= start[:, None]) & (at < end[:, None])
    at = np.where(inside, at, 0)
    keys = np.where(inside, np.abs(d[at] - d[:, None]) * PLACES + (place + half), NO_NEIGHBOUR)
    keys.sort(axis=1)
    sizes, which = np.unique(n, return_inverse=True)
    rank = np.arange(k)
    with np.errstate(divide="ignore", invalid="ignore"):  # without closes there is no sum
        nd = sizes[:, None].astype("f8")
        weight = np.power((nd - rank) / nd, nd) - np.power((nd - rank - 1) / nd, nd)
        total = np.zeros(len(d))
        for r in range(min(k, keys.shape[1])):
            key = keys[:, r]
            near = np.arange(len(d)) + (key % PLACES) - half
            used = key != NO_NEIGHBOUR
            total += np.where(used, y[np.where(used, near, 0)] * weight[which, r], 0.0)
    return total


def forest_fit(table: pa.Table) -> pa.Array:
    """M3 of the rows of whole symbols: null where the frame holds a missing day, or a missing close is near enough."""
    def numbers(name: str, kind: str) -> np.ndarray:
        return pc.fill_null(table[name], 0).to_numpy().astype(kind)

    def missing(name: str) -> np.ndarray:
        return table[name].is_null().to_numpy().astype("f8")

    d, n = numbers("d", "i8"), numbers("n", "i8")
    start = np.arange(len(d)) - numbers("_row", "i8") + 1
    end = start + numbers("_rows", "i8")
    sums, lost = [], []
    no_day, no_close = missing("d"), missing("y")
    y = numbers("y", "f8")
    some_lost = bool(no_day.any() or no_close.any())
    for a in range(0, len(d), ROWS_AT_ONCE):
        z = min(a + ROWS_AT_ONCE, len(d))
        low, high = max(int(start[a]), a - FOREST_NEIGHBOURS), min(int(end[z - 1]), z + FOREST_NEIGHBOURS)
        part = slice(low, high)
        args = n[part], np.maximum(start[part] - low, 0), np.minimum(end[part], high) - low
        sums.append(forest_sums(d[part], y[part], *args)[a - low:z - low])
        if some_lost:
            index = np.arange(a, z)
            days = np.concatenate([[0.0], np.cumsum(no_day)])
            frame = (np.maximum(start[a:z], index - FOREST_NEIGHBOURS), np.minimum(end[a:z], index + FOREST_NEIGHBOURS + 1))
            near = forest_sums(d[part], no_close[part], np.full(high - low, 2 * FOREST_NEIGHBOURS), *args[1:])[a - low:z - low]
            lost.append((days[frame[1]] > days[frame[0]]) | (near > 0))
    total = np.concatenate(sums) if sums else np.zeros(0)
    return pa.array(total, pa.float64(), mask=np.concatenate(lost) if lost else None)


def _with_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by symbol and day, with the forest's fit; a symbol is held until its last row is there."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        last = np.flatnonzero(batch["_row"].to_numpy() == batch["_rows"].to_numpy())
        if not len(last):
            continue
        cut = int(last[-1]) + 1
        whole = pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held = [batch.slice(cut)] if cut < batch.num_rows else []
        fitted = whole.append_column("rf_fit", forest_fit(whole)).drop_columns(["_row", "_rows"])
        yield from fitted.to_batches()


FITS = ["linear_fit", "poly_fit", "rf_fit"]


def in_sample(bars: DataFrame, fits: Sequence[str] = FITS) -> DataFrame:
    """Fitted values of all three models for every bar, or of those asked for.

    The forest needs the K nearest rows of each bar, all within +-K
    positions of its symbol's series: whole symbols go to numpy, many at a
    time, over the partitions that the coefficients are computed in.
    """
    lines = {"linear_fit": _linear_at(F.col("d")), "poly_fit": _quadratic_at(F.col("d"))}
    facts = ["symbol", "date", "y", "n", "var_y", "flat"] if len(fits) > 1 else ["symbol", "date", "y", "n"]
    rows = with_coefficients(bars).select(
        "*", (F.col("d") - F.col("d0")).alias("day_index"), *[c.alias(name) for name, c in lines.items() if name in fits])
    if "rf_fit" not in fits:
        return rows.select(*facts, "day_index", *fits)
    w = Window.partitionBy("symbol")
    numbered = rows.select(
        *facts, "day_index", *[f for f in lines if f in fits], "d",
        F.row_number().over(w.orderBy("d")).alias("_row"), F.count(F.lit(1)).over(w).alias("_rows"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in numbered.schema.fields if f.name not in ("_row", "_rows")])
    return (numbered.sortWithinPartitions("symbol", "_row")
            .mapInArrow(_with_forest, schema.add("rf_fit", T.DoubleType()))
            .select(*facts, "day_index", *fits))


def _forest_sum(ys: Column, n: Column) -> Column:
    """sum_k w_k * ys[k] over an array already in nearest-first order."""
    weighted = F.transform(ys, lambda y, i: y * _forest_weight(n, i))
    return F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v)


def _in_sample_columns(bars: DataFrame) -> DataFrame:
    """:func:`in_sample` by column expressions: slower, but an aggregation by symbol needs no shuffle after it."""
    k = FOREST_NEIGHBOURS
    frame = Window.partitionBy("symbol").orderBy("d").rowsBetween(-k, k)
    rows = with_coefficients(bars).select(
        "*", F.collect_list(F.struct("d", "y")).over(frame).alias("_rows"))
    keys = F.transform("_rows", lambda x, i: F.abs(x["d"] - F.col("d")).cast("bigint") * PLACES + i)
    ranked = rows.withColumn("_near", F.slice(F.sort_array(keys), 1, k))
    ys = F.transform("_near", lambda key: F.get("_rows", (key % PLACES).cast("int"))["y"])
    return ranked.select(
        "symbol", "date", "y", "n", "var_y", "flat",
        _linear_at(F.col("d")).alias("linear_fit"),
        _quadratic_at(F.col("d")).alias("poly_fit"),
        _forest_sum(ys, F.col("n")).alias("rf_fit"))


def model_metrics(bars: DataFrame) -> DataFrame:
    """M6: in-sample MSE and R^2 of all three models, one row per symbol."""
    fitted = _in_sample_columns(bars)

    def sq(c: str) -> Column:
        r = F.col("y") - F.col(c)
        return r * r

    agg = fitted.groupBy("symbol").agg(
        F.first("n").alias("n"), F.first("var_y").alias("var_y"), F.first("flat").alias("flat"),
        F.avg(sq("linear_fit")).alias("linear_mse"),
        F.avg(sq("poly_fit")).alias("poly_mse"),
        F.avg(sq("rf_fit")).alias("rf_mse"))
    n, var_y, flat = F.col("n"), F.col("var_y"), F.col("flat")
    return agg.select(
        "symbol", "linear_mse", "poly_mse", "rf_mse",
        r2_expr(F.col("linear_mse"), var_y, n, flat).alias("linear_r2"),
        r2_expr(F.col("poly_mse"), var_y, n, flat).alias("poly_r2"),
        r2_expr(F.col("rf_mse"), var_y, n, flat).alias("rf_r2"))


def forecast_horizon(coefs: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """M4: the next ``days`` calendar days after each symbol's last bar."""
    h = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("h")
    return (coefs.select("*", h)
            .withColumn("d", F.col("d_last") + F.col("h"))
            .withColumn("date", F.date_from_unix_date("d"))
            .withColumn("day_index", (F.col("d") - F.col("d0")).cast("int")))


def forecasts(bars: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """M5: long table (symbol, model, date, day_index, prediction).

    M3 beyond the last bar: the nearest rows are the latest ones, so every
    future day gets the same weighted sum of the K latest closes.  It is
    taken over the partitions that the coefficients are computed in.
    """
    latest = Window.partitionBy("symbol").orderBy(F.col("d").desc())
    k = F.row_number().over(latest)
    weighted = F.when(F.col("_k") <= FOREST_NEIGHBOURS, F.col("y") * _forest_weight(F.col("n"), F.col("_k") - 1))
    coefs = (with_coefficients(bars).withColumn("_k", k).groupBy("symbol")
             .agg(*[F.max(c).alias(c) for c in COEFFICIENTS], F.sum(weighted).alias("rf_future")))
    hz = forecast_horizon(coefs, days)
    preds = F.array(
        F.struct(F.lit("linear").alias("model"), _linear_at(F.col("d")).alias("prediction")),
        F.struct(F.lit("polynomial").alias("model"), _quadratic_at(F.col("d")).alias("prediction")),
        F.struct(F.lit("random_forest").alias("model"), F.col("rf_future").alias("prediction")),
    )
    return (hz.select("symbol", "date", "day_index", F.inline(preds))
            .select("symbol", "model", "date", "day_index", "prediction"))
