"""Trend models against numpy least squares and bootstrap simulation."""
import datetime as dt
import math
import random

import numpy as np
import pytest

from barlake.operators import models
from tests.conftest import daily


def _rows(days, closes, sym="A"):
    base = dt.date(2021, 3, 1)
    return [(sym, (base + dt.timedelta(days=d)).isoformat(), c) for d, c in zip(days, closes)]


def _lstsq_quadratic(x, y):
    """Minimum-norm least squares on centred (x, x^2), as a linear model with intercept."""
    X = np.column_stack([x, x * x]).astype(float)
    Xc = X - X.mean(axis=0)
    beta = np.linalg.lstsq(Xc, y - y.mean(), rcond=None)[0]
    return y.mean() + (X - X.mean(axis=0)) @ beta


def _expected_forest(x, y, q):
    n = len(x)
    order = sorted(range(n), key=lambda j: (abs(x[j] - q), x[j]))
    w = [((n - k + 1) / n) ** n - ((n - k) / n) ** n for k in range(1, n + 1)]
    return sum(wk * y[j] for wk, j in zip(w, order))


@pytest.mark.parametrize("days", [[0], [0, 5], [0, 5, 5 + 7], list(range(0, 66, 3)),
                                  [0, 1, 2, 40, 41, 42, 800, 2400]])
def test_quadratic_matches_lstsq(spark, days):
    rng = random.Random(len(days))
    closes = [round(rng.uniform(10, 500), 2) for _ in days]
    bars = daily(spark, _rows(days, closes))
    fit = {r.day_index: r.poly_fit for r in models.in_sample(bars).collect()}
    want = _lstsq_quadratic(np.array(days, float), np.array(closes))
    for d, w in zip(days, want):
        assert math.isclose(fit[d], w, rel_tol=1e-9, abs_tol=1e-7)


def test_forest_matches_exact_expectation(spark):
    rng = random.Random(7)
    days = sorted(rng.sample(range(0, 400), 120))
    closes = [round(rng.uniform(10, 500), 2) for _ in days]
    bars = daily(spark, _rows(days, closes))
    fit = {r.day_index: r.rf_fit for r in models.in_sample(bars).collect()}
    for d in days:
        assert math.isclose(fit[d - days[0]], _expected_forest(days, closes, d), rel_tol=1e-12)
    fut = models.forecasts(bars).where("model = 'random_forest'").collect()
    want = _expected_forest(days, closes, days[-1] + 1)
    assert len(fut) == models.HORIZON_DAYS
    assert all(math.isclose(r.prediction, want, rel_tol=1e-12) for r in fut)


def test_forest_expectation_vs_bootstrap_simulation(spark):
    """Monte Carlo over bootstrap samples of nearest-in-bag trees agrees with the closed form."""
    rng = np.random.default_rng(42)
    x = np.arange(0, 30, dtype=float)
    y = np.round(rng.uniform(10, 50, size=x.size), 2)
    q = 14.0
    n, sims = len(x), 20000
    preds = np.empty(sims)
    for i in range(sims):
        inbag = np.unique(rng.integers(0, n, n))
        dist = np.abs(x[inbag] - q)
        best = inbag[np.lexsort((x[inbag], dist))[0]]
        preds[i] = y[best]
    se = preds.std() / math.sqrt(sims)
    assert abs(preds.mean() - _expected_forest(list(x), list(y), q)) < 4 * se


def test_metrics_properties(spark):
    rng = random.Random(3)
    rows = []
    for s in range(6):
        days = sorted(rng.sample(range(0, 90), rng.randint(3, 40)))
        rows += _rows(days, [round(rng.uniform(1, 100), 2) for _ in days], sym=f"S{s}")
    rows += _rows([0, 1, 2, 3], [7, 7, 7, 7], sym="FLAT")
    m = {r.symbol: r for r in models.model_metrics(daily(spark, rows)).collect()}
    for r in m.values():
        assert r.poly_mse <= r.linear_mse + 1e-9
        assert r.linear_r2 <= 1 + 1e-12 and r.poly_r2 <= 1 + 1e-12 and r.rf_r2 <= 1 + 1e-12
    assert m["FLAT"].linear_r2 == 1.0 and m["FLAT"].rf_mse == pytest.approx(0.0)


def test_single_bar_metrics(spark):
    m = models.model_metrics(daily(spark, _rows([0], [9.5]))).collect()[0]
    assert m.linear_mse == 0 and m.linear_r2 is None
    lin = models.linear_fit(daily(spark, _rows([0], [9.5]))).collect()[0]
    assert lin.slope == 0 and lin.intercept == 9.5


def test_horizon_is_calendar_days(spark):
    bars = daily(spark, _rows([0, 4], [1.0, 2.0]))  # Mon 2021-03-01, Fri 2021-03-05
    hz = models.forecast_horizon(models.fit_coefficients(bars)).orderBy("h").collect()
    assert [str(r.date) for r in hz[:3]] == ["2021-03-06", "2021-03-07", "2021-03-08"]
    assert [r.day_index for r in hz[:3]] == [5, 6, 7]


def test_forest_of_a_long_series(spark):
    """Far more rows than the +-50 neighbourhood."""
    rng = random.Random(11)
    days = sorted(rng.sample(range(0, 2000), 400))
    closes = [round(rng.uniform(10, 500), 2) for _ in days]
    bars = daily(spark, _rows(days, closes))
    fit = {r.day_index: r.rf_fit for r in models.in_sample(bars).collect()}
    assert len(fit) == len(days)
    for d in days:
        assert math.isclose(fit[d - days[0]], _expected_forest(days, closes, d), rel_tol=1e-12)


def test_mse_of_a_close_fit_does_not_cancel(spark):
    rng = np.random.default_rng(5)
    x = np.arange(2000)
    y = 1e5 + 500.0 * x + rng.normal(0, 1e-4, len(x))
    fit = models.linear_fit(daily(spark, _rows(x.tolist(), y.tolist()))).first()
    coef = np.polyfit(x - x.mean(), y, 1)
    want = np.mean((y - np.polyval(coef, x - x.mean())) ** 2)
    assert abs(fit["mse"] - want) <= 1e-6 * want + 1e-12


def test_forest_over_many_small_batches_equals_brute_force(spark):
    """Long and short series with gaps, a missing close and a missing day, cut anywhere; no array of neighbours per row."""
    import datetime as dt
    import random
    rnd = random.Random(5)
    series = {s: sorted(rnd.sample(range(400), n)) for s, n in (("A", 130), ("B", 3), ("C", 1), ("D", 51), ("E", 60))}
    closes = {(s, x): rnd.uniform(1, 9) for s, days in series.items() for x in days}
    closes["E", series["E"][0]] = None
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(x), y) for (s, x), y in closes.items()] + [("B", None, 4.0)]
    rnd.shuffle(rows)
    bars = spark.createDataFrame(rows, "symbol string, date date, close double").repartition(4)
    fitted = models.in_sample(bars, ["rf_fit"])
    assert "collect_list" not in fitted._jdf.queryExecution().executedPlan().toString()
    own = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.symbol, r.date): r.rf_fit for r in fitted.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", own)
    assert len(got) == len(rows)
    for s, days in series.items():
        n = sum(closes[s, x] is not None for x in days)
        for x in days:
            near = sorted(days, key=lambda o: (abs(o - x), o))[:50]
            ys = [closes[s, o] for o in near]
            have = got[s, dt.date(2024, 1, 1) + dt.timedelta(x)]
            if s == "B" or None in ys:
                assert have is None
            else:
                want = sum((((n - k) / n) ** n - ((n - k - 1) / n) ** n) * y for k, y in enumerate(ys))
                assert abs(have - want) < 1e-9, (s, x)
    assert got["B", None] is None
