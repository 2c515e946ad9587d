"""Hand-built edge series for the indicators and the analysis dataset."""
import math

from barlake.operators.indicators import rolling_indicators, with_day_index
from barlake.plans import datasets
from tests.conftest import daily


def _by_date(df):
    return {str(r["date"]): r for r in df.collect()}


def test_single_bar(spark):
    r = datasets.analysis_series(daily(spark, [("A", "2024-01-05", 10)])).collect()[0]
    assert r.moving_average is None and r.volatility is None and r.daily_change is None
    assert r.predicted_close == 10 and r.mse == 0 and r.day_index == 0


def test_two_and_three_bars(spark):
    rows = [("A", "2024-01-01", 10), ("A", "2024-01-02", 12), ("A", "2024-01-03", 11)]
    two = _by_date(rolling_indicators(daily(spark, rows[:2])))
    assert two["2024-01-02"].moving_average is None
    assert math.isclose(two["2024-01-02"].daily_change, 20.0)
    three = _by_date(rolling_indicators(daily(spark, rows)))
    assert math.isclose(three["2024-01-03"].moving_average, 11.0)
    assert math.isclose(three["2024-01-03"].volatility, 1.0)


def test_constant_close(spark):
    rows = [("A", f"2024-01-0{i}", 5) for i in range(1, 6)]
    out = datasets.analysis_series(daily(spark, rows)).collect()
    assert all(r.daily_change in (None, 0.0) for r in out)
    assert all(r.volatility in (None, 0.0) for r in out)
    card = datasets.latest_indicators(daily(spark, rows)).collect()[0]
    assert card.daily_change == 0.0 and card.is_positive is False


def test_zero_close_then_nonzero(spark):
    rows = [("A", "2024-01-01", 0), ("A", "2024-01-02", 3), ("A", "2024-01-03", 6)]
    got = _by_date(rolling_indicators(daily(spark, rows)))
    assert got["2024-01-02"].daily_change is None  # x / 0 -> NULL, no exception
    assert math.isclose(got["2024-01-03"].daily_change, 100.0)


def test_weekend_gap_uses_rows_and_day_index(spark):
    rows = [("A", "2024-01-05", 10), ("A", "2024-01-08", 11)]  # Fri, Mon
    idx = {str(r.date): r.day_index for r in with_day_index(daily(spark, rows)).collect()}
    assert idx == {"2024-01-05": 0, "2024-01-08": 3}
    got = _by_date(rolling_indicators(daily(spark, rows)))
    assert math.isclose(got["2024-01-08"].daily_change, 10.0)


def test_unknown_symbol_is_empty(spark):
    from barlake.sources.readers import bars_for_symbol
    bars = daily(spark, [("A", "2024-01-01", 1)])
    assert bars_for_symbol(bars, "ZZZ").count() == 0
