"""Trading-day clock, session fallback, quotes and display strings."""
import datetime as dt

from pyspark.sql import functions as F

from barlake.functions.expressions import magnitude_text, trading_day
from barlake.operators import intraday


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_trading_day_table(spark):
    cases = [("2024-01-06 12:00:00", "2024-01-05"),  # Sat -> Fri
             ("2024-01-07 12:00:00", "2024-01-05"),  # Sun -> Fri
             ("2024-01-08 08:59:00", "2024-01-05"),  # Mon before 09:00 -> Fri
             ("2024-01-08 09:15:00", "2024-01-07"),  # Mon 09:15 -> Sun (hour-only test)
             ("2024-01-09 09:29:00", "2024-01-08"),  # Tue before open -> Mon
             ("2024-01-09 09:30:00", "2024-01-09"),
             ("2024-01-09 16:00:00", "2024-01-09")]
    df = spark.createDataFrame([(_ts(a),) for a, _ in cases], "ts timestamp_ntz")
    got = [str(r.d) for r in df.select(trading_day(F.col("ts")).alias("d")).collect()]
    assert got == [b for _, b in cases]
    assert all(_ts(a).date() >= dt.date.fromisoformat(b) for a, b in cases)


def _minute_bars(spark, n, start, base=0.0):
    rows = [("A", start + dt.timedelta(minutes=i), base + i, base + i, base + i, base + i, 1.0)
            for i in range(n)]
    return spark.createDataFrame(
        rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double")


def test_empty_session_falls_back_to_latest_100(spark):
    bars = _minute_bars(spark, 150, _ts("2024-01-03 10:00:00"))
    day = intraday.session_day(F.lit(_ts("2024-01-10 12:00:00")))
    view = intraday.session_or_recent(bars, day).orderBy("pos").collect()
    assert len(view) == 100 and not view[0].in_session
    assert view[0].close == 149.0 and view[-1].close == 50.0  # descending


def test_session_day_ascending(spark):
    bars = _minute_bars(spark, 30, _ts("2024-01-09 09:30:00"))
    day = intraday.session_day(F.lit(_ts("2024-01-09 12:00:00")))
    view = intraday.session_or_recent(bars, day).orderBy("pos").collect()
    assert len(view) == 30 and view[0].in_session and view[0].close == 0.0


def test_quote_board_one_bar_and_flags(spark):
    bars = _minute_bars(spark, 1, _ts("2024-01-09 10:00:00"), base=12.5)
    q = intraday.quote_board(bars).collect()[0]
    assert q.prev_close == q.price and q.change == 0 and q.is_up
    assert q.change_text == "+0.00 (+0.00%)" and q.price_text == "$12.50"
    zero = intraday.quote_board(_minute_bars(spark, 2, _ts("2024-01-09 10:00:00"))).collect()[0]
    assert zero.change_pct is None and zero.change_text == "+1.00 (NaN%)"


def test_magnitude_text(spark):
    df = spark.createDataFrame([(999.0,), (1500.0,), (2_500_000.0,), (3e9,)], "v double")
    got = [r.t for r in df.select(magnitude_text("v").alias("t")).collect()]
    assert got == ["999.00", "1.50K", "2.50M", "3.00B"]


def test_rounded_text_matches_python_round(spark):
    from barlake.functions.expressions import rounded_text
    vals = [0.0007, 0.00012, 5.0, 83.7349, 2.675, 1.005, 12345678.91234, -0.00071, 0.0, 1e-6, 0.001, 0.125]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for places in (2, 4):
        got = [r.t for r in df.select(rounded_text("v", places).alias("t")).collect()]
        assert got == [str(round(v, places)) for v in vals]


def test_session_view_equals_one_window_per_symbol(spark):
    """Symbols with a whole day of minutes, a short one, none on the session day, and missing times."""
    import random
    rnd = random.Random(5)
    day = dt.datetime(2024, 1, 9)
    times = {"FULL": [day + dt.timedelta(minutes=i) for i in range(1440)],
             "SOME": [day + dt.timedelta(minutes=i) for i in rnd.sample(range(1440), 200)]
             + [day - dt.timedelta(minutes=i) for i in range(1, 3000)],
             "OLD": [day - dt.timedelta(minutes=i) for i in range(1, 5000, 2)],
             "FEW": [day - dt.timedelta(days=i) for i in range(1, 8)] + [None],
             "NEXT": [day + dt.timedelta(days=1, minutes=i) for i in range(300)]}
    rows = [(s, t, *([float(i)] * 5)) for s, ts in times.items() for i, t in enumerate(ts)]
    rnd.shuffle(rows)
    bars = spark.createDataFrame(
        rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
    want = set()
    for s, ts in times.items():
        inside = sorted(t for t in ts if t is not None and t.date() == day.date())
        shown = inside or sorted((t for t in ts if t is not None), reverse=True)[:100]
        if not inside and len(shown) < 100 and None in ts:
            shown.append(None)
        want |= {(s, t, pos, bool(inside)) for pos, t in enumerate(shown)}
    for salts in (1, 32, 1440):
        view = intraday.session_or_recent(bars, F.lit(day.date()), salts=salts)
        got = view.select("symbol", "ts", "pos", "in_session").collect()
        assert len(got) == len(want) and set(map(tuple, got)) == want, salts
    assert intraday.session_or_recent(bars.limit(0), F.lit(day.date())).collect() == []
    nothing = intraday.session_or_recent(bars, F.lit(None).cast("date"))
    assert not nothing.where("in_session").count() and nothing.where("symbol = 'FULL'").count() == 100


def test_bars_beyond_their_grain_are_an_error_not_dropped(spark):
    import pytest
    start = _ts("2024-01-09 10:00:00")
    rows = [("A", start + dt.timedelta(seconds=i), *([float(i)] * 5)) for i in range(7200)]
    bars = spark.createDataFrame(
        rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
    day = F.lit(start.date())
    with pytest.raises(Exception, match="more than 1440 bars"):
        intraday.session_or_recent(bars, day).collect()
    assert intraday.session_or_recent(bars, day, per_day=86400).count() == 7200
