"""Keep-last and retention against a message-by-message LRU simulation."""
import datetime as dt
import random
from collections import OrderedDict

import pytest

from barlake.operators.dedup import keep_last, live_state, retain_last_n


def _simulate(messages, cap):
    """The live table updated one message at a time (dedup keep last, evict oldest)."""
    state = {}
    for sym, day, seq, close in messages:
        book = state.setdefault(sym, OrderedDict())
        book.pop(day, None)
        book[day] = (seq, close)
        while len(book) > cap:
            book.popitem(last=False)
    return {(s, d): v for s, book in state.items() for d, v in book.items()}


@pytest.mark.parametrize("seed,cap", [(1, 3), (2, 5), (3, 50)])
def test_batch_equals_message_by_message(spark, seed, cap):
    rng = random.Random(seed)
    msgs = []
    for seq in range(400):
        sym = f"S{rng.randint(0, 3)}"
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 12))
        msgs.append((sym, day, seq, float(rng.randint(1, 99))))
    df = spark.createDataFrame(
        [(s, d, q, c, c, c, c, 1.0) for s, d, q, c in msgs],
        "symbol string, date date, seq long, open double, high double, low double, close double, volume double")
    got = {(r.symbol, r.date): (r.seq, r.close) for r in live_state(df, cap=cap).collect()}
    assert got == _simulate(msgs, cap)


def test_keep_last_is_not_drop_duplicates(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), 1, 10.0), ("A", dt.date(2024, 1, 1), 3, 30.0),
         ("A", dt.date(2024, 1, 1), 2, 20.0), ("A", dt.date(2024, 1, 2), 4, 40.0)],
        "symbol string, date date, seq long, close double")
    got = {str(r.date): r.close for r in keep_last(df, ["symbol", "date"], "seq").collect()}
    assert got == {"2024-01-01": 30.0, "2024-01-02": 40.0}


@pytest.mark.parametrize("cap", [5, 5000])
def test_retention_plan_uses_group_limit(spark, cap):
    # more rows than the cap, else Spark proves the limit redundant
    df = spark.range(3 * cap + 10).selectExpr("CAST(id % 3 AS STRING) AS symbol", "id AS seq")
    plan = retain_last_n(df, cap=cap)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
