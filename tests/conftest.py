import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[*]", app="barlake-tests", shuffle_partitions=8)
    yield s


def daily(spark, rows):
    """Bars from (symbol, 'YYYY-MM-DD', close) tuples; open/high/low = close, volume 1."""
    data = [(s, dt.date.fromisoformat(d), float(c), float(c), float(c), float(c), 1.0)
            for s, d, c in rows]
    return spark.createDataFrame(
        data, "symbol string, date date, open double, high double, low double, close double, volume double")
