import datetime
import decimal
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, memory="4g")


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, decimals as floats."""

    def plain(value):
        return float(value) if isinstance(value, decimal.Decimal) else value

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=lambda t: tuple(map(repr, t)))

    return collect


@pytest.fixture
def at():
    return datetime.datetime.fromisoformat
