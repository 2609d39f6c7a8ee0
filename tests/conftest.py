import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 3, day, hour, tzinfo=timezone.utc)


def rows(df, *columns):
    """Sorted tuples, for comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
