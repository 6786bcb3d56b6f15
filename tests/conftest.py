import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from seatcast.schemas import SNAPSHOT  # noqa: E402
from seatcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="seatcast-tests", memory="4g")
    yield s
    s.stop()


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def snap(event_id, day, min_price, max_price, *, status="onsale",
         event_date="2024-03-01 20:00:00", name=None, artist="Band", genre="Rock",
         city="Seattle", venue="Hall", state="WA", capacity=10):
    """One raw snapshot row (SNAPSHOT order)."""
    return (event_id, name or f"Show {event_id}",
            ts(event_date) if event_date else None, venue, city, state, capacity, genre,
            "Sub", artist, min_price, max_price, "USD", status, "", d(day),
            ts(day + " 08:00:00"))


@pytest.fixture
def raw_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, SNAPSHOT)
    return make
