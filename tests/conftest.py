import itertools
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from check_oracles import local_session  # noqa: E402
from spanloom import schemas  # noqa: E402
from spanloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session("4"))
    yield session
    session.stop()


@pytest.fixture
def light(spark):
    """Light spans from (span id, parent id, service, type) in order of arrival."""
    def make(rows, trace="t", time_ms=1_000_000, duration_us=100_000, start=0):
        counter = itertools.count(start)
        data = [
            (trace, span_id, parent, time_ms, service, "oper", duration_us, kind, {}, next(counter))
            for span_id, parent, service, kind in rows
        ]
        return spark.createDataFrame(data, schemas.LIGHT_SPAN)

    return make


@pytest.fixture
def raw(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.SPAN)
