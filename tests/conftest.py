import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("WAYMARK_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from waymark.plans.session import make_session

    session = make_session("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
