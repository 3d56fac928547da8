import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tripspark.config import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment when it names one; otherwise the library
    # falls back to a private temporary folder (local mode only)
    s = build_session("local[*]", app_name="tripspark-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def fixture_frame(spark):
    """24 rows, the last one three times: nulls in a number (25 %), in a text, and in one row (4 %) of the last column."""
    numbers = [*range(1, 23), 22, 22]
    rows = [
        (i, None if i % 4 == 1 else float(i % 3), None if i % 5 == 0 else ("north" if i % 2 else "south"), None if i == 7 else 10 * i)
        for i in numbers
    ]
    return spark.createDataFrame(rows, "trip long, toll double, zone string, weight long")
