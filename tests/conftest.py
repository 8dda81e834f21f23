import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stellate.session import build_session  # noqa: E402
from stellate.sources.store import TableStore  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="stellate-tests", conf={"spark.sql.shuffle.partitions": "4"})
    yield s


@pytest.fixture
def store(spark):
    return TableStore.scratch(spark, "test")
