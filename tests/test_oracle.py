"""Every registered query on the given tables against DuckDB; needs the test data folder."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402
from oracle import connect, differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    frame = registry.queries()[name](spark, FOLDER)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert differences(frame, sql, duck) == []


def test_entry(spark):
    assert registry.entry(spark).count() == 40 * 10
