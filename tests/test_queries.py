import pytest

import __spark_entry__ as entry
import check
from conftest import SMALL
from millrace.registry import CHECK_SQL, QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def db():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, db, name):
    assert not check.compare(spark, db, SMALL, name).startswith("FAIL")


def test_every_query_has_sql():
    assert set(NAMES) == set(CHECK_SQL)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickup_month_year", "pickup_location_id", "median_fare_per_mile"]
    assert df.count() > 0
