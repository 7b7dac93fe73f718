"""Every registered query against its SQL in DuckDB, on the smallest data set; the rest must run."""

import duckdb
import pytest

import __spark_entry__ as driver
import check_oracle
from catalog import load
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for name in check_oracle.TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return c


@pytest.mark.parametrize("key", list(load()[0]))
def test_query(spark, con, key):
    status, _, _ = check_oracle.compare(spark, con, key, DATA, show=False)
    assert status in ("ok", "rows-only")


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.columns == ["security_id", "session_no", "state", "value", "outcome", "position"]


def test_oracle_covers_all():
    queries, sql = load()
    assert set(queries) == set(sql)
    assert set(queries) <= set(driver.queries()) and set(sql) <= set(driver.oracle_sql())
