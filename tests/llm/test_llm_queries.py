"""Every registered corpus query against its SQL on the smallest data set; those without SQL must run."""

import duckdb
import pytest

import __spark_entry__ as driver
import check_oracle
from pitframe.llm import queries as corpus
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for name in check_oracle.TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return c


@pytest.mark.parametrize("key", list(corpus.queries()))
def test_query(spark, con, key):
    status, rows, _ = check_oracle.compare(spark, con, key, DATA, show=False)
    assert rows > 0
    assert status == ("ok" if key in corpus.oracle_sql() else "rows-only")


def test_all_operators_are_registered():
    assert [k for k in driver.queries() if k.startswith("op")] == [k for k in corpus.queries() if k.startswith("op")]
    assert {k.split("_")[0] for k in corpus.queries()} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
