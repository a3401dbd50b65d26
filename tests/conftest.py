import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from conewise.session import get_spark
    s = get_spark(app="conewise-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def shop(spark):
    """One warehouse over the smallest test tables, shared by the model tests."""
    from conewise.plans.warehouse import Shop
    return Shop.from_test_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from conewise.oracle import TEST_TABLES
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create or replace view {t} as select * from read_parquet('{p}')")
    return con
