"""Queries with SQL give the same rows as DuckDB."""
import duckdb
import pytest

from conewise.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    got = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    con.execute(f"create view expected as {registry.ORACLES[name]}")
    want = con.execute("select * from expected")
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
