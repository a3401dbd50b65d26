import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_oracle_but_declared_exceptions():
    from conewise import registry
    q, o = registry.queries(), registry.oracle_sql()
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql())
    assert set(o) <= set(q)
    assert set(q) == set(o)


def test_registered_query_runs(spark):
    df = E.queries()["D11_fx_daily"](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
