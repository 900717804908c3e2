import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "CUSTOMER_ID_MAX_AMOUNT_30DAY_WINDOW" in df.columns


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
