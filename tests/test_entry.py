import __spark_entry__ as E


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert "c_custkey" in df.columns and "fe_return_rate" in df.columns
    assert df.count() > 0
    assert E.entry(spark).schema == df.schema


def test_every_oracle_names_a_query():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100
    assert all(callable(f) for f in q.values())
