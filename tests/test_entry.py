import __spark_entry__ as e


def test_contract(spark):
    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
