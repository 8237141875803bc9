"""The driver contract: entry, queries, oracle SQL."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def test_oracles_are_subset_of_queries():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 73
