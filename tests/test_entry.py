"""Driver contract: entry runs; every oracle key has a query; names match."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["bin_idx", "bin_label", "n", "churn_rate"]
    assert 1 <= len(rows) <= 6


def test_oracle_keys_subset_of_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 40
