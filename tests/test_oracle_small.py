"""Every query with a DuckDB twin agrees with it on the smallest tables.

Same comparison as the driver's gate (column names, row count, multiset of
rows with floats rounded to 6 significant digits), at sf0.001.
"""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    d_cols = rel.columns
    d_rows = rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    dorder = [d_cols.index(s_cols[i]) for i in order]
    sc = Counter(tuple(norm(r[i]) for i in order) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in dorder) for r in d_rows)
    assert sc == dc, (list((sc - dc).elements())[:3], list((dc - sc).elements())[:3])
