"""Every registered driver query against its DuckDB oracle on the smallest
driver tables (row count, column names, order-insensitive values)."""

import os

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "file_number" in df.columns


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as E
    from driverq.compare import duck_connection, frame_digest
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    con = duck_connection(SF)
    bad = []
    for name, fn in qs.items():
        df = fn(spark, SF)
        rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            continue
        rel = con.sql(sqls[name])
        a = frame_digest(df.columns, rows)
        b = frame_digest(list(rel.columns), rel.fetchall())
        if a[:3] != b[:3]:
            bad.append(name)
    assert not bad, bad
