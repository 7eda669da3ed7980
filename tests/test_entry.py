"""The driver's contract, on the smallest tables."""

import os

import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_names():
    assert set(e.oracle_sql()) <= set(e.queries())


def test_flagship(spark):
    df = e.entry(spark)
    assert df.count() > 0 and "salary_min_hourly" in df.columns


@pytest.mark.parametrize("name", ["p2_found", "p4_found", "demand_summary", "batch_ids", "topk_per_group"])
def test_against_sql(spark, name):
    import duckdb

    from verify import canonical

    con = duckdb.connect()
    for path in os.listdir(SF):
        con.execute(f"CREATE VIEW {path[:-8]} AS SELECT * FROM read_parquet('{SF}/{path}')")
    df = e.queries()[name](spark, SF)
    found = con.execute(e.oracle_sql()[name])
    assert canonical(df.columns, df.collect()) == canonical([c[0] for c in found.description], found.fetchall())
