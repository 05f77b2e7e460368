"""Every query of the guide engine that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from tessera.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    want = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_has_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
