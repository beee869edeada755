import pytest
from conftest import TABLES

from quillseq.plans import catalog


#: A hundred barcodes, so that some come twice and many are near each other.
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def views():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(name, spark, views):
    df, want = catalog.queries()[name](spark, SF), views.sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(repr, want.select(*[f'"{c}"' for c in columns]).fetchall()))


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
