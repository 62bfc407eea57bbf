"""Every registered query of the engine against its SQL on DuckDB, and the entry module's contract."""

import os

import duckdb
import pytest
from codespine.plans import catalog

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else tuple(map(plain, value)) if isinstance(value, (list, tuple)) else str(value)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    want = duck.sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    place = [want.columns.index(c) for c in columns]
    assert got == sorted(str([plain(r[i]) for i in place]) for r in want.fetchall())
    assert got


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
