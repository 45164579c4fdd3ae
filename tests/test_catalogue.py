"""Every catalogue query with SQL against DuckDB on the same tables."""

import duckdb
import pytest
from conftest import SF

from silverloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(values):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(want.columns) == cols
    assert rows(df.select(*cols).collect()) == rows(want.select(*[f'"{c}"' for c in cols]).fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
