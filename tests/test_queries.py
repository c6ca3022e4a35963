"""Every registered query of the fleet model against its SQL."""

import duckdb
import pandas as pd
import pytest

from velora.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _value(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, float):
        return round(x, 6)
    return x if isinstance(x, (int, str, bool)) else str(x)


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    return sorted(repr([_value(x.item() if hasattr(x, "item") else x) for x in r]) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_runs(spark, sf_dir):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, sf_dir).count() > 0, name


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
