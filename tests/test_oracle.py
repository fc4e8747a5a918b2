"""Every query with a SQL twin matches DuckDB on the sf0.001 tables."""

import pytest

from ridewise.plans.catalog import load_all
from ridewise.plans.compare import compare

from conftest import SF

SQL_QUERIES = sorted(n for n, s in load_all().items() if s.sql)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_matches_duckdb(spark, duck, name):
    spec = load_all()[name]
    df = spec.fn(spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(spec.sql)
    dcols = [d[0] for d in cur.description]
    assert compare(df.columns, srows, dcols, cur.fetchall()) is None


def test_every_query_maps_to_operators():
    for name, spec in load_all().items():
        assert spec.ops, name


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
