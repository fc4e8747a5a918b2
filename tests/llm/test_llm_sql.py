"""Every corpus query with a SQL twin matches DuckDB, on the given tables."""

import pytest

from ridewise.llm.queries import QUERIES, SQL
from ridewise.plans.compare import compare

from conftest import SF


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert compare(df.columns, rows, cols, cur.fetchall()) is None


def test_registered():
    import __spark_entry__ as e
    names = e.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(SQL) <= set(e.oracle_sql())
