"""Every core query with SQL against DuckDB on the smallest tables; the llm subpackage is optional."""

import duckdb
import pytest

from threadloom.operators import core_queries, reference_queries

D = "/root/testdata/sf0.001"
TABLES = "messages conversation language_annotations documents events".split()
SQL = {**core_queries.SQL, **reference_queries.SQL}
Q = {**core_queries.QUERIES, **reference_queries.QUERIES}


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, db, name):
    df = Q[name](spark, D)
    r = db.execute(SQL[name])
    cols = [x[0] for x in r.description]
    assert sorted(cols) == sorted(df.columns)
    show = lambda v: str(round(v, 9) if isinstance(v, float) else v)
    want = sorted(tuple(show(b[cols.index(c)]) for c in sorted(cols)) for b in r.fetchall())
    assert sorted(tuple(show(x[c]) for c in sorted(cols)) for x in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(Q) - set(SQL)))
def test_others_give_rows(spark, name):
    """Their results are checked against brute force in the tests of their operators."""
    assert Q[name](spark, D).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
