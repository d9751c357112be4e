import pytest

from palimpsest.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = base.execute(oracle.SQL[name])
    columns = [c[0] for c in found.description]
    want = [tuple(r) for r in found.fetchall()]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got.select(*columns).collect()) == order(want) and want
