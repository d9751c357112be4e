import json

import pytest

import __spark_entry__
from palimpsest import cli
from palimpsest.plans import inputs, registry


def test_registry_is_consistent():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and set(registry.QUERIES) <= set(queries) and len(registry.QUERIES) >= 40


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["line_id", "text", "gate"] and __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for t in ("orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "conversations"):
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = base.execute(registry.SQL[name])
    columns = [c[0] for c in found.description]
    want = [tuple(r) for r in found.fetchall()]
    got = registry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got.select(*columns).collect()) == order(want)


def test_cli(spark, sf, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    cli.main(["info"])
    assert json.loads(capsys.readouterr().out)["spark"] == spark.version
    inputs.logits(spark, sf).write.parquet(str(tmp_path / "logits"))
    cli.main(["decode", str(tmp_path / "logits"), str(tmp_path / "out"), "--beam", "3", "--max-flags", "2"])
    assert spark.read.parquet(str(tmp_path / "out")).where("gate = 'flagged'").count() == 2
    inputs.pairs(spark, sf).limit(50).write.parquet(str(tmp_path / "pairs"))
    cli.main(["evaluate", str(tmp_path / "pairs"), "--key", "doc_id", "--key", "line_id"])
    assert json.loads(capsys.readouterr().out)["num_lines"] == 50
