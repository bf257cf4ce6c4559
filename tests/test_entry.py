"""The driver contract, and each query with SQL against DuckDB on the smallest tables."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry
from readweave import session
from readweave.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return None if v is None or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_entry_without_the_text_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "readweave.llm", None)
    monkeypatch.setitem(sys.modules, "readweave.llm.queries", None)
    assert set(entry.queries()) == set(registry.QUERIES) and set(entry.oracle_sql()) == set(registry.ORACLES)


def test_scratch_is_shared(spark, monkeypatch):
    kept = session.scratch_dir(spark)
    assert kept.endswith(kept.split("/")[-1])

    class Far:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.scratch_dir(Far)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, db, name):
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    cursor = db.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
