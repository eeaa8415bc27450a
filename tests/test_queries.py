"""Every registered query of the page operators against its SQL on the smallest tables."""

import duckdb
import pytest

from pagelake import registry
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if hasattr(v, "asDict"):
        return tuple(map(plain, v))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", registry.QUERIES)
def test_same_rows_as_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    other = duck.sql(registry.SQL[name])
    at = [other.columns.index(c) for c in names]
    assert sorted(other.columns) == names
    assert ours == sorted((tuple(plain(r[i]) for i in at) for r in other.fetchall()), key=repr)


def test_entry_imports_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    import __spark_entry__

    module = importlib.reload(__spark_entry__)
    assert set(module.queries()) == set(registry.QUERIES)
    monkeypatch.undo()
    importlib.reload(module)
