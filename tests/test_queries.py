"""Every registered query of the library against its SQL in DuckDB."""

import duckdb
import pytest

from tilework import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(x):
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (list, tuple)):
        return str([shown(v) for v in x])
    return x.isoformat() if hasattr(x, "isoformat") else repr(x)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    rows, columns = df.collect(), sorted(df.columns)
    if name not in queries.ORACLE_SQL:
        assert rows
        return
    expected = duck.sql(queries.ORACLE_SQL[name])
    at = [expected.columns.index(c) for c in columns]
    assert sorted(expected.columns) == columns
    assert sorted(tuple(shown(r[c]) for c in columns) for r in rows) == sorted(tuple(shown(r[i]) for i in at) for r in expected.fetchall())
