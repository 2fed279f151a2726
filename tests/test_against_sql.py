"""Every registered query against its SQL counterpart in another engine."""

import duckdb
import pytest

from visitlake.oracle import SQL
from visitlake.registry import REGISTRY

SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(name, spark, duck, sf_dir):
    df = REGISTRY[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    described = {c[0]: str(c[1]).replace(" ", "") for c in cursor.description}
    assert sorted(described) == columns
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert {c: SPARK_TO_SQL.get(t, t.upper()) for c, t in types.items()} == described
    order = list(described)
    want = sorted(tuple(str(row[order.index(c)]) for c in columns) for row in cursor.fetchall())
    got = sorted(tuple(str(row[c]) for c in columns) for row in df.collect())
    assert got == want
