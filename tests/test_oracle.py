"""Every query with SQL: same rows as DuckDB on the same tables."""

import math
import pathlib

import duckdb
import pytest

from scoreloom.catalog import QUERIES, SQL


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def duck(small_dir):
    connection = duckdb.connect()
    for path in pathlib.Path(small_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, small_dir, name):
    result = QUERIES[name](spark, small_dir)
    expected = duck.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    want = normalised(columns, expected.fetchall())
    got = normalised(result.columns, [tuple(r) for r in result.collect()])
    assert len(got) == len(want) > 0
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:3]
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    kinds = {d[0]: str(d[1]) for d in expected.description}
    for field in result.schema:
        assert types[field.dataType.simpleString()] == kinds[field.name], (field, kinds[field.name])
