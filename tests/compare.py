"""Row comparison between Spark and DuckDB."""

import duckdb

import oracle
from promolens.schemas import SPECS


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def spark_rows(df):
    return ordered(tuple(r) for r in df.collect())


def duck_rows(connection, sql, columns):
    cursor = connection.execute(sql)
    found = [c[0] for c in cursor.description]
    assert sorted(found) == sorted(columns)
    places = [found.index(c) for c in columns]
    return ordered(tuple(r[i] for i in places) for r in cursor.fetchall())


def connect(tables):
    """DuckDB with the campaign tables as they are in Spark."""
    connection = duckdb.connect()
    kinds = {"decimal": "DECIMAL(10,2)", "date": "DATE", "long": "BIGINT", "integer": "INTEGER",
             "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, df in tables.items():
        columns = ", ".join(f"{f.name} {kinds[f.dataType.typeName()]}" for f in SPECS[name].schema)
        connection.execute(f"CREATE TABLE {name} ({columns})")
        rows = [tuple(r) for r in df.collect()]
        if rows:
            marks = ", ".join("?" * len(rows[0]))
            connection.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
    return connection


def sample_bodies(home, as_of):
    return oracle.bodies(("Pro", "Agency"), home, as_of, as_of)
