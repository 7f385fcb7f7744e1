"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(base: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{base}/{table}.parquet'")
    return db


def kind(name: str) -> str:
    """One name per type for both engines."""
    name = name.lower()
    return {"varchar": "string", "integer": "int"}.get(name, name)


def spark_rows(df):
    names = sorted(df.columns)
    types = [kind(df.schema[n].dataType.simpleString()) for n in names]
    rows = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    return names, types, sorted(rows, key=repr)


def duck_rows(db, sql):
    result = db.execute(sql)
    types = {d[0]: kind(str(d[1])) for d in result.description}
    names = sorted(types)
    position = {d[0]: i for i, d in enumerate(result.description)}
    rows = [tuple(row[position[n]] for n in names) for row in result.fetchall()]
    return names, [types[n] for n in names], sorted(rows, key=repr)
