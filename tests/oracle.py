"""Compare a registered query with its SQL on the same tables, values and types included."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "long", "double": "double", "string": "string",
    "boolean": "boolean", "INTEGER": "int", "BIGINT": "long", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(frame, connection, sql):
    """None if equal, else a short description of the first difference."""
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema.fields}
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: TYPES.get(row[1], row[1]) for row in described}
    if ours != theirs:
        return f"columns differ: {ours} and {theirs}"
    left = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    right = _rows([row[0] for row in described], connection.execute(sql).fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows and {len(right)} rows"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} of {len(left)} rows differ: {different[:2]}" if different else None


def main(sf_dir, names):
    import __spark_entry__ as entry
    from gristmill.session import build_session

    spark = build_session("oracle", "local[8]", settings={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = database(sf_dir), entry.oracle_sql()
    bad = []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            frame = query(spark, sf_dir)
            found = compare(frame, connection, sql[name]) if name in sql else f"rows only: {len(frame.collect())}"
        except Exception as error:  # noqa: BLE001
            found = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if found and not found.startswith("rows only"):
            bad.append(name)
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {found or 'equal'}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
