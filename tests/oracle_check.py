"""Compare a registered query with its SQL on one scale factor."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def compare(spark, con, function, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = function(spark, sf_dir)
    columns, mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs_columns, theirs = rows_of(names, result.fetchall())
    if columns != theirs_columns:
        return f"columns {columns} != {theirs_columns}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"row {a!r} != {b!r}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    sql_kinds = dict(zip(names, [str(d[1]) for d in result.description]))
    for name, kind in kinds.items():
        if TYPE_NAMES.get(kind) not in (None, sql_kinds[name]):
            return f"type of {name}: {kind} != {sql_kinds[name]}"
    return None


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT"}


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, con, failures = new_session(), connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as error:  # report every query, not only the first that fails
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} equal")
    return failures


if __name__ == "__main__":
    sys.exit(main())
