"""Runs registered queries against their SQL on the same files.

``python -m checks.compare [directory] [query …]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import statements

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return connection


def _canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    return f"{type(value).__name__}:{value}"


def _rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(record[i]) for i in order) for record in records)


def differences(frame, connection, sql: str) -> str | None:
    """None when columns, row count and values agree; else what does not."""
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = _rows(expected_columns, result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {sorted(set(frame.columns) ^ set(expected_columns))}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            names = sorted(frame.columns)
            return "; ".join(f"{n}: {a} != {b}" for n, a, b in zip(names, left, right) if a != b)
    return None


def main(directory: str = "/root/testdata/sf0.01", *wanted: str) -> int:
    from rosterloom.registry import all_queries
    from rosterloom.session import build_session
    spark = build_session("compare", "local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(directory), statements(), 0
    for name, query in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.time()
        try:
            problem = (differences(query(spark, directory), connection, sql[name])
                       if name in sql else "no SQL")
            count = connection.execute(f"SELECT count(*) FROM ({sql[name]})").fetchall()[0][0]
        except Exception as error:
            problem, count = str(error).replace("\n", " ")[:600], "?"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={count} "
              f"{time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
