"""Compares registered queries with their SQL on the same Parquet files."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(record[i]) for i in order) for record in records),
        key=lambda row: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row),
    )


def of_spark(frame):
    return frame.columns, rows(frame.columns, [tuple(r) for r in frame.collect()])


def of_sql(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, rows(names, cursor.fetchall())


def compare(spark, folder, name, query, sql, connection):
    """Problems found, as text; empty when both agree."""
    names, ours = of_spark(query(spark, folder))
    if sql is None:
        return "" if ours is not None else "no rows"
    sql_names, theirs = of_sql(connection, sql)
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(names)} != {sorted(sql_names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, SQL has {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return ""


def main():
    import __spark_entry__ as entry
    from salesloom.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sql = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, folder, name, query, sql.get(name), connection)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32} {time.time() - start:6.2f}s {'ok' if not problem else problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
