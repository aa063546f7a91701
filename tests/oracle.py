"""Runs registered queries beside their SQL and compares the values.

``python tests/oracle.py [--sf 0.001] [key ...]`` checks the given keys, or all.
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or value != value:
        return None
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, (int, float)) else (True, "n", v) for v in row)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=_key)


def compare(spark_df, connection, sql) -> str | None:
    """None when equal, else a short description of the first difference."""
    names, ours = rows_by_name(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = connection.execute(sql)
    other_names, theirs = rows_by_name([d[0] for d in cursor.description], cursor.fetchall())
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(ours) != len(theirs):
        extra, missing = set(ours) - set(theirs), set(theirs) - set(ours)
        return f"rows {len(ours)} != {len(theirs)}; spark only {list(extra)[:2]}; sql only {list(missing)[:2]}"
    if not ours:
        return "no rows"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(bad)} of {len(ours)} rows differ; first {cells[:4]}"
    types = {n: {type(v) for v in col if v is not None} for n, col in zip(names, zip(*ours))}
    sql_types = {n: {type(v) for v in col if v is not None} for n, col in zip(names, zip(*theirs))}
    return None if types == sql_types else f"types {types} != {sql_types}"


def main() -> None:
    import __spark_entry__ as entry
    from carespan.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.001")
    parser.add_argument("--cpus", type=int, default=8)
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("oracle", args.cpus)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for key in args.keys or queries:
        start = time.time()
        try:
            frame = queries[key](spark, folder)
            if key in oracles:
                problem = compare(frame, connection, oracles[key])
                note = "ok" if problem is None else problem
            else:
                count = frame.count()
                problem, note = (None, f"rows only: {count}") if count else ("empty", "no rows")
        except Exception as error:  # report and go on with the next key
            problem = note = f"{type(error).__name__}: {str(error)[:900]}"
        failures += problem is not None
        print(f"{'PASS' if problem is None else 'FAIL'} {key} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{failures} failures")
    sys.exit(1 if failures else 0)


if __name__ == "__main__":
    main()
