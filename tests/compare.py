"""Run registered queries in Spark and DuckDB and compare them row by row.

``python tests/compare.py [sf] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return columns, cursor.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def normal(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def compare(spark, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    columns, rows = duckdb_rows(sf_dir, sql)
    theirs = normal(columns, rows)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if ours == theirs:
        return None
    only_ours = sorted(set(ours) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} vs {len(theirs)} rows\n  spark only {only_ours}\n  duckdb only {only_theirs}"


def main() -> None:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = make_session()
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, sf_dir, query, sql[name])
                status = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                status = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:
            status = f"FAILS {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {status}", flush=True)


if __name__ == "__main__":
    main()
