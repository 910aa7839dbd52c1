"""Run queries in Spark and their SQL in DuckDB and compare names, types and rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _key(row):
    return tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in row)


def _same(a, b) -> bool:
    return a == b and type(a) is type(b)


def difference(spark_frame, connection, sql: str) -> str | None:
    """What differs, or None."""
    columns = sorted(spark_frame.columns)
    ours = sorted((tuple(r) for r in spark_frame.select(*columns).collect()), key=_key)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    places = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    if not ours:
        return "no rows"
    for a, b in zip(ours, theirs):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{a} against {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from floodplan.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}" if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = duck(sf_dir)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = difference(query(spark, sf_dir), connection, oracle[name])
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s", found or "")


if __name__ == "__main__":
    main()
