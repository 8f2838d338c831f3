"""Compare every checked query with its SQL in DuckDB: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.fixtures import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(con: duckdb.DuckDBPyConnection, df, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    mine, theirs = _rows(df.columns, df.collect()), _rows(names, result.fetchall())
    if mine == theirs:
        return None
    extra, missing = mine - theirs, theirs - mine
    return (
        f"rows {mine.total()} != {theirs.total()}; only here {list(extra)[:2]}; only in SQL {list(missing)[:2]}"
    )


def main() -> None:
    from tidemark.plans import registry
    from tidemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.QUERIES)
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            found = difference(con, df, registry.ORACLES[name]) if name in registry.ORACLES else "no SQL"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - started:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
