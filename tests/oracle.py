"""Run registered queries and their SQL side by side: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def text(value: object) -> str:
    """Same text for equal values of both engines, with their kind, so that 1 and '1' differ."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, float):
        return f"float:{value!r}"
    if isinstance(value, decimal.Decimal):
        return f"dec:{value.normalize():f}"
    if isinstance(value, datetime.datetime):
        return f"ts:{value.isoformat()}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(text(row[i]) for i in places) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    from tablewright.registry import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return None if found else "no rows"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    wanted = rows_of(columns, result.fetchall())
    if found == wanted:
        return None
    extra, missing = [r for r in found if r not in set(wanted)][:2], [r for r in wanted if r not in set(found)][:2]
    return f"{len(found)} rows against {len(wanted)}; only Spark {extra}; only SQL {missing}"


def main() -> int:
    from tablewright.registry import QUERIES
    from tablewright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
