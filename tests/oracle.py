"""Run registered queries and their SQL side by side.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, relation) -> str | None:
    """Why the two results differ, or None."""
    mine, theirs = sorted(spark_df.columns), sorted(relation.columns)
    if mine != theirs:
        return f"columns {mine} against {theirs}"
    a = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    b = rows_of(relation.columns, relation.fetchall())
    if a == b:
        return None
    extra, lacking = list((a - b).items())[:3], list((b - a).items())[:3]
    return f"{sum(a.values())} rows against {sum(b.values())}; only here {extra}; only there {lacking}"


def main(args: list[str]) -> int:
    import __spark_entry__ as entry
    from lakewright.session import local_session

    sf = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    spark, con = local_session(), connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                why = compare(df, con.sql(oracles[name]))
            else:
                why = None if df.count() else "no rows"
        except Exception as exc:  # noqa: BLE001 - one failure must not hide the others
            why = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += why is not None
        mark = "ok  " if why is None else "FAIL"
        kind = "sql" if name in oracles else "rows"
        print(f"{mark} {time.time() - start:6.2f}s {kind} {name} {why or ''}", flush=True)
    print(f"{len(args or queries)} queries, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
