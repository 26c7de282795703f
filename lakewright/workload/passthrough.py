"""Any SELECT over copied tables, and row limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewright.lake import Lake
from lakewright.operators import ingest, lifecycle
from lakewright.operators.views import executable_sql
from lakewright.workload.ingest import new_lake
from lakewright.workload.inputs import read


def run_sql(lake: Lake, sql: str):
    """A statement written with catalog paths, as a DataFrame."""
    return lake.spark.sql(executable_sql(lake, sql))


def _snapshot(spark, sf) -> Lake:
    """Orders and lineitem loaded from their files and copied into a version."""
    lake = new_lake(spark)
    for name in ("orders", "lineitem"):
        ingest.ingest(lake, f"{sf}/{name}.parquet", f"catalog.sales.draft.{name}", "parquet")
    lifecycle.draft_to_version(lake, "catalog.sales", "v1")
    return lake


JOIN = """
SELECT o.o_orderpriority, l.l_returnflag, count(*) AS items,
  round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
FROM {orders} o JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus <> 'P' GROUP BY o.o_orderpriority, l.l_returnflag"""
WINDOW = """
SELECT o_custkey, o_orderkey, rn FROM (
  SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn
  FROM {orders}) t WHERE rn <= 2"""
SETOP = """
SELECT o_orderkey AS k FROM {orders} WHERE o_orderstatus = 'F' EXCEPT
SELECT l_orderkey FROM {lineitem} WHERE l_returnflag = 'R'"""
_PATHS = {n: f'"catalog"."sales"."versions"."v1"."{n}"' for n in ("orders", "lineitem")}
_NAMES = {n: n for n in _PATHS}


def q_run_sql_join_agg(spark, sf):
    return run_sql(_snapshot(spark, sf), JOIN.format(**_PATHS))


def q_run_sql_window(spark, sf):
    return run_sql(_snapshot(spark, sf), WINDOW.format(**_PATHS))


def q_run_sql_setop(spark, sf):
    return run_sql(_snapshot(spark, sf), SETOP.format(**_PATHS))


def q_limit_per_table(spark, sf):
    parts = [
        read(spark, sf, n).limit(100).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
        for n in ("region", "supplier", "orders", "lineitem")
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


QUERIES = {
    "run_sql_join_agg": q_run_sql_join_agg,
    "run_sql_window": q_run_sql_window,
    "run_sql_setop": q_run_sql_setop,
    "limit_per_table": q_limit_per_table,
}

ORACLES = {
    "run_sql_join_agg": JOIN.format(**_NAMES),
    "run_sql_window": WINDOW.format(**_NAMES),
    "run_sql_setop": SETOP.format(**_NAMES),
    "limit_per_table": " UNION ALL ".join(
        f"SELECT '{n}' AS name, least(100, count(*)) AS rows FROM {n}" for n in ("region", "supplier", "orders", "lineitem")
    ),
}
