"""View lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewright.operators import lineage
from lakewright.workload.inputs import INV, inventory, read

SOURCE, TARGET = "catalog.d1", "archive.y2025.d1"


def _views(spark, sf):
    """One view per part, naming its own entry in full, its parent's table by
    context, and a path in a literal and in a comment."""
    inv = inventory(spark, sf)
    low = F.when(F.col("k") % 2 == 0, F.upper("path")).otherwise(F.col("path"))
    folder = F.regexp_replace("path", r"\.t\d+$", "")
    return inv.select(
        F.concat(F.lit("views.v"), "k").alias("path"),
        F.concat(
            F.lit("SELECT x.a, 1.5 AS b, '"), F.col("path"), F.lit("' AS c FROM "), low,
            F.lit(" x -- "), F.col("path"), F.lit("\nJOIN t"), F.col("k").cast("string"),
            F.lit(" y ON x.a = y.a /* "), F.col("path"), F.lit(' */ JOIN "other"."place" z'),
        ).alias("sql"),
        F.split(folder, r"\.").alias("context"),
    )


def q_sql_tokens(spark, sf):
    return lineage.sql_tokens(_views(spark, sf)).withColumn("position", F.col("position").cast("long"))


def q_sql_roundtrip(spark, sf):
    # The whole text of every document is taken apart and put together again.
    docs = read(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.col("text").alias("sql"))
    from lakewright.functions import sqltext

    return docs.select(
        F.col("path").alias("doc_id"),
        (F.array_join(sqltext.pieces(F.col("sql")), "") == F.col("sql")).alias("same"),
    )


def q_rewrite_references(spark, sf):
    inv = inventory(spark, sf)
    inside = F.col("path").startswith(SOURCE + ".")
    moved = inv.filter(inside).select(
        "path", F.concat(F.lit(TARGET), F.substr("path", F.lit(len(SOURCE) + 1))).alias("target")
    )
    out = lineage.rewrite_references(
        _views(spark, sf), moved, SOURCE, TARGET, outside=inv.filter(~inside).select("path")
    )
    return out.select("path", "new_sql", F.array_join("references", ",").alias("references"), F.size("notes").cast("long").alias("notes"))


def q_view_levels(spark, sf):
    k = F.col("p_partkey")
    views = read(spark, sf, "part").select(F.concat(F.lit("v"), k).alias("path"))
    # View k selects from view k div 7 and k div 11; the ones of one brand also
    # from themselves, which is no dependency.
    needs = F.array(F.floor(k / 7), F.floor(k / 11), k)
    edges = read(spark, sf, "part").filter(k > 0).select(
        F.concat(F.lit("v"), k).alias("path"), F.explode(needs).alias("n")
    ).select("path", F.concat(F.lit("V"), "n").alias("needs"))
    return lineage.view_levels(views, edges).withColumn("level", F.col("level").cast("long"))


def q_view_cycles(spark, sf):
    k = F.col("c_custkey")
    views = read(spark, sf, "customer").select(F.concat(F.lit("v"), k).alias("path"))
    # Rings of the customers of one nation: the first of each ten heads a tree.
    ring = F.when(k % 10 == 0, k + 1).when(k % 10 == 1, k - 1).otherwise(k - k % 10)
    free = F.col("c_nationkey") < 12
    edges = read(spark, sf, "customer").select(
        F.concat(F.lit("v"), k).alias("path"), F.concat(F.lit("v"), F.when(~free, ring).otherwise(k)).alias("needs")
    )
    return lineage.view_levels(views, edges).withColumn("level", F.col("level").cast("long"))


QUERIES = {
    "sql_tokens": q_sql_tokens,
    "sql_roundtrip": q_sql_roundtrip,
    "rewrite_references": q_rewrite_references,
    "view_levels": q_view_levels,
    "view_cycles": q_view_cycles,
}

_QUOTED = "'\"' || replace({0}, '.', '\".\"') || '\"'"

ORACLES = {
    # The pieces are known from how the text was built.
    "sql_tokens": f"""WITH {INV},
p AS (SELECT k, 'views.v' || k AS path, path AS e, CASE WHEN k % 2 = 0 THEN upper(path) ELSE path END AS r FROM inv),
t AS (SELECT path, unnest([
  {{'t': 'SELECT', 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': 'x.a', 'c': true}}, {{'t': ', 1.5 ', 'c': false}},
  {{'t': 'AS', 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': 'b', 'c': true}}, {{'t': ', ', 'c': false}},
  {{'t': '''' || e || '''', 'c': false}}, {{'t': ' ', 'c': false}}, {{'t': 'AS', 'c': true}}, {{'t': ' ', 'c': false}},
  {{'t': 'c', 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': 'FROM', 'c': true}}, {{'t': ' ', 'c': false}},
  {{'t': r, 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': 'x', 'c': true}}, {{'t': ' ', 'c': false}},
  {{'t': '-- ' || e, 'c': false}}, {{'t': chr(10), 'c': false}}, {{'t': 'JOIN', 'c': true}}, {{'t': ' ', 'c': false}},
  {{'t': 't' || k, 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': 'y', 'c': true}}, {{'t': ' ', 'c': false}},
  {{'t': 'ON', 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': 'x.a', 'c': true}}, {{'t': ' = ', 'c': false}},
  {{'t': 'y.a', 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': '/* ' || e || ' */', 'c': false}}, {{'t': ' ', 'c': false}},
  {{'t': 'JOIN', 'c': true}}, {{'t': ' ', 'c': false}}, {{'t': '"other"."place"', 'c': true}}, {{'t': ' ', 'c': false}},
  {{'t': 'z', 'c': true}}]) AS s, unnest(range(41)) AS position FROM p)
SELECT path, position, s.t AS token, s.c AS is_chain FROM t""",
    "sql_roundtrip": "SELECT doc_id, true AS same FROM documents",
    "rewrite_references": f"""WITH {INV},
p AS (SELECT k, path AS e, starts_with(path, '{SOURCE}.') AS moved,
    CASE WHEN k % 2 = 0 THEN upper(path) ELSE path END AS r, '{TARGET}' || substr(path, {len(SOURCE) + 1}) AS n FROM inv)
SELECT 'views.v' || k AS path,
  'SELECT x.a, 1.5 AS b, ''' || e || ''' AS c FROM ' || CASE WHEN moved THEN {_QUOTED.format("n")} ELSE r END ||
  ' x -- ' || e || chr(10) || 'JOIN ' || CASE WHEN moved THEN {_QUOTED.format("n")} ELSE {_QUOTED.format("e")} END ||
  ' y ON x.a = y.a /* ' || e || ' */ JOIN "other"."place" z' AS new_sql,
  CASE WHEN moved THEN e ELSE '' END AS "references", CAST(NOT moved AS BIGINT) AS notes FROM p""",
    "view_levels": """
WITH RECURSIVE n AS (SELECT p_partkey AS k FROM part),
w(k, level) AS (
  SELECT k, 0 FROM n WHERE k = 0
  UNION SELECT n.k, w.level + 1 FROM w JOIN n ON (n.k // 7 = w.k OR n.k // 11 = w.k) AND n.k > 0)
SELECT 'v' || k AS path, CAST(max(level) AS BIGINT) AS level FROM w GROUP BY k""",
    "view_cycles": """SELECT 'v' || c_custkey AS path, CAST(CASE WHEN c_nationkey < 12 THEN 0
  WHEN c_custkey % 10 = 0 THEN CASE WHEN (SELECT c2.c_nationkey FROM customer c2 WHERE c2.c_custkey = c.c_custkey + 1) < 12 THEN 1 END
  WHEN c_custkey % 10 = 1 THEN CASE WHEN (SELECT c2.c_nationkey FROM customer c2 WHERE c2.c_custkey = c.c_custkey - 1) < 12 THEN 1 END
  WHEN (SELECT c2.c_nationkey FROM customer c2 WHERE c2.c_custkey = c.c_custkey - c.c_custkey % 10) < 12 THEN 1
  WHEN (SELECT c2.c_nationkey FROM customer c2 WHERE c2.c_custkey = c.c_custkey - c.c_custkey % 10 + 1) < 12 THEN 2
  END AS BIGINT) AS level FROM customer c""",
}
