"""Lifecycle queries: real copies, versions, releases and publications of the
given tables, and the plans behind them over a whole inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakewright.functions import paths
from lakewright.operators import folders, lifecycle, views
from lakewright.operators.writes import create_table
from lakewright.plans import lifecycle as plans
from lakewright.plans.folders import folder_scan
from lakewright.workload.ingest import ORDERS, _orders, new_lake
from lakewright.workload.inputs import INV, META, inventory, metadata, read

AREA = "catalog.trade.sales.area"


def _union(lake, listed):
    """The rows of several tables, each with its path."""
    frames = [lake.table(p).withColumn("path", F.lit(p)) for p in listed]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _area(spark, sf):
    """An area whose draft holds the orders by status, and a view over one of them."""
    lake, orders = new_lake(spark), _orders(read(spark, sf, "orders"))
    for status, where in (("F", "draft"), ("O", "draft.detail"), ("P", "draft.reference")):
        part = orders.filter(F.col("o_orderstatus") == status)
        create_table(lake, part, f"{AREA}.{where}.orders_{status.lower()}")
    lake.ensure_folder(f"{AREA}.versions")
    lake.ensure_folder(f"{AREA}.reference")
    views.create_view_as(
        lake, f"{AREA}.draft.dear",
        f'SELECT * FROM "catalog"."trade".sales.area.draft.orders_f WHERE o_totalprice > 250000',
    )
    return lake


def q_copy_table(spark, sf):
    lake = new_lake(spark)
    create_table(lake, _orders(read(spark, sf, "orders")), "catalog.a.orders", partition_by=["o_orderstatus"])
    lifecycle.copy_table(lake, "catalog.a.orders", "catalog.b.orders_copy", create_folder=True)
    # Replaced once more, by partition.
    lifecycle.copy_table(lake, "catalog.a.orders", "catalog.b.orders_copy", overwrite=True)
    assert lifecycle.partition_columns(lake, "catalog.b.orders_copy") == ["o_orderstatus"]
    return lake.table("catalog.b.orders_copy")


def q_copy_overwrite(spark, sf):
    lake, orders = new_lake(spark), _orders(read(spark, sf, "orders"))
    create_table(lake, orders, "catalog.a.orders")
    create_table(lake, orders.filter("o_orderstatus = 'P'"), "catalog.b.orders")
    lifecycle.copy_table(lake, "catalog.a.orders", "catalog.b", overwrite=True)
    return lake.table("catalog.b.orders")


def q_move_table(spark, sf):
    lake, orders = new_lake(spark), _orders(read(spark, sf, "orders"))
    create_table(lake, orders, "catalog.a.orders")
    lifecycle.move_table(lake, "catalog.a.orders", "catalog.a.renamed")
    lifecycle.move_table(lake, "catalog.a.renamed", "catalog.z.moved", create_folder=True)
    assert [p for p, _ in lake.entries()] == ["catalog.z.moved"]
    return lake.table("catalog.z.moved")


def q_move_view(spark, sf):
    lake, orders = new_lake(spark), _orders(read(spark, sf, "orders"))
    create_table(lake, orders, "catalog.a.orders")
    views.create_view_as(lake, "catalog.a.open", "SELECT * FROM catalog.a.orders WHERE o_orderstatus = 'O'")
    lifecycle.move_table(lake, "catalog.a.open", "catalog.z.open", create_folder=True)
    return lake.table("catalog.z.open")


def q_view_over_table(spark, sf):
    lake = new_lake(spark)
    create_table(lake, _orders(read(spark, sf, "orders")), "catalog.a.orders")
    views.create_view(lake, "catalog.a.orders", "catalog.v.orders")
    return lake.table("catalog.v.orders")


def q_view_as_sql(spark, sf):
    lake = new_lake(spark)
    create_table(lake, read(spark, sf, "orders"), "catalog.a.orders")
    create_table(lake, read(spark, sf, "customer"), "catalog.a.customer")
    views.create_view_as(
        lake, "catalog.v.spend",
        'SELECT c.c_mktsegment, count(*) AS orders, round(sum(o.o_totalprice), 2) AS spent '
        'FROM "catalog"."a"."orders" o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment',
        context=["catalog", "a"],
    )
    return lake.table("catalog.v.spend")


def q_table_to_view(spark, sf):
    lake, orders = new_lake(spark), _orders(read(spark, sf, "orders"))
    create_table(lake, orders, "catalog.a.orders")
    create_table(lake, orders.filter("o_orderstatus = 'P'"), "catalog.b.orders")
    lifecycle.table_to_view(lake, "catalog.b.orders", "catalog.a.orders")
    assert lake.kind("catalog.b.orders") == "VIEW"
    return lake.table("catalog.b.orders")


def q_view_definitions(spark, sf):
    """Each view's text, read back, run again and compared with the view by content."""
    lake = _area(spark, sf)
    rows = folders.view_definitions(lake, AREA).collect()
    pairs = {r["path"]: (lake.table(r["path"]), spark.sql(views.executable_sql(lake, r["sql"], r["context"]))) for r in rows}
    return lifecycle.verify_copy(pairs)


def q_version_plan(spark, sf):
    return plans.version_plan(inventory(spark, sf).select("path", "kind"), "catalog", "archive.versions.v2")


def q_create_version(spark, sf):
    lake = _area(spark, sf)
    lifecycle.create_version(lake, f"{AREA}.draft", "v1", f"{AREA}.versions")
    return _union(lake, [p for p, _ in lake.entries(f"{AREA}.versions.v1")])


def q_draft_to_version(spark, sf):
    lake = _area(spark, sf)
    return lifecycle.draft_to_version(lake, AREA, "v1").select("source", "target", "status", "rows")


def _one_area(spark, sf):
    """All parts in one area; every third one's name is taken at the area's root."""
    k = F.col("k")
    branch = F.element_at(F.split(F.lit("draft,versions.v1,reference,themes"), ","), (F.floor(k / 30) % 4 + 1).cast("int"))
    entries = inventory(spark, sf).withColumn("at", F.concat(F.lit(AREA + "."), branch, F.lit(".")))
    own = entries.select(F.concat("at", F.when(k % 50 == 31, F.lit("draft.")).otherwise(F.lit("")), F.lit("t"), "k").alias("path"), "kind")
    root = entries.filter(k % 3 == 0).select(
        F.concat(F.lit(AREA + ".t"), "k").alias("path"), F.when(k % 2 == 0, F.lit("TABLE")).otherwise(F.lit("VIEW")).alias("kind")
    )
    return own.unionByName(root)


def q_release_plan(spark, sf):
    return plans.release_plan(_one_area(spark, sf), AREA, "v1", overwrite=False)


def q_publish_plan(spark, sf):
    k = F.col("k")
    meta = metadata(spark, sf).select(
        F.concat(F.lit(AREA + "."), F.element_at(F.split(F.lit("draft,versions.v1,reference,themes"), ","), (F.floor(k / 30) % 4 + 1).cast("int")), F.lit(".t"), "k").alias("path"),
        F.lit("VIEW").alias("kind"), "tags", "k",
    )
    names = F.when(k % 4 == 0, F.array(F.lit("id"))).otherwise(F.array(F.lit("id"), F.lit("Year")))
    columns = meta.select("path", names.alias("names"))
    published = meta.filter(k % 5 == 0).select(F.concat(F.lit("public."), "path").alias("path"))
    out = plans.publish_plan(meta.drop("k"), columns, published, AREA, "public", False, ["year"])
    return out.select("view", "target", "action", F.array_join("partition", ",").alias("partition"), "problem")


def _released(spark, sf):
    lake = _area(spark, sf)
    lifecycle.draft_to_version(lake, f"{AREA}.draft", "v1")
    for path, _ in lake.entries(f"{AREA}.versions.v1"):
        lake.set_tags(path, ["kept", plans.PUBLIC_TAG])
    lifecycle.update_latest_release(lake, AREA, "v1")
    return lake


def q_latest_release(spark, sf):
    lake = _released(spark, sf)
    listed = [p for p, k in lake.entries(AREA) if k == "VIEW" and ".draft." not in p]
    tags = lake.metadata(AREA).select("path", F.array_join("tags", ",").alias("tags"))
    return _union(lake, listed).join(tags, "path")


def q_release_untags(spark, sf):
    # What the release left tagged below the versions, with the rows behind it.
    lake = _released(spark, sf)
    listed = [p for p, _ in lake.entries(f"{AREA}.versions")]
    counts = _union(lake, listed).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(lake.metadata(AREA).select("path", F.array_join("tags", ",").alias("tags")), "path")


def q_publish_tables(spark, sf):
    lake = _released(spark, sf)
    lifecycle.publish(lake, AREA, "public")
    return _union(lake, [p for p, _ in lake.entries("public")])


def _partitioned(spark, sf):
    lake = _released(spark, sf)
    lifecycle.publish(lake, AREA, "public")
    report = lifecycle.publish(
        lake, AREA, "public",
        partition_by={"detail/orders_o": ["O_ORDERPRIORITY"], "orders_f": ["o_orderpriority", "o_orderstatus"]},
    )
    return lake, report


def q_publish_report(spark, sf):
    return _partitioned(spark, sf)[1].select(F.col("target").alias("path"), "status", "rows", "note")


def q_publish_partitioned(spark, sf):
    lake, _ = _partitioned(spark, sf)
    assert lifecycle.partition_columns(lake, f"public.{AREA}.orders_f") == ["o_orderpriority", "o_orderstatus"]
    return _union(lake, [p for p, _ in lake.entries("public")])


def q_folder_scan(spark, sf):
    inv = inventory(spark, sf).select("path", "kind", "k")
    by_key = inv.select(F.col("k").alias("needs"), F.col("path").alias("other"))
    texts = inv.filter("kind = 'VIEW'").withColumn("needs", F.floor(F.col("k") / 7)).join(by_key.hint("merge"), "needs").select(
        "path", F.concat(F.lit("SELECT * FROM "), "other").alias("sql"), F.lit(None).cast("array<string>").alias("context")
    )
    out = folder_scan(inv.select("path", "kind"), texts, "catalog", "archive.y2025")
    return out.select(
        "kind", "source", "target", F.col("level").cast("long").alias("level"), "new_sql",
        F.array_join("references", ",").alias("references"),
    )


def q_folder_copy_report(spark, sf):
    lake, source = _area(spark, sf), f"{AREA}.draft"
    # One target is there with all its rows, one with too few.
    orders = _orders(read(spark, sf, "orders"))
    create_table(lake, orders.filter("o_orderstatus = 'F'"), "catalog.trade.kept.orders_f")
    create_table(lake, orders.filter("o_orderstatus = 'O' AND o_totalprice > 250000"), "catalog.trade.kept.detail.orders_o")
    return folders.folder_copy(lake, source, "catalog.trade.kept").select(
        "kind", "source", "target", "status", "source_rows", "target_rows"
    )


def q_folder_move(spark, sf):
    lake = _area(spark, sf)
    lake.set_tags(f"{AREA}.draft.dear", ["kept"])
    folders.folder_move(lake, f"{AREA}.draft", "archive.y2025")
    assert not lake.is_folder(f"{AREA}.draft") and lake.tags("archive.y2025.dear") == ["kept"]
    return _union(lake, [p for p, _ in lake.entries("archive")])


def q_verify_copy(spark, sf):
    lineitem, orders = read(spark, sf, "lineitem"), read(spark, sf, "orders")
    lake = new_lake(spark)
    create_table(lake, lineitem, "catalog.a.lineitem", partition_by=["l_returnflag"])
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 7, 0.0).otherwise(F.col("o_totalprice")))
    # The shuffled copy is equal, the one with a changed value is not.
    same = lake.table("catalog.a.lineitem").select(lineitem.columns)
    return lifecycle.verify_copy({"lineitem": (lineitem, same), "orders": (orders, changed)})


QUERIES = {
    "copy_table": q_copy_table,
    "copy_overwrite": q_copy_overwrite,
    "move_table": q_move_table,
    "move_view": q_move_view,
    "view_over_table": q_view_over_table,
    "view_as_sql": q_view_as_sql,
    "table_to_view": q_table_to_view,
    "view_definitions": q_view_definitions,
    "version_plan": q_version_plan,
    "create_version": q_create_version,
    "draft_to_version": q_draft_to_version,
    "release_plan": q_release_plan,
    "publish_plan": q_publish_plan,
    "latest_release": q_latest_release,
    "release_untags": q_release_untags,
    "publish_tables": q_publish_tables,
    "publish_report": q_publish_report,
    "publish_partitioned": q_publish_partitioned,
    "folder_scan": q_folder_scan,
    "folder_copy_report": q_folder_copy_report,
    "folder_move": q_folder_move,
    "verify_copy": q_verify_copy,
}

_BRANCH = "['draft', 'versions.v1', 'reference', 'themes'][1 + (k // 30) % 4]"
_ONE_AREA = INV + f""",
e AS (SELECT k, kind, '{AREA}.' || {_BRANCH} || '.' || CASE WHEN k % 50 = 31 THEN 'draft.' ELSE '' END || 't' || k AS path FROM inv
  UNION ALL SELECT k, CASE WHEN k % 2 = 0 THEN 'TABLE' ELSE 'VIEW' END, '{AREA}.t' || k FROM inv WHERE k % 3 = 0)"""
_KEPT = f"""
kept AS (SELECT {ORDERS}, 'orders_f' AS name FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT {ORDERS}, 'detail.orders_o' FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT {ORDERS}, 'dear' FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000),
n AS (SELECT name, count(*) AS rows FROM kept GROUP BY name)"""

ORACLES = {
    "copy_table": f"SELECT {ORDERS} FROM orders",
    "copy_overwrite": f"SELECT {ORDERS} FROM orders",
    "move_table": f"SELECT {ORDERS} FROM orders",
    "move_view": f"SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'O'",
    "view_over_table": f"SELECT {ORDERS} FROM orders",
    "view_as_sql": """SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS spent
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "table_to_view": f"SELECT {ORDERS} FROM orders",
    "view_definitions": f"WITH {_KEPT} SELECT '{AREA}.draft.dear' AS path, rows AS source_rows, rows AS target_rows, true AS same FROM n WHERE name = 'dear'",
    "version_plan": f"""WITH {INV},
r AS (SELECT path, kind, CASE WHEN contains(path, '.reference.') THEN 'reference table: not versioned'
  WHEN kind = 'VIEW' THEN 'view: only tables are versioned' END AS reason FROM inv)
SELECT path AS source, kind, CASE WHEN reason IS NULL THEN 'archive.versions.v2' || substr(path, 8) END AS target,
  CASE WHEN reason IS NULL THEN 'copy' ELSE 'skip' END AS action, reason FROM r""",
    "create_version": f"WITH {_KEPT} SELECT * EXCLUDE (name), '{AREA}.versions.v1.' || name AS path FROM kept WHERE name <> 'dear'",
    "draft_to_version": f"""WITH {_KEPT}
SELECT '{AREA}.draft.' || name AS source, '{AREA}.versions.v1.' || name AS target, 'copied' AS status, rows FROM n
UNION ALL SELECT '{AREA}.draft.reference.orders_p', NULL, 'skipped', NULL""",
    "release_plan": f"""WITH {_ONE_AREA},
s AS (SELECT path, kind, substr(path, length('{AREA}.versions.v1.') + 1) AS rel FROM e WHERE starts_with(path, '{AREA}.versions.v1.')),
j AS (SELECT s.path, s.kind, s.rel, '{AREA}.' || s.rel AS target, t.kind AS there FROM s LEFT JOIN e t ON t.path = '{AREA}.' || s.rel)
SELECT path AS source, target, CASE WHEN kind = 'VIEW' THEN 'skip' WHEN there IS NULL THEN 'create' ELSE 'replace' END AS action,
  CASE WHEN kind = 'VIEW' THEN NULL WHEN starts_with(rel, 'draft.') THEN 'would land in the draft or the versions'
    WHEN there = 'TABLE' THEN 'a view never replaces a table' WHEN there = 'VIEW' THEN 'view already exists' END AS problem FROM j""",
    "publish_plan": f"""WITH {META},
v AS (SELECT k, '{AREA}.themes.t' || k AS view, list_contains(tags, '#public') AS tagged FROM meta WHERE (k // 30) % 4 = 3)
SELECT view, CASE WHEN tagged THEN 'public.' || view END AS target,
  CASE WHEN NOT tagged THEN 'skip' WHEN k % 5 = 0 THEN 'replace' ELSE 'create' END AS action,
  CASE WHEN k % 4 = 0 THEN 'year' ELSE 'Year' END AS "partition",
  CASE WHEN NOT tagged THEN NULL WHEN k % 5 = 0 THEN 'already exists'
    WHEN k % 4 = 0 THEN 'no field(s) to partition by: year' END AS problem FROM v""",
    "latest_release": f"WITH {_KEPT} SELECT * EXCLUDE (name), '{AREA}.' || name AS path, '#public' AS tags FROM kept",
    "release_untags": f"WITH {_KEPT} SELECT '{AREA}.versions.v1.' || name AS path, rows, 'kept' AS tags FROM n",
    "publish_tables": f"WITH {_KEPT} SELECT * EXCLUDE (name), 'public.{AREA}.' || name AS path FROM kept",
    "publish_partitioned": f"WITH {_KEPT} SELECT * EXCLUDE (name), 'public.{AREA}.' || name AS path FROM kept",
    "publish_report": f"""WITH {_KEPT}
SELECT 'public.{AREA}.' || name AS path, 'replaced' AS status, rows,
  CASE name WHEN 'detail.orders_o' THEN 'partitioned by o_orderpriority' WHEN 'orders_f' THEN 'partitioned by o_orderpriority, o_orderstatus' END AS note FROM n""",
    "folder_scan": f"""WITH {INV},
f AS (SELECT DISTINCT array_to_string(list_slice(seg, 1, i), '.') AS path
  FROM (SELECT string_split(path, '.') AS seg FROM inv) s, LATERAL (SELECT unnest(range(2, len(seg))) AS i) u),
lv AS (SELECT k, CASE WHEN k = 0 THEN 0 ELSE len(list_filter([7, 49, 343, 2401, 16807, 117649, 823543], lambda p: k % p = 0)) - 1 END AS level FROM inv WHERE kind = 'VIEW')
SELECT a.kind, a.path AS source, 'archive.y2025' || substr(a.path, 8) AS target, CAST(lv.level AS BIGINT) AS level,
  CASE WHEN a.kind = 'VIEW' THEN 'SELECT * FROM "' || replace('archive.y2025' || substr(b.path, 8), '.', '"."') || '"' END AS new_sql,
  CASE WHEN a.kind = 'VIEW' THEN b.path ELSE '' END AS "references"
FROM inv a LEFT JOIN inv b ON b.k = a.k // 7 LEFT JOIN lv ON lv.k = a.k
UNION ALL SELECT 'FOLDER', path, 'archive.y2025' || substr(path, 8), NULL, NULL, '' FROM f""",
    "folder_copy_report": f"""WITH {_KEPT},
p AS (SELECT count(*) AS rows FROM orders WHERE o_orderstatus = 'P'),
d AS (SELECT count(*) AS rows FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 250000),
r AS (
  SELECT 'FOLDER' AS kind, 'detail' AS name, 'created' AS status, CAST(NULL AS BIGINT) AS source_rows, CAST(NULL AS BIGINT) AS target_rows
  UNION ALL SELECT 'FOLDER', 'reference', 'created', NULL, NULL
  UNION ALL SELECT 'TABLE', name, 'skipped', rows, rows FROM n WHERE name = 'orders_f'
  UNION ALL SELECT 'TABLE', name, 'failed', n.rows, d.rows FROM n, d WHERE name = 'detail.orders_o'
  UNION ALL SELECT 'TABLE', 'reference.orders_p', 'copied', rows, rows FROM p
  UNION ALL SELECT 'VIEW', name, 'created', rows, rows FROM n WHERE name = 'dear')
SELECT kind, '{AREA}.draft.' || name AS source, 'catalog.trade.kept.' || name AS target, status, source_rows, target_rows FROM r""",
    "folder_move": f"""WITH {_KEPT} SELECT * EXCLUDE (name), 'archive.y2025.' || name AS path FROM kept
UNION ALL SELECT {ORDERS}, 'archive.y2025.reference.orders_p' FROM orders WHERE o_orderstatus = 'P'""",
    "verify_copy": """SELECT 'lineitem' AS path, count(*) AS source_rows, count(*) AS target_rows, true AS same FROM lineitem
UNION ALL SELECT 'orders', count(*), count(*), false FROM orders""",
}
