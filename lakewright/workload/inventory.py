"""Inventory and file-listing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewright.functions import paths
from lakewright.operators import inventory as inv
from lakewright.operators import listing
from lakewright.workload.inputs import FOLDERS, INV, inventory, read

AREA = "catalog.d0.s0.a0"
SELECTION = ["draft", "versions.v1.t30", "catalog.d0.s0.a0.themes", "draft.t0"]
WANTED_LAYERS = ["draft/t0", "t1234", "catalog.d1.s1.a1.themes.t91", "versions.v1.t1234"]


def q_entries_under(spark, sf):
    return inv.entries_under(inventory(spark, sf).select("path", "kind"), "catalog.d1")


def q_list_datasets(spark, sf):
    return inv.list_datasets(inventory(spark, sf), AREA)


def q_folder_tree(spark, sf):
    return inv.folders(inventory(spark, sf), "catalog").select(
        "path", F.col("depth").cast("long").alias("depth")
    )


def q_entry_kinds(spark, sf):
    wanted = inventory(spark, sf).select(
        F.when(F.col("k") % 10 == 3, F.concat("path", F.lit("x"))).otherwise(F.col("path")).alias("path")
    )
    return inv.entry_kinds(inventory(spark, sf), wanted)


def q_table_info(spark, sf):
    frames = {n: read(spark, sf, n) for n in ("orders", "lineitem", "events", "documents")}
    return inv.table_info(frames).select(
        "path", F.col("ordinal").cast("long").alias("ordinal"), F.col("column").alias("name"), "rows"
    )


def q_expand_selection(spark, sf):
    return inv.expand_selection(inventory(spark, sf), AREA, SELECTION).select(
        "path", "kind", F.col("position").cast("long").alias("position")
    )


def q_missing_selection(spark, sf):
    # Every entry asked for by a name that exists, as a folder, or not at all.
    source = inventory(spark, sf)
    k = F.col("k")
    full = (
        F.when(k % 4 == 0, F.col("path"))
        .when(k % 4 == 1, paths.parent(F.col("path")))
        .otherwise(F.concat("path", F.lit(".none")))
    )
    wanted = source.select(
        F.concat(F.lit("w"), k).alias("wanted"), full.alias("full"), k.cast("int").alias("position")
    )
    return inv.selection_matches(source, wanted, "catalog")[1]


def q_select_layers(spark, sf):
    # The longest run of names each entry may be asked by, over the whole inventory.
    return inv.select_layers(inventory(spark, sf), "catalog", [
        "draft/t0", "t64", "catalog.d1.s1.a1.themes.t91", "versions.v1.t34"
    ])


def q_layer_names(spark, sf):
    k = F.col("k")
    prefix = F.element_at(F.array(F.lit("t"), F.lit("gpkg_t"), F.lit("RTREE_")), (k % 3 + 1).cast("int"))
    clashing = inventory(spark, sf).select(
        F.concat(paths.parent(F.col("path")), F.lit("."), prefix, F.floor(k / 2).cast("string")).alias("path")
    )
    return inv.layer_names(clashing, "catalog")


def q_path_forms(spark, sf):
    forms = inv.path_forms(
        inventory(spark, sf).select(
            "k",
            F.when(F.col("k") % 3 == 0, F.replace("path", F.lit("."), F.lit("/")))
            .when(F.col("k") % 3 == 1, F.concat("path", F.lit('."v1.'), "k", F.lit('"')))
            .otherwise(F.concat("path", F.lit('."say ""'), "k", F.lit('"""')))
            .alias("path"),
        )
    )
    return forms.select(
        "path", "storage", "catalog", "leaf", F.col("depth").cast("long").alias("depth"),
        F.array_join("segments", "|").alias("segments"),
    )


def q_remap_paths(spark, sf):
    return inv.remap_paths(inventory(spark, sf), "catalog.D1.s1", "archive.y2025.d1")


def q_area_folders(spark, sf):
    return inv.area_folders(inventory(spark, sf), need_reference=True).select("area")


def q_path_plan(spark, sf):
    k = F.col("k")
    wanted = inventory(spark, sf).select(
        F.concat(
            F.lit("catalog.d"), k % 4, F.lit(".s"), k % 3, F.lit(".a"), k % 7,
            F.lit(".draft.f"), k % 50,
        ).alias("path")
    )
    return inv.path_plan(inventory(spark, sf), wanted).select(
        "path", F.col("depth").cast("long").alias("depth"), "action"
    )


def q_copy_targets(spark, sf):
    source = inventory(spark, sf)
    k = F.col("k")
    asked = source.select(
        F.col("path").alias("source"),
        F.when(k % 3 == 0, paths.parent(F.col("path")))
        .when(k % 3 == 1, F.concat(F.lit("backup.b"), k % 9, F.lit("/")))
        .otherwise(F.concat(F.lit("backup.c"), k)).alias("target"),
    )
    return inv.copy_targets(asked, inv.folders(source))


def _urls(spark, sf):
    return read(spark, sf, "pages").select("page_id", F.col("url").alias("name"))


def q_match_names(spark, sf):
    return listing.match_names(_urls(spark, sf), ["*/EN/*", "[45]*", ".org/de/1", "ref=x"])


def q_invalid_file_names(spark, sf):
    tail = F.regexp_replace(F.col("name"), "^https?://", "")
    return listing.invalid_file_names(_urls(spark, sf).withColumn("name", tail), relative=True)


def _renames(spark, sf):
    orders = read(spark, sf, "orders")
    name = F.concat(F.lit("order_"), F.col("o_orderkey"), F.lit(".csv"))
    files = orders.select(name.alias("name"))
    # A third of the files is renamed to their customer's file (many clash); the
    # other new names are blank, and some renames name no file.
    k = F.col("o_orderkey")
    given = orders.select(
        F.when(k % 15 == 0, F.concat(F.lit("lost_"), k)).otherwise(name).alias("name"),
        F.when(k % 3 != 0, F.lit(" ")).otherwise(F.concat(F.lit("cust_"), F.col("o_custkey"), F.lit(".csv"))).alias("new_name"),
    )
    return files, given


def q_rename_plan(spark, sf):
    return listing.rename_plan(*_renames(spark, sf))


def q_unknown_renames(spark, sf):
    files, given = _renames(spark, sf)
    return listing.unknown_renames(files, given).select("name")


def q_name_clashes(spark, sf):
    return listing.name_clashes(listing.rename_plan(*_renames(spark, sf)))


def q_already_there(spark, sf):
    files = read(spark, sf, "lineitem").select(
        F.concat(F.lit("docs/"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber")).alias("path"), "l_partkey"
    )
    taken = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("docs/"), F.col("o_orderkey"), F.lit("_1")).alias("path")
    )
    return listing.already_there(files, taken)


_RENAMES = """
files AS (SELECT 'order_' || o_orderkey || '.csv' AS name FROM orders),
given AS (SELECT CASE WHEN o_orderkey % 15 = 0 THEN 'lost_' || o_orderkey ELSE 'order_' || o_orderkey || '.csv' END AS name,
    CASE WHEN o_orderkey % 3 <> 0 THEN '' ELSE 'cust_' || o_custkey || '.csv' END AS new_name
  FROM orders),
plan AS (SELECT f.name, CASE WHEN coalesce(g.new_name, '') = '' THEN f.name ELSE g.new_name END AS new_name
  FROM files f LEFT JOIN given g ON f.name = g.name)"""

_CLASHING = INV + """,
named AS (SELECT left(path, length(path) - length(leaf) - 1) || '.' ||
    (CASE k % 3 WHEN 0 THEN 't' WHEN 1 THEN 'gpkg_t' ELSE 'RTREE_' END) || (k // 2) AS path,
    (CASE k % 3 WHEN 0 THEN 't' WHEN 1 THEN 'gpkg_t' ELSE 'RTREE_' END) || (k // 2) AS leaf
  FROM (SELECT *, string_split(path, '.')[-1] AS leaf FROM inv))"""

QUERIES = {
    "entries_under": q_entries_under,
    "list_datasets": q_list_datasets,
    "folder_tree": q_folder_tree,
    "entry_kinds": q_entry_kinds,
    "table_info": q_table_info,
    "expand_selection": q_expand_selection,
    "missing_selection": q_missing_selection,
    "select_layers": q_select_layers,
    "layer_names": q_layer_names,
    "path_forms": q_path_forms,
    "remap_paths": q_remap_paths,
    "area_folders": q_area_folders,
    "path_plan": q_path_plan,
    "copy_targets": q_copy_targets,
    "match_names": q_match_names,
    "invalid_file_names": q_invalid_file_names,
    "rename_plan": q_rename_plan,
    "unknown_renames": q_unknown_renames,
    "name_clashes": q_name_clashes,
    "already_there": q_already_there,
}

ORACLES = {
    "entries_under": f"WITH {INV} SELECT path, kind FROM inv WHERE starts_with(path, 'catalog.d1.')",
    "list_datasets": f"WITH {INV} SELECT kind AS type, path AS name FROM inv WHERE starts_with(path, '{AREA}.')",
    "folder_tree": f"WITH {FOLDERS} SELECT path, depth FROM folders WHERE starts_with(path, 'catalog.')",
    "entry_kinds": f"""WITH {INV},
w AS (SELECT CASE WHEN k % 10 = 3 THEN path || 'x' ELSE path END AS path FROM inv)
SELECT w.path, inv.kind FROM w LEFT JOIN inv ON w.path = inv.path""",
    "table_info": " UNION ALL ".join(
        f"""
SELECT '{t}' AS path, row_number() OVER () AS ordinal, column_name AS name, (SELECT count(*) FROM {t}) AS rows
FROM (DESCRIBE SELECT * FROM {t})"""
        for t in ("orders", "lineitem", "events", "documents")
    ),
    "expand_selection": f"""WITH {INV},
m AS (
  SELECT path, kind, 0 AS position FROM inv WHERE starts_with(path, '{AREA}.draft.')
  UNION ALL SELECT path, kind, 1 FROM inv WHERE path = '{AREA}.versions.v1.t30'
  UNION ALL SELECT path, kind, 2 FROM inv WHERE starts_with(path, '{AREA}.themes.')
  UNION ALL SELECT path, kind, 3 FROM inv WHERE path = '{AREA}.draft.t0')
SELECT path, kind, CAST(min(position) AS BIGINT) AS position FROM m GROUP BY ALL""",
    "missing_selection": f"WITH {INV} SELECT 'w' || k AS wanted, path || '.none' AS \"full\" FROM inv WHERE k % 4 > 1",
    "select_layers": f"""WITH {INV}
SELECT DISTINCT path, kind FROM inv, (VALUES ('draft.t0'), ('t64'), ('catalog.d1.s1.a1.themes.t91'), ('versions.v1.t34')) w(n)
WHERE path = n OR ends_with(path, '.' || n)""",
    "layer_names": f"""WITH {_CLASHING},
c AS (SELECT *, count(*) OVER (PARTITION BY leaf) AS n FROM named),
l AS (SELECT path, CASE WHEN n > 1 THEN replace(substr(path, 9), '.', '_') ELSE leaf END AS layer FROM c)
SELECT path, CASE WHEN regexp_matches(lower(layer), '^(gpkg_|rtree_|sqlite_)') THEN 't_' || layer ELSE layer END AS layer FROM l""",
    "path_forms": f"""WITH {INV},
f AS (SELECT k, path AS plain,
    CASE k % 3 WHEN 0 THEN [] WHEN 1 THEN ['v1.' || k] ELSE ['say "' || k || '"'] END AS extra,
    CASE k % 3 WHEN 0 THEN replace(path, '.', '/') WHEN 1 THEN path || '."v1.' || k || '"'
      ELSE path || '."say ""' || k || '""' || '"' END AS path FROM inv),
s AS (SELECT *, list_concat(string_split(plain, '.'), extra) AS seg FROM f)
SELECT path, array_to_string(seg, '/') AS storage,
  CASE WHEN k % 3 = 0 THEN plain ELSE path END AS catalog,
  seg[-1] AS leaf, len(seg) AS depth, array_to_string(seg, '|') AS segments FROM s""",
    "remap_paths": f"""WITH {INV}
SELECT path, kind, 'archive.y2025.d1' || substr(path, 14) AS target FROM inv WHERE starts_with(path, 'catalog.d1.s1.')""",
    "area_folders": f"""WITH {FOLDERS},
p AS (SELECT path, string_split(path, '.')[-1] AS leaf FROM folders)
SELECT area FROM (SELECT left(path, length(path) - length(leaf) - 1) AS area, leaf FROM p WHERE path <> leaf)
GROUP BY area HAVING bool_or(leaf = 'draft') AND bool_or(leaf = 'versions') AND bool_or(leaf IN ('reference', 'references'))""",
    "path_plan": f"""WITH {FOLDERS},
w AS (SELECT string_split('catalog.d' || (k % 4) || '.s' || (k % 3) || '.a' || (k % 7) || '.draft.f' || (k % 50), '.') AS seg FROM inv),
l AS (SELECT DISTINCT array_to_string(list_slice(seg, 1, i), '.') AS path, i - 1 AS depth
  FROM w, LATERAL (SELECT unnest(range(1, len(seg) + 1)) AS i) u)
SELECT l.path, CAST(l.depth AS BIGINT) AS depth, CASE WHEN f.path IS NOT NULL THEN 'exists' WHEN l.depth < 3 THEN 'missing' ELSE 'would create' END AS action
FROM l LEFT JOIN folders f ON l.path = f.path""",
    "copy_targets": f"""WITH {INV},
r AS (SELECT k, path AS source, string_split(path, '.')[-1] AS leaf FROM inv)
SELECT source,
  CASE k % 3 WHEN 0 THEN left(source, length(source) - length(leaf) - 1) WHEN 1 THEN 'backup.b' || (k % 9) || '/' ELSE 'backup.c' || k END AS target,
  CASE k % 3 WHEN 0 THEN source WHEN 1 THEN 'backup.b' || (k % 9) || '.' || leaf ELSE 'backup.c' || k END AS copy_path FROM r""",
    "match_names": r"""
SELECT page_id, url AS name FROM pages
WHERE lower(url) GLOB '*/en/*' OR regexp_matches(lower(url), '^[45]') OR regexp_matches(lower(url), '/[45][^/]*$')
  OR ends_with(string_split(lower(url), '/')[-1], '.org/de/1') OR contains(lower(url), 'ref=x')""",
    "invalid_file_names": r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS name FROM pages),
r AS (SELECT *, trim(name, '/') AS clean FROM p),
s AS (SELECT page_id, name, unnest(string_split(clean, '/')) AS part, generate_subscripts(string_split(clean, '/'), 1) AS i FROM r),
b AS (SELECT page_id, name, i, CASE WHEN trim(part) = '' THEN 'empty' WHEN contains(part, chr(92)) OR trim(part) IN ('.', '..') THEN 'path'
   WHEN regexp_matches(part, '[<>:"|?*\x00-\x1f\x7f]') THEN 'character' END AS problem FROM s)
SELECT page_id, name, arg_min(problem, i) AS problem FROM b WHERE problem IS NOT NULL GROUP BY page_id, name""",
    "rename_plan": f"WITH {_RENAMES} SELECT name, new_name FROM plan",
    "unknown_renames": f"WITH {_RENAMES} SELECT name FROM given WHERE name NOT IN (SELECT name FROM files)",
    "name_clashes": f"WITH {_RENAMES} SELECT new_name, count(*) AS files FROM plan GROUP BY new_name HAVING count(*) > 1",
    "already_there": """
SELECT 'docs/' || l_orderkey || '_' || l_linenumber AS path, l_partkey FROM lineitem
WHERE l_linenumber = 1 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
}
