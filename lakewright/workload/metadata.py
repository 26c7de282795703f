"""Tag and wiki queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewright.functions import paths
from lakewright.operators import folders
from lakewright.operators import metadata as md
from lakewright.operators.writes import create_table
from lakewright.workload.ingest import new_lake
from lakewright.workload.inputs import META, metadata, read


def _flat():
    return F.array_join("tags", ",").alias("tags")


def _changes(meta):
    """Every entry gets the tag of its depth-two folder, its own brand again and #public."""
    return meta.select(
        "path", F.array(F.concat(F.lit("s"), F.col("k") % 2), F.element_at("tags", -1), F.lit("#public")).alias("tags")
    )


def q_tags_set(spark, sf):
    meta = metadata(spark, sf)
    return md.tags_set(meta, _changes(meta)).select("path", _flat())


def q_tags_add(spark, sf):
    meta = metadata(spark, sf)
    return md.tags_add(meta, _changes(meta)).select("path", _flat())


def q_tags_remove(spark, sf):
    meta = metadata(spark, sf)
    some = meta.select("path", F.when(F.col("k") % 3 == 0, F.array(F.lit("#public"))).otherwise(F.array(F.lit("none"))).alias("tags"))
    return md.tags_remove(meta, some).select("path", _flat())


def q_untaggable(spark, sf):
    meta = metadata(spark, sf)
    folders = meta.select(paths.parent(F.col("path")).alias("path")).distinct()
    held = folders.select("path", F.lit("FOLDER").alias("kind")).unionByName(meta.select("path", "kind"))
    wanted = meta.select(
        F.when(F.col("k") % 2 == 0, F.col("path")).otherwise(F.concat("path", F.lit("x"))).alias("path")
    ).unionByName(folders)
    return md.untaggable(held, wanted.withColumn("tags", F.array(F.lit("t"))))


def q_tagged_entries(spark, sf):
    return md.tagged_entries(metadata(spark, sf), "#public", "catalog").select("path", "kind")


def q_untag_below(spark, sf):
    return md.untag_below(metadata(spark, sf), "catalog", "#public").select(
        "path", _flat(), F.array_join("previous", ",").alias("previous")
    )


def q_wiki_upsert(spark, sf):
    meta = metadata(spark, sf)
    changes = meta.select(
        "path", F.when(F.col("k") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("Text of "), "k")).alias("wiki")
    ).filter(F.col("wiki").isNotNull())
    return md.wiki_upsert(meta, changes).select("path", "wiki")


def q_wiki_meta_parse(spark, sf):
    return md.wiki_meta_parse(metadata(spark, sf)).withColumn("position", F.col("position").cast("long"))


def q_wiki_meta_value(spark, sf):
    return md.wiki_meta_value(metadata(spark, sf), "owner", "tag_value")


def q_wiki_meta_render(spark, sf):
    meta = metadata(spark, sf).withColumn("kind", F.when(F.col("kind") == "VIEW", F.lit("FOLDER")).otherwise(F.col("kind")))
    entry = F.struct(F.lit("note").alias("tag_name"), F.concat(F.lit('a "b" & <c> '), "k").alias("tag_value"), F.lit("Note").alias("tag_title"))
    out = md.wiki_meta_render(meta, meta.select("path", F.array(entry).alias("entries")), overwrite=False)
    return out.select("path", "kind", "wiki")


def q_wiki_meta_roundtrip(spark, sf):
    meta = metadata(spark, sf).withColumn("kind", F.lit("FOLDER"))
    entry = F.struct(F.lit("note").alias("tag_name"), F.concat(F.lit('a "b" & <c> &quot; '), "k").alias("tag_value"), F.lit("Note").alias("tag_title"))
    out = md.wiki_meta_render(meta, meta.select("path", F.array(entry).alias("entries")))
    return md.wiki_meta_parse(out).select("path", "base", "tag_value")


def q_carry_metadata(spark, sf):
    meta = metadata(spark, sf)
    plan = meta.select(
        F.col("path").alias("source"), paths.remap(F.col("path"), "catalog", "archive.y2025").alias("target"),
        F.when(F.col("k") % 5 == 0, F.lit("FOLDER")).otherwise(F.col("kind")).alias("kind"),
    )
    return md.carry_metadata(plan, meta).select("path", "kind", _flat(), "wiki")


def _documented(spark, sf):
    """A folder per market segment with its customers; its wiki says how many there are and what they own."""
    lake, customers = new_lake(spark), read(spark, sf, "customer")
    name = F.concat(F.lit("catalog.segments."), F.lower("c_mktsegment"))
    told = customers.groupBy(name.alias("path")).agg(F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("sum"))
    # One row per segment.
    for row in customers.select("c_mktsegment", name.alias("path")).distinct().collect():
        create_table(lake, customers.filter(F.col("c_mktsegment") == row["c_mktsegment"]).select("c_custkey"), f"{row['path']}.customers")
    entry = lambda n, value, title: F.struct(F.lit(n).alias("tag_name"), value.cast("string").alias("tag_value"), F.lit(title).alias("tag_title"))
    changes = told.select("path", F.array(entry("n", F.col("n"), "Customers"), entry("sum", F.col("sum"), 'Sum of "balances" & debts')).alias("entries"))
    meta = lake.metadata("catalog.segments", folders=True).withColumn("wiki", F.when(F.col("kind") == "FOLDER", F.concat(F.lit("It's "), "path")))
    lake.store_metadata(md.wiki_meta_render(meta, changes).select(*meta.columns))
    return lake


def q_folder_wiki_roundtrip(spark, sf):
    lake = _documented(spark, sf)
    return md.wiki_meta_parse(lake.metadata("catalog.segments", folders=True)).withColumn("position", F.col("position").cast("long"))


def q_folder_move_metadata(spark, sf):
    lake = _documented(spark, sf)
    folders.folder_move(lake, "catalog.segments", "catalog.moved")
    left = lake.metadata("catalog", folders=True)
    values = md.wiki_meta_value(left, "n").select("path", F.col("tag_value").alias("n"))
    rows = left.select("path", "kind", F.substring_index("wiki", "\n", 1).alias("wiki")).join(values, "path", "left")
    return rows.filter("path <> 'catalog'")


QUERIES = {
    "folder_wiki_roundtrip": q_folder_wiki_roundtrip,
    "folder_move_metadata": q_folder_move_metadata,
    "tags_set": q_tags_set,
    "tags_add": q_tags_add,
    "tags_remove": q_tags_remove,
    "untaggable": q_untaggable,
    "tagged_entries": q_tagged_entries,
    "untag_below": q_untag_below,
    "wiki_upsert": q_wiki_upsert,
    "wiki_meta_parse": q_wiki_meta_parse,
    "wiki_meta_value": q_wiki_meta_value,
    "wiki_meta_render": q_wiki_meta_render,
    "wiki_meta_roundtrip": q_wiki_meta_roundtrip,
    "carry_metadata": q_carry_metadata,
}

_BLOCK = "chr(10) || chr(10) || '# Meta Data' || chr(10)"
_SHOWN = "chr(9) || 'Note : a \"b\" & <c> ' || k || chr(10)"
_CODED = "'<tag name=\"note\" value=\"a &quot;b&quot; &amp; &lt;c> ' || k || '\" title=\"Note\"/>' || chr(10)"
_BRAND = "tags[-1]"

ORACLES = {
    "folder_wiki_roundtrip": """WITH s AS (SELECT 'catalog.segments.' || lower(c_mktsegment) AS path, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS s FROM customer GROUP BY 1)
SELECT path, 'It''s ' || path AS base, CAST(0 AS BIGINT) AS position, 'n' AS tag_name, CAST(n AS VARCHAR) AS tag_value, 'Customers' AS tag_title FROM s
UNION ALL SELECT path, 'It''s ' || path, 1, 'sum', CAST(s AS VARCHAR), 'Sum of "balances" & debts' FROM s""",
    "folder_move_metadata": """WITH s AS (SELECT lower(c_mktsegment) AS name, count(*) AS n FROM customer GROUP BY 1)
SELECT 'catalog.moved' AS path, 'FOLDER' AS kind, 'It''s catalog.segments' AS wiki, NULL AS n
UNION ALL SELECT 'catalog.moved.' || name, 'FOLDER', 'It''s catalog.segments.' || name, CAST(n AS VARCHAR) FROM s
UNION ALL SELECT 'catalog.moved.' || name || '.customers', 'TABLE', NULL, NULL FROM s""",
    "tags_set": f"WITH {META} SELECT path, 's' || (k % 2) || ',' || {_BRAND} || ',#public' AS tags FROM meta",
    "tags_add": f"""WITH {META} SELECT path, CASE WHEN k % 11 < 6 THEN '#public,' || {_BRAND} || ',s' || (k % 2)
  ELSE {_BRAND} || ',s' || (k % 2) || ',#public' END AS tags FROM meta""",
    "tags_remove": f"""WITH {META} SELECT path, CASE WHEN k % 11 < 6 AND k % 3 <> 0 THEN '#public,' || {_BRAND} ELSE {_BRAND} END AS tags FROM meta""",
    "untaggable": f"""WITH {META}, f AS (SELECT DISTINCT regexp_replace(path, '\\.t\\d+$', '') AS path FROM meta)
SELECT path || 'x' AS path, 'does not exist' AS problem FROM meta WHERE k % 2 <> 0
UNION ALL SELECT path, 'is a folder: only tables and views have tags' FROM f""",
    "tagged_entries": f"WITH {META} SELECT path, kind FROM meta WHERE list_contains(tags, '#public')",
    "untag_below": f"""WITH {META} SELECT path, {_BRAND} AS tags, '#public,' || {_BRAND} AS previous FROM meta WHERE list_contains(tags, '#public')""",
    "wiki_upsert": f"WITH {META} SELECT path, CASE WHEN k % 4 <> 0 THEN 'Text of ' || k END AS wiki FROM meta",
    "wiki_meta_parse": f"""WITH {META}, w AS (SELECT * FROM meta WHERE k % 13 = 0)
SELECT path, 'About ' || path AS base, CAST(0 AS BIGINT) AS position, 'owner' AS tag_name,
  regexp_extract(wiki, 'Owner : (.*)', 1) AS tag_value, 'Owner' AS tag_title FROM w
UNION ALL SELECT path, 'About ' || path, 1, 'part', CAST(k AS VARCHAR), 'Part' FROM w""",
    "wiki_meta_value": f"""WITH {META} SELECT path, 'owner' AS tag_name, regexp_extract(wiki, 'Owner : (.*)', 1) AS tag_value FROM meta WHERE k % 13 = 0""",
    "wiki_meta_render": f"""WITH {META}, w AS (SELECT *, split_part(wiki, '# Meta Data', 1) AS head FROM meta)
SELECT path, CASE WHEN kind = 'VIEW' THEN 'FOLDER' ELSE kind END AS kind,
  CASE WHEN kind <> 'VIEW' THEN wiki
    WHEN k % 13 = 0 THEN replace(replace(wiki, '<meta>' || chr(10), {_SHOWN} || '<meta>' || chr(10)), '</meta>', {_CODED} || '</meta>')
    ELSE coalesce(wiki, '') || {_BLOCK} || {_SHOWN} || '<meta>' || chr(10) || {_CODED} || '</meta>' END AS wiki FROM w""",
    "wiki_meta_roundtrip": f"""WITH {META}
SELECT path, CASE WHEN k % 13 = 0 THEN 'About ' || path WHEN k % 13 = 1 THEN wiki ELSE '' END AS base,
  'a "b" & <c> &quot; ' || k AS tag_value FROM meta""",
    "carry_metadata": f"""WITH {META}
SELECT 'archive.y2025' || substr(path, 8) AS path, CASE WHEN k % 5 = 0 THEN 'FOLDER' ELSE kind END AS kind,
  CASE WHEN k % 5 = 0 THEN '' ELSE array_to_string(tags, ',') END AS tags, wiki FROM meta""",
}
