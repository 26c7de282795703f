"""Inputs the queries share, derived from the given tables in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog entry per part, in 30 areas with four branches each."""
    k = F.col("p_partkey")
    branch = F.element_at(
        F.array(*[F.lit(b) for b in ("draft", "versions.v1", "reference", "themes")]),
        (F.floor(k / 30) % 4 + 1).cast("int"),
    )
    path = F.concat(
        F.lit("catalog.d"), k % 3, F.lit(".s"), k % 2, F.lit(".a"), k % 5,
        F.lit("."), branch, F.lit(".t"), k,
    )
    return read(spark, sf_dir, "part").select(
        path.alias("path"),
        F.when(k % 7 == 0, F.lit("VIEW")).otherwise(F.lit("TABLE")).alias("kind"),
        k.alias("k"),
        "p_brand",
    )


INV = """
inv AS (
  SELECT p_partkey AS k, p_brand,
    'catalog.d' || (p_partkey % 3) || '.s' || (p_partkey % 2) || '.a' || (p_partkey % 5) || '.' ||
    (CASE (p_partkey // 30) % 4 WHEN 0 THEN 'draft' WHEN 1 THEN 'versions.v1'
       WHEN 2 THEN 'reference' ELSE 'themes' END) || '.t' || p_partkey AS path,
    CASE WHEN p_partkey % 7 = 0 THEN 'VIEW' ELSE 'TABLE' END AS kind
  FROM part)"""

# Every ancestor of every entry, as (path, depth).
FOLDERS = INV + """,
folders AS (
  SELECT DISTINCT array_to_string(list_slice(seg, 1, i), '.') AS path, i AS depth
  FROM (SELECT string_split(path, '.') AS seg FROM inv) s,
       LATERAL (SELECT unnest(range(1, len(seg))) AS i) u)"""


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory with tags, and a wiki holding a metadata block on every 13th."""
    block = F.concat(
        F.lit("About "), F.col("path"),
        F.lit('\n\n# Meta Data\n\tOwner : '), F.col("p_brand"),
        F.lit('\n\tPart : '), F.col("k").cast("string"),
        F.lit('\n<meta>\n<tag name="owner" value="'), F.col("p_brand"),
        F.lit('" title="Owner"/>\n<tag name="part" value="'), F.col("k").cast("string"),
        F.lit('" title="Part"/>\n</meta>'),
    )
    plain = F.lower(F.col("p_brand"))
    return inventory(spark, sf_dir).select(
        "path", "kind", "k",
        F.when(F.col("k") % 11 < 6, F.array(F.lit("#public"), plain)).otherwise(F.array(plain)).alias("tags"),
        F.when(F.col("k") % 13 == 0, block).when(F.col("k") % 13 == 1, F.concat(F.lit("Note on "), F.col("path"))).alias("wiki"),
    )


META = INV + """,
meta AS (
  SELECT path, kind, k,
    CASE WHEN k % 11 < 6 THEN ['#public', lower(p_brand)] ELSE [lower(p_brand)] END AS tags,
    CASE WHEN k % 13 = 0 THEN 'About ' || path || chr(10) || chr(10) || '# Meta Data' || chr(10) ||
           chr(9) || 'Owner : ' || p_brand || chr(10) || chr(9) || 'Part : ' || k || chr(10) ||
           '<meta>' || chr(10) || '<tag name="owner" value="' || p_brand || '" title="Owner"/>' || chr(10) ||
           '<tag name="part" value="' || k || '" title="Part"/>' || chr(10) || '</meta>'
         WHEN k % 13 = 1 THEN 'Note on ' || path END AS wiki
  FROM inv)"""
