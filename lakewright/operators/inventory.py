"""Questions about a catalog's entries, asked of an inventory ``(path, kind)``.

Prefix and suffix lookups are equi-joins on the exploded prefixes or suffixes
of a path (at most its depth), never comparisons of all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import paths
from lakewright.functions.skew import salted_join

DRAFT, VERSIONS = "draft", "versions"
# The folder names taken as shared reference data.
REFERENCE = ("reference", "references")
# Layer name prefixes the export keeps for itself.
RESERVED_PREFIXES = ("gpkg_", "rtree_", "sqlite_")
# Levels above this depth (source, domain, subdomain) are never created.
TAXONOMY_DEPTH = 3


def entries_under(inventory: DataFrame, folder: str) -> DataFrame:
    """Tables and views at any depth below ``folder``, in path order."""
    return inventory.filter(paths.is_below(F.col("path"), folder)).orderBy("path")


def list_datasets(inventory: DataFrame, path: str) -> DataFrame:
    """``(type, name)`` of the dataset at ``path`` and of all below it."""
    found = inventory.filter((F.col("path") == path) | paths.is_below(F.col("path"), path))
    if found.isEmpty():
        raise LakeError(f"{path!r} does not exist")
    return found.select(F.col("kind").alias("type"), F.col("path").alias("name")).orderBy("name")


def folders(inventory: DataFrame, root: str | None = None, recursive: bool = True) -> DataFrame:
    """Every folder that holds an entry, below ``root``; parents first."""
    holders = inventory.select(paths.parent(F.col("path")).alias("holder")).distinct()
    found = holders.select(F.explode(paths.prefixes(F.col("holder"))).alias("path")).distinct()
    if root is not None:
        found = found.filter(paths.is_below(F.col("path"), root))
    found = found.withColumn("depth", paths.depth(F.col("path")))
    if not recursive:
        top = 1 if root is None else len(root.split(".")) + 1
        found = found.filter(F.col("depth") == top)
    return found.orderBy("depth", "path")


def entry_kinds(inventory: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(path)`` with each path's kind, null where there is no such entry."""
    return wanted.join(inventory.select("path", "kind"), "path", "left")


def entry_kind(inventory: DataFrame, path: str) -> str:
    row = inventory.filter(F.col("path") == path).select("kind").first()
    if row is None:
        raise LakeError(f"{path!r} does not exist")
    return row["kind"]


def table_info(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table and column: ordinal, name, Spark type and the row count.

    Each table costs one count, which Parquet answers from its footers.
    """
    parts = []
    for path, df in frames.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("ordinal"),
                    F.lit(f.name).alias("column"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                )
                for i, f in enumerate(df.schema.fields, start=1)
            ]
        )
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.select(F.lit(path).alias("path"), F.inline(columns), "rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _wanted(inventory: DataFrame, source: str, entries: list[str]) -> DataFrame:
    """The selection as ``(wanted, full, position)``; a repeated entry is refused."""
    cleaned = [e.strip() for e in entries]
    if any(not e.strip(" .") for e in cleaned):
        raise LakeError("every entry must be a non-empty name")
    repeated = sorted({e for e in cleaned if cleaned.count(e) > 1})
    if repeated:
        raise LakeError("entries listed more than once", repeated)
    rows = []
    for position, entry in enumerate(cleaned):
        relative = entry[len(source) + 1 :] if entry.startswith(source + ".") else entry.lstrip(".")
        rows.append((relative, f"{source}.{relative}", position))
    return inventory.sparkSession.createDataFrame(rows, "wanted string, full string, position int")


def selection_matches(
    inventory: DataFrame, wanted: DataFrame, source: str
) -> tuple[DataFrame, DataFrame]:
    """``(matches, missing)`` of a selection frame ``(wanted, full, position)``.

    A wanted path that is an entry stands for itself, any other for every entry
    below it. Either side may be large: both lookups are equi-joins, and the
    folder lookup is salted because one folder may hold most of the catalog.
    """
    inside = inventory.filter(paths.is_below(F.col("path"), source))
    exact = inside.join(wanted, F.col("path") == F.col("full")).select("path", "kind", "position")
    as_folder = wanted.join(inside.select(F.col("path").alias("full")), "full", "left_anti")
    above = inside.withColumn("full", F.explode(paths.ancestors(F.col("path"))))
    below = salted_join(above, as_folder.select("full", "position"), ["full"], spread_by=["path"])
    matches = (
        exact.unionByName(below.select("path", "kind", "position"))
        .groupBy("path", "kind")
        .agg(F.min("position").alias("position"))
    )
    holders = inside.select(paths.parent(F.col("path")).alias("holder")).distinct()
    held = holders.select(F.explode(paths.prefixes(F.col("holder"))).alias("full")).distinct()
    missing = as_folder.join(held, "full", "left_anti").select("wanted", "full")
    return matches, missing


def missing_selection(inventory: DataFrame, source: str, entries: list[str]) -> DataFrame:
    """Every listed entry that is neither an entry nor a folder with entries."""
    return selection_matches(inventory, _wanted(inventory, source, entries), source)[1]


def expand_selection(
    inventory: DataFrame, source: str, entries: list[str] | None = None
) -> DataFrame:
    """``(path, kind, position)`` of the entries a selection stands for.

    No entries means all below ``source``. All missing names are reported at
    once; an entry reached twice counts once, at its first position.
    """
    if not entries:
        found = inventory.filter(paths.is_below(F.col("path"), source))
        if found.isEmpty():
            raise LakeError(f"nothing to copy: {source!r} has no tables")
        return found.select("path", "kind", F.lit(0).alias("position")).orderBy("path")
    matches, missing = selection_matches(inventory, _wanted(inventory, source, entries), source)
    # At most one row per name the caller listed.
    absent = [r["wanted"] for r in missing.collect()]
    if absent:
        raise LakeError(f"no table or folder with tables under {source!r}", sorted(absent))
    return matches.orderBy("position", "path")


def _suffixes(path: Column) -> Column:
    seg = paths.names(path)
    return F.transform(
        F.sequence(F.lit(1), F.size(seg)),
        lambda i: F.array_join(F.slice(seg, i, F.size(seg)), "."),
    )


def select_layers(inventory: DataFrame, root: str, names: list[str] | None = None) -> DataFrame:
    """The entries ``names`` stand for, each given in full, below ``root`` or as
    the end of a path (``/`` or ``.``); in listing order."""
    available = inventory.filter((F.col("path") == root) | paths.is_below(F.col("path"), root))
    if not names:
        if available.isEmpty():
            raise LakeError(f"there are no tables or views under {root}")
        return available.select("path", "kind").orderBy("path")
    cleaned = list(dict.fromkeys(n.strip().replace("/", ".") for n in names))
    wanted = inventory.sparkSession.createDataFrame([(n,) for n in cleaned], "suffix string")
    ends = available.select("path", "kind", F.explode(_suffixes(F.col("path"))).alias("suffix"))
    # The few names go to the rows: their frame, without a known size, would not be the one broadcast.
    hits = ends.join(F.broadcast(wanted), "suffix")
    found = {r["suffix"] for r in hits.select("suffix").distinct().collect()}
    absent = [n for n in cleaned if n not in found]
    if absent:
        raise LakeError(f"no table or view under {root}", absent)
    return hits.select("path", "kind").distinct().orderBy("path")


def layer_names(inventory: DataFrame, root: str) -> DataFrame:
    """``(path, layer)``: the leaf, or the joined path below ``root`` on a clash.

    Clashing leaves come from a pre-aggregated count and are joined back with
    a salt, so a leaf shared by much of the catalog needs no single window.
    """
    named = inventory.select("path", paths.leaf(F.col("path")).alias("leaf"))
    clashing = (
        named.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("leaf", F.lit(True).alias("clashes"))
    )
    joined = salted_join(named, clashing, ["leaf"], "left", ["path"])
    relative = paths.relative_to(F.col("path"), F.lit(root))
    name = F.when(F.col("clashes"), F.replace(relative, F.lit("."), F.lit("_"))).otherwise(F.col("leaf"))
    reserved = F.lower(name).rlike("^(" + "|".join(RESERVED_PREFIXES) + ")")
    return joined.select("path", F.when(reserved, F.concat(F.lit("t_"), name)).otherwise(name).alias("layer"))


def area_folders(inventory: DataFrame, need_reference: bool = False) -> DataFrame:
    """Folders with ``draft`` and ``versions`` directly below (and, to publish,
    a reference folder), found with three flags per parent."""
    below = folders(inventory).select(
        paths.parent(F.col("path")).alias("area"), paths.leaf(F.col("path")).alias("leaf")
    )
    flags = below.filter(F.col("area").isNotNull()).groupBy("area").agg(
        F.max(F.col("leaf") == DRAFT).alias("has_draft"),
        F.max(F.col("leaf") == VERSIONS).alias("has_versions"),
        F.max(F.col("leaf").isin(*REFERENCE)).alias("has_reference"),
    )
    keep = F.col("has_draft") & F.col("has_versions")
    return flags.filter(keep & F.col("has_reference") if need_reference else keep)


def path_plan(inventory: DataFrame, wanted: DataFrame, dry_run: bool = True) -> DataFrame:
    """``(path, depth, action)`` per level of every ``wanted(path)``.

    A missing level above the taxonomy depth is ``missing``: a question to
    raise, never a folder to make.
    """
    levels = (
        wanted.select(F.explode(paths.prefixes(F.col("path"))).alias("path")).distinct()
        .withColumn("depth", paths.depth(F.col("path")) - 1)
    )
    there = folders(inventory).select("path", F.lit(True).alias("there"))
    return levels.join(there, "path", "left").select(
        "path",
        "depth",
        F.when(F.col("there"), F.lit("exists"))
        .when(F.col("depth") < TAXONOMY_DEPTH, F.lit("missing"))
        .otherwise(F.lit("would create" if dry_run else "created"))
        .alias("action"),
    )


def copy_targets(requests: DataFrame, folder_paths: DataFrame) -> DataFrame:
    """``requests(source, target)`` with the path each copy really gets: a target
    that is a folder, or ends in ``/``, receives the source's own name."""
    plain = F.regexp_replace(F.col("target"), "/+$", "")
    asked = requests.withColumn("slashed", F.col("target").endswith("/")).withColumn("path", plain)
    there = folder_paths.select("path").distinct().withColumn("is_folder", F.lit(True))
    joined = salted_join(asked, there, ["path"], "left", ["source"])
    into = F.col("slashed") | F.coalesce(F.col("is_folder"), F.lit(False))
    return joined.select(
        "source",
        "target",
        F.when(into, F.concat_ws(".", F.col("path"), paths.leaf(F.col("source"))))
        .otherwise(F.col("path")).alias("copy_path"),
    )


def path_forms(listing: DataFrame) -> DataFrame:
    """Each ``path``, in either form, with its segments and both written forms."""
    seg = paths.segments(F.col("path"))
    return listing.select(
        "path",
        seg.alias("segments"),
        paths.to_storage(F.col("path")).alias("storage"),
        paths.to_catalog(F.col("path")).alias("catalog"),
        F.size(seg).alias("depth"),
        F.element_at(seg, -1).alias("leaf"),
    )


def remap_paths(inventory: DataFrame, source: str, target: str) -> DataFrame:
    """``(path, kind, target)`` of every entry at or below ``source``."""
    inside = inventory.filter(paths.is_inside(F.col("path"), F.lit(source)))
    return inside.select("path", "kind", paths.remap(F.col("path"), source, target).alias("target"))
