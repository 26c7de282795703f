"""What copying or moving a whole folder would do, as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import paths
from lakewright.functions.skew import sorted_join
from lakewright.lake import FOLDER, TABLE, VIEW
from lakewright.operators import inventory as inv
from lakewright.operators.lineage import dependency_edges, rewrite_references, view_levels


def check_folders(source: str, target: str) -> None:
    """Refuse the same folder, and one inside the other."""
    a = [n.lower() for n in source.split(".") if n]
    b = [n.lower() for n in target.split(".") if n]
    if not a or not b:
        raise LakeError("both a source and a target path are needed")
    if a == b:
        raise LakeError(f"source and target are the same folder: {source!r}")
    if b[: len(a)] == a:
        raise LakeError(f"target {target!r} is inside source {source!r}")
    if a[: len(b)] == b:
        raise LakeError(f"source {source!r} is inside target {target!r}")


def folder_scan(
    inventory: DataFrame,
    views: DataFrame,
    source: str,
    target: str,
    folders: DataFrame | None = None,
) -> DataFrame:
    """``(kind, source, target, level, new_sql, references, notes)`` of all below ``source``.

    ``inventory(path, kind)`` is the whole catalog, ``views(path, sql, context)``
    the definitions; ``folders(path)`` may add empty folders. Views come with
    their SQL pointing at the target and the level they can be built at.
    """
    check_folders(source, target)
    inside = inventory.filter(paths.is_below(F.col("path"), source)).select("path", "kind")
    if inside.isEmpty() and (folders is None or folders.filter(paths.is_below(F.col("path"), source)).isEmpty()):
        raise LakeError(f"nothing to read below {source!r}")
    held = inv.folders(inside, source).select("path")
    if folders is not None:
        held = held.unionByName(folders.filter(paths.is_below(F.col("path"), source)).select("path")).distinct()
    every = inside.unionByName(held.select("path", F.lit(FOLDER).alias("kind")))
    moved = every.select("path", "kind", paths.remap(F.col("path"), source, target).alias("target"))
    outside = inventory.filter(~paths.is_inside(F.col("path"), F.lit(source))).select("path")
    texts = views.filter(paths.is_below(F.col("path"), source))
    rewritten = rewrite_references(
        texts, moved.select("path", "target"), source, target, outside=outside
    )
    levels = view_levels(rewritten.select("path"), dependency_edges(rewritten))
    known = sorted_join(rewritten.select("path", "new_sql", "references", "notes"), levels, "path", "left")
    joined = sorted_join(moved, known, "path", "left")
    unread = (F.col("kind") == VIEW) & F.col("new_sql").isNull()
    nothing = F.array().cast("array<string>")
    return joined.select(
        "kind",
        F.col("path").alias("source"),
        "target",
        F.when(F.col("kind") == TABLE, F.lit(None).cast("int")).otherwise(F.col("level")).alias("level"),
        "new_sql",
        F.coalesce("references", nothing).alias("references"),
        F.when(unread, F.array(F.lit("the definition cannot be read")))
        .otherwise(F.coalesce("notes", nothing)).alias("notes"),
    )
