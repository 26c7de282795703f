"""What a snapshot, a release and a publication would do, as DataFrames."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Mapping, Set

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import paths
from lakewright.operators.inventory import DRAFT, REFERENCE, VERSIONS, expand_selection

PUBLIC_TAG = "#public"
# Folders whose tables are shared, hence no part of a version.
SHARED = ("reference", "references", "vocabularies", "vocabulary")


def version_plan(
    inventory: DataFrame,
    source: str,
    version_path: str,
    entries: list[str] | None = None,
    include_views: bool = False,
) -> DataFrame:
    """``(source, kind, target, action, reason)`` of a snapshot of a selection.

    Tables keep their sub-folders below ``version_path``; shared tables, and
    views unless they are to be copied as tables, are skipped with a reason.
    """
    chosen = expand_selection(inventory, source, entries)
    folders = F.transform(F.slice(paths.names(F.col("path")), F.lit(1), paths.depth(F.col("path")) - 1), F.lower)
    shared = F.get(F.sort_array(F.array_intersect(folders, F.array(*[F.lit(s) for s in SHARED]))), F.lit(0))
    reason = F.when(shared.isNotNull(), F.concat(shared, F.lit(" table: not versioned")))
    if not include_views:
        reason = reason.when(F.col("kind") == "VIEW", F.lit("view: only tables are versioned"))
    planned = chosen.withColumn("reason", reason)
    target = F.concat(F.lit(version_path + "."), paths.relative_to(F.col("path"), F.lit(source)))
    copies = F.col("reason").isNull()
    return planned.select(
        F.col("path").alias("source"),
        "kind",
        F.when(copies, target).alias("target"),
        F.when(copies, F.lit("copy")).otherwise(F.lit("skip")).alias("action"),
        "reason",
    )


def release_plan(
    inventory: DataFrame, area: str, version: str, overwrite: bool = True
) -> DataFrame:
    """``(source, target, action, problem)``: one view at the area's root per table
    of the version. ``action`` is create, replace or skip."""
    below = f"{area}.{VERSIONS}.{version}"
    found = inventory.filter(paths.is_below(F.col("path"), below)).select(
        F.col("path").alias("source"),
        F.col("kind").alias("source_kind"),
        paths.relative_to(F.col("path"), F.lit(below)).alias("relative"),
    )
    wanted = found.withColumn("target", F.concat(F.lit(area + "."), "relative"))
    taken = inventory.filter(paths.is_below(F.col("path"), area)).select(
        F.col("path").alias("target"), F.col("kind").alias("target_kind")
    )
    joined = wanted.join(taken, "target", "left")
    view = F.col("source_kind") == "VIEW"
    first = F.substring_index("relative", ".", 1)
    problem = F.when(view, F.lit(None).cast("string")).when(
        first.isin(DRAFT, VERSIONS), F.lit("would land in the draft or the versions")
    ).when(
        F.col("target_kind") == "TABLE", F.lit("a view never replaces a table")
    )
    if not overwrite:
        problem = problem.when(F.col("target_kind") == "VIEW", F.lit("view already exists"))
    action = (
        F.when(view, F.lit("skip"))
        .when(F.col("target_kind").isNotNull(), F.lit("replace"))
        .otherwise(F.lit("create"))
    )
    return joined.select("source", "target", action.alias("action"), problem.alias("problem"))


def partition_fields(value, what: str = "partition_by") -> list[str]:
    """Partition fields as an ordered list; a set, having no order, is sorted."""
    if isinstance(value, (str, bytes, Mapping)) or not isinstance(value, Collection):
        raise LakeError(f"{what} must be a list of field names, not {type(value).__name__}")
    times = Counter(f.strip() if isinstance(f, str) else "" for f in value)
    if not times or "" in times:
        raise LakeError(f"{what} must name at least one field, and only by non-blank names")
    if times.total() > len(times):
        raise LakeError(f"{what} repeats fields", sorted(f for f in times if times[f] > 1))
    return sorted(times) if isinstance(value, Set) else list(times)


def _fields_of(meta: DataFrame, area: str, partition_by) -> DataFrame:
    """``meta`` with each view's wanted partition ``fields``."""
    none = F.array().cast("array<string>")
    if not partition_by:
        return meta.withColumn("fields", none)
    if not isinstance(partition_by, dict):
        return meta.withColumn("fields", F.array(*[F.lit(f) for f in partition_fields(partition_by)]))
    rows = [
        (area + "." + view.strip().replace("/", ".").strip("."), partition_fields(fields, f"partition_by[{view!r}]"))
        for view, fields in partition_by.items()
    ]
    given = meta.sparkSession.createDataFrame(rows, "path string, fields array<string>")
    joined = meta.join(given, "path", "left")
    return joined.withColumn("fields", F.coalesce("fields", none))


def publish_plan(
    meta: DataFrame,
    columns: DataFrame,
    published: DataFrame,
    area: str,
    public_root: str,
    overwrite: bool = True,
    partition_by=None,
) -> DataFrame:
    """``(view, target, action, partition, problem)`` for an area's views.

    ``meta(path, kind, tags)`` describes the area, ``columns(path, names)`` the
    views' columns, ``published(path)`` what the public root holds. Views in
    the draft, the versions or the reference folders are no candidates; those
    without the public tag are skipped. Partition fields match ignoring case
    and come back as the view spells them.
    """
    path = F.col("path")
    internal = paths.is_below(path, f"{area}.{DRAFT}")
    for folder in (VERSIONS, *REFERENCE):
        internal = internal | paths.is_below(path, f"{area}.{folder}")
    views = meta.filter(paths.is_below(path, area) & (F.col("kind") == "VIEW") & ~internal)
    views = _fields_of(views, area, partition_by).join(columns, "path", "left")
    views = views.withColumn("target", F.concat(F.lit(public_root + "."), "path"))
    there = published.select(F.col("path").alias("target")).distinct().withColumn("there", F.lit(True))
    joined = views.join(there, "target", "left")
    names = F.coalesce("names", F.array().cast("array<string>"))

    def spelled(field: Column) -> Column:
        return F.get(F.filter(names, lambda n: F.lower(n) == F.lower(field)), F.lit(0))

    missing = F.filter("fields", lambda f: spelled(f).isNull())
    tagged = F.coalesce(F.array_contains("tags", PUBLIC_TAG), F.lit(False))
    problem = F.when(~tagged, F.lit(None).cast("string"))
    if not overwrite:
        problem = problem.when(F.col("there"), F.lit("already exists"))
    problem = problem.when(
        F.size(missing) > 0, F.concat(F.lit("no field(s) to partition by: "), F.array_join(missing, ", "))
    )
    action = (
        F.when(~tagged, F.lit("skip"))
        .when(F.col("there"), F.lit("replace"))
        .otherwise(F.lit("create"))
    )
    return joined.select(
        F.col("path").alias("view"),
        F.when(tagged, F.col("target")).alias("target"),
        action.alias("action"),
        F.transform("fields", lambda f: F.coalesce(spelled(f), f)).alias("partition"),
        problem.alias("problem"),
    )
