"""Tags and wikis as a frame ``(path, kind, tags, wiki)``.

``path`` is unique in every frame here, so the joins on it are even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import paths, wiki
from lakewright.lake import FOLDER


def _changed(meta: DataFrame, changes: DataFrame, columns: dict) -> DataFrame:
    """``meta`` with ``columns`` computed where ``changes`` has the path."""
    given = changes.withColumn("__given", F.lit(True))
    joined = meta.join(given, "path", "left")
    kept = {
        c: F.when(F.col("__given"), columns[c]).otherwise(F.col(c)) if c in columns else F.col(c)
        for c in meta.columns
    }
    return joined.select(*[v.alias(c) for c, v in kept.items()])


def untaggable(meta: DataFrame, changes: DataFrame) -> DataFrame:
    """``(path, problem)`` of the changes that name a folder or nothing at all."""
    kinds = meta.select("path", "kind")
    problem = F.when(F.col("kind").isNull(), F.lit("does not exist")).when(
        F.col("kind") == FOLDER, F.lit("is a folder: only tables and views have tags")
    )
    joined = changes.select("path").join(kinds, "path", "left")
    return joined.select("path", problem.alias("problem")).filter(F.col("problem").isNotNull())


def _require_taggable(meta: DataFrame, changes: DataFrame) -> None:
    wrong = untaggable(meta, changes)
    first = wrong.first()
    if first is not None:
        raise LakeError(f"{first['path']!r} {first['problem']}")


def _renamed(changes: DataFrame) -> DataFrame:
    return changes.select("path", F.col("tags").alias("__tags"))


def tags_set(meta: DataFrame, changes: DataFrame, check: bool = True) -> DataFrame:
    """Replace the tags of the paths in ``changes(path, tags)``."""
    if check:
        _require_taggable(meta, changes)
    return _changed(meta, _renamed(changes), {"tags": F.array_distinct("__tags")})


def tags_add(meta: DataFrame, changes: DataFrame, check: bool = True) -> DataFrame:
    """Add tags behind the ones that are there; none twice."""
    if check:
        _require_taggable(meta, changes)
    have = F.coalesce("tags", F.array().cast("array<string>"))
    return _changed(meta, _renamed(changes), {"tags": F.array_union(have, F.col("__tags"))})


def tags_remove(meta: DataFrame, changes: DataFrame, check: bool = True) -> DataFrame:
    """Take tags away; the others keep their order."""
    if check:
        _require_taggable(meta, changes)
    left = F.filter("tags", lambda t: ~F.array_contains(F.col("__tags"), t))
    return _changed(meta, _renamed(changes), {"tags": left})


def tagged_entries(meta: DataFrame, tag: str, folder: str | None = None) -> DataFrame:
    """The entries carrying ``tag``, below ``folder`` if given."""
    found = meta.filter(F.array_contains("tags", tag))
    return found if folder is None else found.filter(paths.is_below(F.col("path"), folder))


def untag_below(meta: DataFrame, folder: str, tag: str) -> DataFrame:
    """``(path, tags, previous)`` of the entries below ``folder`` that lose ``tag``;
    ``previous`` is what an undo puts back."""
    return tagged_entries(meta, tag, folder).select(
        "path", F.array_remove("tags", tag).alias("tags"), F.col("tags").alias("previous")
    )


def wiki_upsert(meta: DataFrame, changes: DataFrame) -> DataFrame:
    """Set the wiki of the paths in ``changes(path, wiki)``; "" deletes it."""
    given = changes.select("path", F.col("wiki").alias("__wiki"))
    return _changed(meta, given, {"wiki": F.nullif(F.col("__wiki"), F.lit(""))})


def wiki_get(meta: DataFrame, path: str) -> str:
    """One path's wiki; an error when there is none."""
    row = meta.filter(F.col("path") == path).select("wiki").first()
    if row is None or not row["wiki"]:
        raise LakeError(f"{path!r} has no wiki")
    return row["wiki"]


def wiki_meta_parse(meta: DataFrame) -> DataFrame:
    """``(path, base, position, tag_name, tag_value, tag_title)``: one row per entry
    of each wiki's block."""
    return meta.filter(F.col("wiki").contains(wiki.MARKER)).select(
        "path", wiki.base_text(F.col("wiki")).alias("base"), F.posexplode(wiki.tags(F.col("wiki"))).alias("position", "t")
    ).select("path", "base", "position", "t.*")


def wiki_meta_render(meta: DataFrame, changes: DataFrame, overwrite: bool = True) -> DataFrame:
    """Set the block of the paths in ``changes(path, entries)``, or extend it.

    ``entries`` is an array of structs ``(tag_name, tag_value, tag_title)``; a
    missing part is an error. Tables and views have tags of their own, so
    entries given for them are dropped.
    """
    parts = F.col("entries")
    lacking = F.exists(
        parts, lambda t: t["tag_name"].isNull() | t["tag_value"].isNull() | t["tag_title"].isNull()
    )
    first = changes.filter(lacking).first()
    if first is not None:
        raise LakeError(f"an entry for {first['path']!r} lacks its name, value or title")
    given = changes.select("path", parts.alias("__entries"))
    block = wiki.with_tags(F.col("wiki"), F.col("__entries"), overwrite)
    return _changed(meta, given, {"wiki": F.when(F.col("kind") == FOLDER, block).otherwise(F.col("wiki"))})


def wiki_meta_value(meta: DataFrame, tag_name: str, field: str | None = None) -> DataFrame:
    """Each block's first entry called ``tag_name``: all of it, or one field.

    A block without such an entry gives all its entries, as looking it up
    without a name does.
    """
    if field not in (None, "tag_value", "tag_title"):
        raise LakeError(f"field must be 'tag_value', 'tag_title' or None, not {field!r}")
    entries = meta.filter(F.col("wiki").contains(wiki.MARKER)).select(
        "path", wiki.tags(F.col("wiki")).alias("entries")
    )
    named = F.filter("entries", lambda t: t["tag_name"] == tag_name)
    chosen = F.when(F.size(named) > 0, F.slice(named, 1, 1)).otherwise(F.col("entries"))
    out = entries.select("path", F.inline(chosen))
    return out if field is None else out.select("path", "tag_name", field)


def carry_metadata(plan: DataFrame, meta: DataFrame) -> DataFrame:
    """Metadata for the targets of ``plan(source, target, kind)``: the wiki of every
    kind of entry, the tags of all but folders."""
    kept = meta.select(F.col("path").alias("source"), "tags", "wiki")
    joined = plan.join(kept, "source", "inner")
    no_tags = F.array().cast("array<string>")
    return joined.select(
        F.col("target").alias("path"),
        "kind",
        F.when(F.col("kind") == FOLDER, no_tags).otherwise(F.coalesce("tags", no_tags)).alias("tags"),
        "wiki",
    )
