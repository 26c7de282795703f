"""View definitions: tokens, references rewritten to new paths, build order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import sqltext
from lakewright.functions.skew import salted_join, sorted_join
from lakewright.session import materialise


def sql_tokens(views: DataFrame) -> DataFrame:
    """``(path, position, token, is_chain)`` of every view's ``sql``."""
    return views.select("path", F.posexplode(sqltext.pieces(F.col("sql"))).alias("position", "token")).select(
        "path", "position", "token", sqltext.is_chain(F.col("token")).alias("is_chain")
    )


def _chains(views: DataFrame) -> DataFrame:
    """One row per chain: its place, names, and whether it follows a word like FROM
    or is an alias; the chain before it counts unless a comma stands between."""
    numbered = F.transform(
        sqltext.pieces(F.col("sql")), lambda t, i: F.struct(i.alias("position"), t.alias("token"))
    )
    telling = F.filter(
        numbered, lambda p: sqltext.is_chain(p["token"]) | F.rtrim(p["token"]).endswith(",")
    )
    with_previous = F.transform(
        F.col("telling"),
        lambda p, i: F.struct(
            p["position"].alias("position"),
            p["token"].alias("token"),
            F.upper(F.when(i > 0, F.get(F.col("telling"), i - 1)["token"])).alias("previous"),
        ),
    )
    context = F.coalesce("context", F.array().cast("array<string>"))
    return (
        views.select("path", context.alias("context"), telling.alias("telling"))
        .select("path", "context", F.inline(with_previous))
        .filter(sqltext.is_chain(F.col("token")))
        .select(
            "path",
            "position",
            "context",
            sqltext.chain_names(F.col("token")).alias("names"),
            F.coalesce(F.col("previous").isin(*sqltext.REFERENCE_WORDS), F.lit(False)).alias("after_word"),
            F.coalesce(F.col("previous") == "AS", F.lit(False)).alias("after_as"),
        )
    )


def _joined(names: Column, count: Column | int) -> Column:
    return F.array_join(F.slice(names, 1, count), ".")


def _candidates(root: str) -> Column:
    """The known paths a chain may stand for, best last, as ``(rank, key, used, by_context)``."""
    names, full, before = F.col("names"), F.concat("context", "names"), F.size("context")
    every = F.sequence(F.lit(1), F.size("names"))

    def candidate(rank: Column, key: Column, used: Column, by_context: bool) -> Column:
        return F.struct(
            rank.alias("rank"), F.lower(key).alias("key"), used.alias("used"), F.lit(by_context).alias("by_context")
        )

    # A direct hit outranks any hit through the context, a longer one a shorter.
    direct = F.transform(every, lambda n: candidate(n + 1_000_000, _joined(names, n), n, False))
    relative = F.transform(every, lambda n: candidate(n, _joined(full, before + n), n, True))
    # A name given by AS is an alias, whatever entry is called the same.
    alias = F.col("after_as") & (F.size("names") == 1)
    both = F.when((before > 0) & ~alias, F.concat(direct, relative)).otherwise(direct)
    return F.filter(both, lambda c: (c["key"] == root) | c["key"].startswith(root + "."))


def rewrite_references(
    views: DataFrame,
    path_map: DataFrame,
    source: str,
    target: str,
    outside: DataFrame | None = None,
) -> DataFrame:
    """``views(path, sql, context)`` with references moved from ``source`` to ``target``.

    ``path_map(path, target)`` lists every entry that moves, ``outside(path)``
    what exists elsewhere. For each chain the first rule that answers wins:
    its longest prefix that is a known entry; the ``source`` prefix itself;
    the view's context plus a prefix of the chain as a known entry; behind a
    word like FROM, context plus chain as an entry outside, then spelled out.
    Everything else, and all literals and comments, stay as written.

    Adds ``new_sql``, ``references`` (the known paths used, in path order) and
    ``notes``. Only chains that can match leave the scan; their prefixes are
    looked up by equi-join, salted because many views may share one table.
    """
    root, root_names = source.lower(), [n for n in source.split(".") if n]
    size, before = F.size("names"), F.size("context")
    swaps = F.lit(False)
    if len(root_names) >= 2:
        # One name alone could just as well be a table's alias.
        swaps = F.lower(_joined(F.col("names"), len(root_names))) == root
    # Dealt out before the texts are taken apart: a small file of many views is few tasks.
    views = views.repartition("path")
    chains = _chains(views).withColumns({"candidates": _candidates(root), "swaps": swaps})
    telling = chains.filter((F.size("candidates") > 0) | F.col("swaps") | F.col("after_word"))
    kept = ["path", "position", "context", "names", "after_word", "swaps"]
    asked = telling.select(*kept, F.inline_outer("candidates"))
    entries = path_map.select(F.lower("path").alias("key"), F.col("target").alias("new_path"))
    looked_up = salted_join(asked, entries, ["key"], "left", ["path", "position"])
    hit = F.when(F.col("new_path").isNotNull(), F.struct("key", "new_path", "used", "by_context"))
    answered = looked_up.groupBy("path", "position").agg(
        *[F.first(c).alias(c) for c in kept[2:]],
        F.max_by(hit, F.when(hit.isNotNull(), F.col("rank"))).alias("hit"),
    )
    found = F.col("hit").isNotNull()
    swapped = F.col("swaps") & ~(found & ~F.col("hit.by_context"))
    known = found & ~swapped
    open_chain = ~found & ~swapped & F.col("after_word")
    full = F.concat("context", "names")
    answered = answered.withColumn("spelled", F.when(open_chain & (before > 0), F.array_join(full, ".")))
    if outside is None:
        answered = answered.withColumn("is_outside", F.lit(None).cast("boolean"))
    else:
        there = outside.select(F.col("path").alias("spelled")).distinct().withColumn("is_outside", F.lit(True))
        answered = salted_join(answered, there, ["spelled"], "left", ["path", "position"])
    rest = F.slice("names", F.col("hit.used") + 1, F.greatest(size - F.col("hit.used"), F.lit(0)))
    moved_rest = F.slice("names", len(root_names) + 1, F.greatest(size - len(root_names), F.lit(0)))
    new_names = (
        F.when(known, F.concat(F.split("hit.new_path", r"\."), rest))
        .when(swapped, F.concat(F.split(F.lit(target), r"\."), moved_rest))
        .when(F.col("is_outside"), full)
    )
    dotted = F.array_join("names", ".")
    note = F.when(
        F.col("is_outside"),
        F.concat(dotted, F.lit(" was relative to the view's context: written out as "), "spelled"),
    ).when(
        open_chain & (before == 0) & (size == 1),
        F.concat(dotted, F.lit(" has no folder and the view's context is unknown: left as written")),
    )
    changed = answered.select(
        "path", "position", sqltext.quoted_names(new_names).alias("text"), note.alias("note"),
        F.when(known, F.col("hit.key")).alias("reference"),
    )
    # One row per view: a view's pieces came out of one row, so they fit in one.
    per_view = changed.groupBy("path").agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("text").isNotNull(), F.struct("position", "text")))
        ).alias("changes"),
        F.sort_array(F.collect_set("reference")).alias("references"),
        F.sort_array(F.collect_set("note")).alias("notes"),
    )
    new_pieces = F.transform(
        sqltext.pieces(F.col("sql")), lambda t, i: F.coalesce(F.try_element_at(F.col("changes"), i), t)
    )
    nothing = F.array().cast("array<string>")
    return sorted_join(views, per_view, "path", "left").select(
        *views.columns,
        F.when(F.size("changes") > 0, F.array_join(new_pieces, "")).otherwise(F.col("sql")).alias("new_sql"),
        F.coalesce("references", nothing).alias("references"),
        F.coalesce("notes", nothing).alias("notes"),
    )


def dependency_edges(rewritten: DataFrame) -> DataFrame:
    """``(path, needs)`` from the ``references`` of rewritten views."""
    return rewritten.select("path", F.explode("references").alias("needs"))


#: How many times further a round of :func:`longest_ways` looks than the one before.
REACH = 4


def longest_ways(edges: DataFrame) -> tuple[DataFrame, int]:
    """``(key, needs, far)``: the longest way from a key to everything behind it, in steps, and ``most``.

    ``edges(key, needs)`` are the single steps. A round knows all ways of up to ``k``
    steps; a longer one begins with a way of exactly ``k``, so only those are put in
    front of the known ones, and the next round knows ways of ``REACH`` times ``k``. Rounds
    grow with the logarithm of the longest way, each reads what the one before wrote, and
    all have the same plan. Ways on a cycle never end: they are ``most`` steps long at last, one
    more than there are single steps, and so than any other way has.
    """
    counted, k = Observation(), 1
    steps = edges.select("key", "needs", F.lit(1).alias("far")).observe(counted, F.count(F.lit(1)).alias("steps"))
    ways = materialise(steps, "ways")
    most = counted.get.get("steps", 0) + 1
    while k < most:
        ahead = ways.filter(F.col("far") == k).select("key", F.col("needs").alias("by"))
        found, tail = ways, ways
        for _ in range(REACH - 1):
            tail = sorted_join(ahead, tail.withColumnRenamed("key", "by"), "by")
            tail = tail.select("key", "needs", (F.col("far") + k).alias("far"))
            found = found.unionByName(tail)
        seen = Observation()
        longest = found.groupBy("key", "needs").agg(F.least(F.max("far"), F.lit(most)).alias("far"))
        ways = materialise(longest.observe(seen, F.max("far").alias("far")), "ways")
        k *= REACH
        if (seen.get["far"] or 0) < k:
            break
    return ways, most


def view_levels(views: DataFrame, edges: DataFrame) -> DataFrame:
    """``(path, level)``: building by level puts a view after all it selects from.

    Level 0 needs no other view; a view's level is the longest way down from it.
    Views in or behind a cycle get no level (null): they keep their listing order.
    """
    keys = views.select(F.lower("path").alias("key"), "path").dropDuplicates(["key"])
    known = keys.select("key")
    wanted = edges.select(F.lower("path").alias("key"), F.lower("needs").alias("needs"))
    wanted = wanted.filter("key <> needs")
    inner = sorted_join(wanted, known.withColumnRenamed("key", "needs"), "needs", "left_semi")
    # By key the rows are dealt evenly: a view names no more than its own text holds.
    inner = sorted_join(inner, known, "key", "left_semi").distinct()
    ways, most = longest_ways(inner)
    deepest = ways.groupBy("key").agg(F.max("far").alias("far"))
    level = F.when(F.coalesce("far", F.lit(0)) < most, F.coalesce("far", F.lit(0)))
    return sorted_join(keys, deepest, "key", "left").select("path", level.alias("level"))


def view_definition(lake, path: str) -> tuple[str, list[str] | None]:
    """``(sql, context)`` of a view; an unknown context is None, not empty."""
    from lakewright.lake import VIEW

    if lake.kind(path) != VIEW:
        raise LakeError(f"{path!r} is no view")
    rows = lake.spark.sql(f"DESCRIBE EXTENDED {lake.sql_name(path)}").collect()
    found = {r["col_name"]: r["data_type"] for r in rows}
    own = lake.property(path, "lakewright.sql")
    if own is not None:
        context = lake.property(path, "lakewright.context")
        return own, context.split(".") if context else None
    if "View Text" not in found:
        raise LakeError(f"the definition of {path!r} cannot be read")
    return found["View Text"], None
