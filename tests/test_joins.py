"""Joins whose small side only looks small: its rows are computed or repeated from a compressed file."""

import pytest
from pyspark.sql import functions as F

from lakewright.functions.skew import salted_join, sorted_join
from lakewright.operators import inventory, lineage, listing
from lakewright.plans.folders import folder_scan


@pytest.fixture
def stored(frame, tmp_path, spark):
    """Rows read back from a small file, whose size Spark knows."""

    def make(rows, schema):
        at = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        frame(rows, schema).write.parquet(at)
        return spark.read.parquet(at)

    return make


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_are_sorted(stored):
    many, few = stored([(1, "x"), (1, "y"), (2, "z")], "k int, v string"), stored([(1, "one")], "k int, n string")
    for joined in (salted_join(many, few, ["k"], "left"), sorted_join(many, few, "k", "left")):
        assert "Broadcast" not in plan(joined)
        assert sorted((r.k, r.v, r.n) for r in joined.collect()) == [(1, "x", "one"), (1, "y", "one"), (2, "z", None)]


def test_renames_stay_out_of_the_driver(stored):
    files = stored(["a.csv", "a.csv", "b.csv"], "name string")
    renames = stored([("a.csv", "c.csv"), ("b.csv", " ")], "name string, new_name string")
    planned = listing.rename_plan(files, renames)
    assert "Broadcast" not in plan(planned) + plan(listing.name_clashes(planned))
    # The renames are not repeated either.
    assert "Generate" not in plan(planned)
    assert sorted(r.new_name for r in planned.collect()) == ["b.csv", "c.csv", "c.csv"]
    assert [tuple(r) for r in listing.name_clashes(planned).collect()] == [("c.csv", 2)]


def test_view_levels_stay_out_of_the_driver(stored):
    views = stored(["v1", "v2", "v3"], "path string")
    edges = stored([("v2", "v1"), ("v3", "v2")], "path string, needs string")
    levels = lineage.view_levels(views, edges)
    assert "Broadcast" not in plan(levels)
    assert sorted(tuple(r) for r in levels.collect()) == [("v1", 0), ("v2", 1), ("v3", 2)]


@pytest.fixture
def catalog(stored):
    entries = stored([("c.t", "TABLE"), ("c.v", "VIEW"), ("d.t", "TABLE")], "path string, kind string")
    views = stored([("c.v", "SELECT * FROM c.t JOIN d.t x", None)], "path string, sql string, context array<string>")
    return entries, views


def test_references_stay_out_of_the_driver(catalog):
    entries, views = catalog
    moved = entries.filter("path LIKE 'c.%'").withColumn("target", F.concat(F.lit("a."), "path"))
    out = lineage.rewrite_references(views, moved, "c", "a.c", outside=entries.filter("path LIKE 'd.%'"))
    assert "Broadcast" not in plan(out)
    assert out.first()["new_sql"] == 'SELECT * FROM "a"."c"."t" JOIN d.t x'


def test_folder_scan_stays_out_of_the_driver(catalog):
    out = folder_scan(*catalog, "c", "a.c")
    assert "Broadcast" not in plan(out)
    assert sorted((r.source, r.level) for r in out.collect() if r.kind == "VIEW") == [("c.v", 0)]


def test_only_the_asked_names_are_broadcast(stored):
    entries = stored([("c.a.t", "TABLE"), ("c.b.u", "VIEW")], "path string, kind string")
    assert [r.path for r in inventory.select_layers(entries, "c", ["b/u", "t"]).collect()] == ["c.a.t", "c.b.u"]
    text = plan(inventory.select_layers(entries, "c", ["b/u", "t"]))
    # The rows of the catalog are the streamed side.
    assert "BuildRight" in text and "Exchange hashpartitioning(suffix" not in text
