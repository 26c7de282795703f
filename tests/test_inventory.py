import pytest
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.operators import inventory as inv

ENTRIES = [
    ("lake.d.draft.set.assessments", "TABLE"),
    ("lake.d.draft.set.stations", "TABLE"),
    ("lake.d.draft.set.latest", "VIEW"),
    ("lake.d.draft.reference.classes", "TABLE"),
    ("lake.d.draft_old.x", "TABLE"),
    ("lake.d%.y", "TABLE"),
]


@pytest.fixture
def catalog(frame):
    return frame(ENTRIES, "path string, kind string")


def _paths(df, column="path"):
    return [r[column] for r in df.collect()]


def test_wildcards_mean_nothing(catalog):
    assert _paths(inv.entries_under(catalog, "lake.d%")) == ["lake.d%.y"]
    assert _paths(inv.entries_under(catalog, "lake.d.draft_")) == []
    assert len(_paths(inv.entries_under(catalog, "lake.d.draft"))) == 4


def test_datasets(catalog):
    assert [tuple(r) for r in inv.list_datasets(catalog, "lake.d.draft_old").collect()] == [("TABLE", "lake.d.draft_old.x")]
    assert _paths(inv.list_datasets(catalog, "lake.d.draft.set.latest"), "name") == ["lake.d.draft.set.latest"]
    with pytest.raises(LakeError, match="does not exist"):
        inv.list_datasets(catalog, "lake.nowhere")


def test_folders_come_parents_first(catalog):
    assert _paths(inv.folders(catalog, "lake.d")) == [
        "lake.d.draft", "lake.d.draft_old", "lake.d.draft.reference", "lake.d.draft.set",
    ]
    assert _paths(inv.folders(catalog, "lake.d", recursive=False)) == ["lake.d.draft", "lake.d.draft_old"]
    assert _paths(inv.folders(catalog))[0] == "lake"


def test_kinds(catalog, frame):
    assert inv.entry_kind(catalog, "lake.d.draft.set.latest") == "VIEW"
    with pytest.raises(LakeError):
        inv.entry_kind(catalog, "lake.d.draft")
    wanted = frame(["lake.d%.y", "no"], "path string")
    assert {r["path"]: r["kind"] for r in inv.entry_kinds(catalog, wanted).collect()} == {"lake.d%.y": "TABLE", "no": None}


def test_selection(catalog):
    source = "lake.d.draft"
    assert len(inv.expand_selection(catalog, source).collect()) == 4
    # Listed and inside a listed folder: once, where it is named first.
    got = _paths(inv.expand_selection(catalog, source, ["set.stations", "lake.d.draft.set"]))
    assert got == [f"{source}.set.stations", f"{source}.set.assessments", f"{source}.set.latest"]
    with pytest.raises(LakeError) as caught:
        inv.expand_selection(catalog, source, ["nothing", "set", "lake.d.draft.none"])
    assert caught.value.problems == ["none", "nothing"]
    with pytest.raises(LakeError, match="more than once"):
        inv.expand_selection(catalog, source, ["set", " set "])
    with pytest.raises(LakeError, match="non-empty"):
        inv.expand_selection(catalog, source, [" . "])
    with pytest.raises(LakeError, match="nothing to copy"):
        inv.expand_selection(catalog, "lake.none")


@pytest.fixture
def layers(frame):
    rows = [("r.a.stations", "TABLE"), ("r.b.stations", "VIEW"), ("r.codes", "TABLE"), ("r.gpkg_things", "TABLE")]
    return frame(rows, "path string, kind string")


def test_layers(layers):
    assert _paths(inv.select_layers(layers, "r", ["stations"])) == ["r.a.stations", "r.b.stations"]
    assert _paths(inv.select_layers(layers, "r", ["b/stations", "codes"])) == ["r.b.stations", "r.codes"]
    assert len(_paths(inv.select_layers(layers, "r"))) == 4
    with pytest.raises(LakeError, match="nothing"):
        inv.select_layers(layers, "r", ["nothing", "codes"])
    got = {r["path"]: r["layer"] for r in inv.layer_names(layers, "r").collect()}
    assert got == {
        "r.a.stations": "a_stations", "r.b.stations": "b_stations", "r.codes": "codes", "r.gpkg_things": "t_gpkg_things",
    }


def test_hot_leaf_and_hot_folder(spark):
    # One leaf name and one folder hold most of the entries.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("r.f"), "id", F.lit(".same")))
        .otherwise(F.concat(F.lit("r.hot.t"), "id")).alias("path"),
        F.lit("TABLE").alias("kind"),
    )
    names = inv.layer_names(rows, "r")
    assert names.count() == 3000 and names.select("layer").distinct().count() == 3000
    assert inv.expand_selection(rows, "r", ["hot"]).count() == 2000


def test_path_plan(catalog, frame):
    wanted = frame(["lake.d.draft.new.deeper", "lake.other.x"], "path string")
    got = {r["path"]: r["action"] for r in inv.path_plan(catalog, wanted).collect()}
    assert got == {
        "lake": "exists", "lake.d": "exists", "lake.d.draft": "exists", "lake.d.draft.new": "would create",
        "lake.d.draft.new.deeper": "would create", "lake.other": "missing", "lake.other.x": "missing",
    }


def test_copy_targets(frame):
    asked = frame([("a.t", "b"), ("a.t", "b.u"), ("a.t", "c/")], "source string, target string")
    got = {r["target"]: r["copy_path"] for r in inv.copy_targets(asked, frame(["b"], "path string")).collect()}
    assert got == {"b": "b.t", "b.u": "b.u", "c/": "c.t"}
