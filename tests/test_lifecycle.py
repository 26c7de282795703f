import pytest

from lakewright.errors import LakeError
from lakewright.operators import folders, lifecycle, views
from lakewright.operators.writes import create_table
from lakewright.plans.folders import check_folders
from lakewright.plans.lifecycle import PUBLIC_TAG, partition_fields

AREA = "lake.water.surface.rivers"


@pytest.fixture
def table(lake, spark):
    def make(path, rows=3, by=()):
        df = spark.range(rows).selectExpr("id", "id % 2 AS Year", "'x' AS country")
        create_table(lake, df, path, partition_by=list(by))

    return make


def _statuses(report):
    return {(r["target"] or r["source"]): r["status"] for r in report.collect()}


def test_copy(lake, table):
    table("a.x.t")
    with pytest.raises(LakeError, match="does not exist"):
        lifecycle.copy_table(lake, "a.x.none", "a.y.t")
    with pytest.raises(LakeError, match="folder 'a.y' does not exist"):
        lifecycle.copy_table(lake, "a.x.t", "a.y.t")
    assert tuple(lifecycle.copy_table(lake, "a.x.t", "a.y.u", create_folder=True).first())[:4] == ("a.x.t", "a.y.u", "copied", 3)
    with pytest.raises(LakeError, match="already exists"):
        lifecycle.copy_table(lake, "a.x.t", "a.y.u")
    # A folder as target receives the table under its own name.
    assert lifecycle.copy_table(lake, "a.x.t", "a.y").first()["target"] == "a.y.t"
    assert lifecycle.copy_table(lake, "a.x.t", "a.y.u", overwrite=True).first()["status"] == "replaced"


def test_copy_replaces_a_view_by_its_kind(lake, table):
    table("a.x.t")
    views.create_view(lake, "a.x.t", "a.x.v")
    lifecycle.copy_table(lake, "a.x.t", "a.x.v", overwrite=True)
    assert lake.kind("a.x.v") == "TABLE"


def test_drop_by_kind(lake, table):
    table("a.x.t")
    views.create_view(lake, "a.x.t", "a.x.v")
    with pytest.raises(LakeError, match="is a view"):
        lifecycle.drop_table(lake, "a.x.v")
    assert lifecycle.drop_view(lake, "a.x.v") and not lifecycle.drop_view(lake, "a.x.v")
    with pytest.raises(LakeError, match="not empty"):
        lake.drop_folder("a")
    lake.drop_folder("a", cascade=True)
    assert lake.entries() == [] and not lake.is_folder("a.x")


def test_quoted_names(lake, table):
    table('a."v1.0"."my table"')
    assert lake.entries() == [("a.v1.0.my table", "TABLE")]
    assert views.executable_sql(lake, 'SELECT * FROM a."v1.0"."my table" t').endswith(f"{lake.sql_name(chr(34).join(['a.', 'v1.0', '.', 'my table', '']))} t")


def test_moved_views_keep_their_own_sql(lake, table):
    table("a.x.t")
    views.create_view_as(lake, "a.x.v", "SELECT * FROM a.x.t WHERE id > 0")
    lake.set_tags("a.x.v", ["kept"])
    lifecycle.move_table(lake, "a.x.v", "b.y.v", create_folder=True)
    assert lake.table("b.y.v").count() == 2 and lake.kind("a.x.v") is None
    assert lake.tags("b.y.v") == ["kept"]


def test_move_keeps_partitions(lake, table):
    table("a.x.t", by=["Year"])
    lifecycle.move_table(lake, "a.x.t", "a.x.u")
    lifecycle.move_table(lake, "a.x.u", "b.z.u", create_folder=True)
    assert lake.table("b.z.u").count() == 3 and lake.partition_columns("b.z.u") == ["Year"]


def test_verify_sees_a_changed_value(spark):
    df = spark.range(1000).selectExpr("id", "cast(id AS string) AS s")
    check = lambda other: lifecycle.verify_copy({"t": (df, other)}).first()["same"]
    assert check(df.orderBy(df.id.desc()).repartition(7))
    assert not check(df.selectExpr("id", "if(id = 5, 'x', s) AS s"))
    assert not check(df.filter("id <> 5"))
    # Same count: one row twice in place of another.
    assert not check(df.filter("id <> 5").unionAll(df.filter("id = 6")))
    assert not check(df.filter("id NOT IN (5, 6)").unionAll(df.filter("id IN (7)")).unionAll(df.filter("id IN (7)")))


@pytest.fixture
def area(lake, table):
    table(f"{AREA}.draft.set.assessments")
    table(f"{AREA}.draft.set.stations", 5, ["Year"])
    table(f"{AREA}.draft.reference.classes")
    views.create_view(lake, f"{AREA}.draft.set.assessments", f"{AREA}.draft.set.latest")
    for folder in ("versions", "reference"):
        lake.ensure_folder(f"{AREA}.{folder}")
    return lake


def test_version(area):
    versions = f"{AREA}.versions"
    report = lifecycle.create_version(area, f"{AREA}.draft", "v1", versions)
    assert _statuses(report) == {
        f"{versions}.v1.set.assessments": "copied", f"{versions}.v1.set.stations": "copied",
        f"{AREA}.draft.reference.classes": "skipped", f"{AREA}.draft.set.latest": "skipped",
    }
    assert area.partition_columns(f"{versions}.v1.set.stations") == ["Year"]
    with pytest.raises(LakeError, match="already exists"):
        lifecycle.create_version(area, f"{AREA}.draft", "v1", versions)
    again = lifecycle.create_version(area, f"{AREA}.draft", "v1", versions, ["set.stations"], overwrite=True)
    assert _statuses(again) == {f"{versions}.v1.set.stations": "replaced"}
    assert area.table(f"{versions}.v1.set.stations").count() == 5


@pytest.mark.parametrize(
    ("kwargs", "message"),
    [
        ({"version": "a.b"}, "one non-blank"), ({"version": " "}, "one non-blank"),
        ({"source": "lake.none"}, "does not exist"), ({"target": "lake.none"}, "does not exist"),
        ({"tables": ["reference"]}, "nothing to copy"), ({"tables": ["none"]}, "no table or folder"),
    ],
)
def test_refused_versions(area, kwargs, message):
    args = {"source": f"{AREA}.draft", "version": "v1", "target": f"{AREA}.versions", **kwargs}
    with pytest.raises(LakeError, match=message):
        lifecycle.create_version(area, **args)
    assert not area.is_folder(f"{AREA}.versions.v1")


def test_a_failed_version_leaves_nothing(area, monkeypatch):
    real = lifecycle.writes.stage

    def fail(lake, df, path, *args, **kwargs):
        if path.endswith("stations"):
            raise RuntimeError("disk full")
        real(lake, df, path, *args, **kwargs)

    monkeypatch.setattr(lifecycle.writes, "stage", fail)
    before = area.entries()
    with pytest.raises(RuntimeError, match="disk full"):
        lifecycle.create_version(area, f"{AREA}.draft", "v1", f"{AREA}.versions")
    assert area.entries() == before and not area.is_folder(f"{AREA}.versions.v1")


def test_find_draft(area):
    assert lifecycle.find_draft(area, AREA) == f"{AREA}.draft"
    assert lifecycle.find_draft(area, f"{AREA}.draft.set") == f"{AREA}.draft"
    with pytest.raises(LakeError):
        lifecycle.find_draft(area, "lake.water")


@pytest.fixture
def released(area):
    lifecycle.draft_to_version(area, AREA, "v1")
    area.set_tags(f"{AREA}.versions.v1.set.stations", [PUBLIC_TAG, "x"])
    lifecycle.update_latest_release(area, AREA, "v1")
    return area


def test_release(released):
    assert released.kind(f"{AREA}.set.latest") == "VIEW"
    assert released.tags(f"{AREA}.set.stations") == [PUBLIC_TAG]
    assert released.tags(f"{AREA}.versions.v1.set.stations") == ["x"]
    with pytest.raises(LakeError, match="view already exists"):
        lifecycle.update_latest_release(released, AREA, "v1", overwrite=False)
    with pytest.raises(LakeError, match="lacks: draft; versions"):
        lifecycle.update_latest_release(released, "lake.water", "v1")
    assert set(_statuses(lifecycle.update_latest_release(released, AREA, "v1")).values()) == {"replaced"}


def test_a_release_never_replaces_a_table(released, table):
    lifecycle.drop_view(released, f"{AREA}.set.stations")
    table(f"{AREA}.set.stations")
    with pytest.raises(LakeError, match="never replaces a table"):
        lifecycle.update_latest_release(released, AREA, "v1")


def test_publish(released):
    views.create_view(released, f"{AREA}.draft.set.stations", f"{AREA}.set.internal")
    report = lifecycle.publish(released, AREA, "public", partition_by={"set/stations": ["YEAR"]})
    target = f"public.{AREA}.set."
    assert _statuses(report) == {
        target + "assessments": "copied", target + "latest": "copied", target + "stations": "copied",
        f"{AREA}.set.internal": "skipped",
    }
    assert released.partition_columns(target + "stations") == ["Year"]
    assert released.table(target + "stations").count() == 5


@pytest.mark.parametrize(
    ("partition_by", "message"),
    [(["none"], "no field"), ({"nowhere": ["id"]}, "not published"), ("year", "must be a list"), (["id", "id"], "repeats")],
)
def test_refused_publication(released, partition_by, message):
    with pytest.raises(LakeError, match=message):
        lifecycle.publish(released, AREA, "public", partition_by=partition_by)
    assert released.entries("public") == []


def test_a_failed_publication_keeps_what_was_published(released, spark):
    lifecycle.publish(released, AREA, "public")
    views.create_view_as(
        released, f"{AREA}.set.stations", f"SELECT raise_error('broken') AS id FROM {AREA}.versions.v1.set.stations", overwrite=True
    )
    before = released.entries("public")
    with pytest.raises(Exception, match="broken"):
        lifecycle.publish(released, AREA, "public")
    assert released.entries("public") == before
    assert released.table(f"public.{AREA}.set.stations").count() == 5


def test_partition_fields():
    assert partition_fields({"b", "a"}) == ["a", "b"] and partition_fields([" x "]) == ["x"]
    for bad in ([], [""], [1]):
        with pytest.raises(LakeError):
            partition_fields(bad)


@pytest.mark.parametrize(("a", "b"), [("x.y", "X.y"), ("x", "x.y"), ("x.y", "x"), ("", "x")])
def test_refused_folders(a, b):
    with pytest.raises(LakeError):
        check_folders(a, b)


@pytest.fixture
def tree(lake, table):
    table("sea.draft.raw.measurements", 100)
    table("sea.draft.raw.stations", 10)
    lake.ensure_folder("sea.draft.empty")
    views.create_view_as(lake, "sea.draft.assessments", "SELECT * FROM sea.draft.raw.measurements WHERE id < 50")
    views.create_view_as(lake, "sea.draft.a_summary", "SELECT count(*) AS n FROM assessments", context=["sea", "draft"])
    lake.set_wiki("sea.draft.raw.stations", "Where it's measured")
    return lake


def test_folder_copy(tree):
    dry = folders.folder_copy(tree, "sea.draft", "sea.archive", dry_run=True)
    assert {r["status"] for r in dry.collect()} == {"planned"} and not folders.is_verified(dry)
    assert not tree.is_folder("sea.archive")
    report = folders.folder_copy(tree, "sea.draft", "sea.archive")
    assert folders.is_verified(report)
    assert tree.is_folder("sea.archive.empty")
    assert tree.table("sea.archive.a_summary").first()["n"] == 50
    assert tree.wiki("sea.archive.raw.stations") == "Where it's measured"
    again = folders.folder_copy(tree, "sea.draft", "sea.archive")
    assert {r["status"] for r in again.collect() if r["kind"] != "FOLDER"} == {"skipped"}
    # The copies no longer depend on the source.
    tree.drop_folder("sea.draft", cascade=True)
    assert tree.table("sea.archive.a_summary").first()["n"] == 50


def test_folder_move_needs_the_proof(tree, table):
    table("sea.archive.raw.stations", 3)
    report = folders.folder_move(tree, "sea.draft", "sea.archive")
    failed = [r for r in report.collect() if r["status"] == "failed"]
    assert [r["target"] for r in failed] == ["sea.archive.raw.stations"]
    assert tree.table("sea.draft.raw.stations").count() == 10
    done = folders.folder_move(tree, "sea.draft", "sea.archive", overwrite=True)
    assert folders.is_verified(done) and not tree.is_folder("sea.draft")
    assert tree.table("sea.archive.a_summary").first()["n"] == 50


def test_context_in_a_comma_join(lake, table):
    table("a.x.t")
    table("a.x.u")
    views.create_view_as(
        lake, "a.x.v", "SELECT t.id, u.id AS t FROM t, u WHERE t.id = u.id", context=["a", "x"]
    )
    assert lake.table("a.x.v").count() == 3


ODD = "It's (a, b) \\ \"q\" — é\n(lakewright.wiki,x)"


def test_folder_wikis(lake):
    lake.ensure_folder("sea.draft.raw")
    assert lake.folder_wiki("sea.draft.raw") is None
    with pytest.raises(LakeError, match="no wiki"):
        lake.wiki("sea.draft.raw")
    lake.set_wiki("sea.draft.raw", ODD)
    lake.set_wiki("sea", "top")  # a folder on the way to others
    assert (lake.wiki("Sea.Draft.RAW"), lake.wiki("sea")) == (ODD, "top")
    found = {r.path: r.wiki for r in lake.metadata(folders=True).collect()}
    assert found == {"sea": "top", "sea.draft": None, "sea.draft.raw": ODD}
    assert lake.metadata().collect() == []
    lake.delete_wiki("sea.draft.raw")
    assert lake.folder_wiki("sea.draft.raw") is None
    with pytest.raises(LakeError, match="does not exist"):
        lake.set_folder_wiki("sea.gone", "x")


def test_an_entry_and_a_folder_of_one_name(lake, table):
    table("sea.draft", 1)
    lake.ensure_folder("sea.draft")
    lake.set_wiki("sea.draft", "of the table")
    lake.set_folder_wiki("sea.draft", "of the folder")
    assert (lake.wiki("sea.draft"), lake.folder_wiki("sea.draft")) == ("of the table", "of the folder")


def test_folder_wikis_move(tree):
    tree.set_wiki("sea.draft", ODD)
    tree.set_wiki("sea.draft.empty", "nothing here")
    folders.folder_copy(tree, "sea.draft", "sea.other", copy_metadata=False)
    assert tree.folder_wiki("sea.other") is None
    assert folders.is_verified(folders.folder_move(tree, "sea.draft", "sea.archive"))
    assert (tree.wiki("sea.archive"), tree.wiki("sea.archive.empty")) == (ODD, "nothing here")
    assert tree.folder_wiki("sea.archive.raw") is None and not tree.is_folder("sea.draft")


def test_stored_metadata(lake, table):
    table("sea.draft.t", 1)
    lake.set_wiki("sea.draft.t", "old")
    meta = lake.metadata(folders=True)
    rows = [(r.path, r.kind, ["x"] if r.kind == "TABLE" else [], f"about {r.path}" if r.kind == "FOLDER" else None) for r in meta.collect()]
    lake.store_metadata(lake.spark.createDataFrame(rows, meta.schema))
    assert sorted(map(tuple, lake.metadata(folders=True).collect())) == sorted(rows)
