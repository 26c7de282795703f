"""Loads that must not lose or change values, and changes that must be undone as a whole."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from lakewright.errors import LakeError
from lakewright.lake import Ident
from lakewright.operators import ingest, lifecycle, spatial, views, writes
from lakewright.streaming.incremental import incremental_ingest


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_given_types_are_read_from_the_text(lake, tmp_path):
    folder = write(tmp_path / "in", "a.csv", "code,amount,n\n007,12345678901234567.89,3\n010,0.01,\n")
    wanted = ingest.TableDefinition([("code", "VARCHAR"), ("amount", "DECIMAL(20,2)"), ("n", "BIGINT")])
    for infer in (True, False):
        table = f"l.t{int(infer)}"
        ingest.ingest(lake, folder, table, "csv", definition=wanted, infer_schema=infer)
        rows = sorted((r.code, str(r.amount), r.n) for r in lake.table(table).collect())
        assert rows == [("007", "12345678901234567.89", 3), ("010", "0.01", None)]


@pytest.mark.parametrize("row", ["3,4,5", "6"])
def test_ragged_rows_are_refused(lake, tmp_path, row):
    folder = write(tmp_path / "in", "r.csv", f"a,b\n1,2\n{row}\n")
    with pytest.raises(LakeError, match="more or fewer cells.*r.csv"):
        ingest.ingest(lake, folder, "l.t", "csv")
    assert lake.kind("l.t") is None
    with pytest.raises(LakeError, match="more or fewer cells"):
        ingest.ingest_slice(lake, folder, "l.s", "csv", "one")


def test_a_slice_is_checked_like_a_load(lake, tmp_path):
    folder = write(tmp_path / "in", "a.csv", "name\nMünchen\n".encode("latin-1"))
    with pytest.raises(LakeError, match="UTF-8"):
        ingest.ingest_slice(lake, folder, "l.t", "csv", "one")


def test_other_jobs_may_write_an_incremental_table(lake, tmp_path):
    folder = write(tmp_path / "in", "a.json", '{"k": 1}\n{"k": 2}\n')
    load = (lake, folder, "l.t", "json", T.StructType([T.StructField("k", T.LongType())]), str(tmp_path / "log"))
    assert incremental_ingest(*load).count() == 2
    other = write(tmp_path / "more", "b.json", '{"k": 3}\n')
    ingest.ingest(lake, other, "l.t", "json", conflict_mode="append")
    write(tmp_path / "in", "c.json", '{"k": 4}\n')
    assert sorted(r.k for r in incremental_ingest(*load).collect()) == [1, 2, 3, 4]
    ingest.ingest(lake, other, "l.t", "json", conflict_mode="replace")
    write(tmp_path / "in", "d.json", '{"k": 5}\n')
    assert sorted(r.k for r in incremental_ingest(*load).collect()) == [3, 5]


def numbers(lake, path, n):
    writes.create_table(lake, lake.spark.range(n).toDF("k"), path)


def failing_rename(monkeypatch, name):
    real = writes.rename_table

    def rename(lake, old, new):
        if new.table == name and old.table.endswith("__staging"):
            raise RuntimeError("stopped here")
        real(lake, old, new)

    monkeypatch.setattr(writes, "rename_table", rename)


def test_a_version_is_whole_or_not_there(lake, monkeypatch):
    for name in ("t", "u"):
        numbers(lake, f"a.draft.{name}", 3)
    lake.ensure_folder("other.job")
    failing_rename(monkeypatch, "u")
    with pytest.raises(RuntimeError):
        lifecycle.create_version(lake, "a.draft", "v1", "a.versions", create_target_folder=True)
    assert lake.is_folder("other.job")
    assert lake.entries("a") == [("a.draft.t", "TABLE"), ("a.draft.u", "TABLE")]
    assert not lake.is_folder("a.versions.v1")


def test_replaced_tables_come_back(lake, monkeypatch):
    for name in ("t", "u"):
        numbers(lake, f"a.draft.{name}", 3)
    lifecycle.create_version(lake, "a.draft", "v1", "a.versions", create_target_folder=True)
    writes.append_table(lake, lake.spark.range(5).toDF("k"), "a.draft.t")
    failing_rename(monkeypatch, "u")
    with pytest.raises(RuntimeError):
        lifecycle.create_version(lake, "a.draft", "v1", "a.versions", overwrite=True)
    assert [lake.table(f"a.versions.v1.{n}").count() for n in ("t", "u")] == [3, 3]
    assert [p for p, _ in lake.entries("a.versions")] == ["a.versions.v1.t", "a.versions.v1.u"]


def test_a_foreign_table_in_a_new_folder_stays(lake, monkeypatch):
    numbers(lake, "a.draft.t", 3)
    real = lifecycle._stage_all

    def meanwhile(lake, copies):
        numbers(lake, "a.versions.v1.foreign", 4)
        real(lake, copies)
        raise RuntimeError("stopped here")

    monkeypatch.setattr(lifecycle, "_stage_all", meanwhile)
    with pytest.raises(RuntimeError):
        lifecycle.create_version(lake, "a.draft", "v1", "a.versions", create_target_folder=True)
    assert lake.table("a.versions.v1.foreign").count() == 4


def test_tables_of_a_switch_are_not_listed(lake):
    numbers(lake, "a.b.t", 1)
    writes.stage(lake, lake.spark.range(2).toDF("k"), "a.b.u")
    assert lake.entries("a") == [("a.b.t", "TABLE")]


def test_what_was_set_aside_counts_as_there(lake):
    numbers(lake, "a.b.t", 9)
    numbers(lake, "a.b.s", 3)
    ident = lake.ident("a.b.t")
    writes.rename_table(lake, ident, Ident(ident.database, ident.table + "__old"))
    with pytest.raises(LakeError, match="already exists"):
        lifecycle.copy_table(lake, "a.b.s", "a.b.t")
    assert lake.table("a.b.t").count() == 9


def test_a_failed_move_keeps_its_target(lake, monkeypatch):
    numbers(lake, "a.b.t", 9)
    numbers(lake, "a.b.s", 3)
    real = writes.rename_table

    def rename(lake, old, new):
        if old.table == "s":
            raise RuntimeError("stopped here")
        real(lake, old, new)

    monkeypatch.setattr(writes, "rename_table", rename)
    with pytest.raises(RuntimeError):
        lifecycle.move_table(lake, "a.b.s", "a.b.t", overwrite=True)
    assert (lake.table("a.b.t").count(), lake.table("a.b.s").count()) == (9, 3)


def test_a_replaced_view_keeps_tags_and_wiki(lake):
    numbers(lake, "a.b.t", 1)
    views.create_view(lake, "a.b.t", "a.b.v")
    lake.set_tags("a.b.v", ["x"])
    lake.set_wiki("a.b.v", "words")
    views.create_view(lake, "a.b.t", "a.b.v", overwrite=True)
    assert (lake.tags("a.b.v"), lake.wiki("a.b.v")) == (["x"], "words")


def test_the_whole_column_decides(lake, tmp_path):
    rows = [f"POINT ({i} 1)" for i in range(60)] + ['{"type": "Point", "coordinates": [1, 2]}'] * 40
    df = lake.spark.createDataFrame([(r,) for r in rows], "geom string")
    profile = spatial.spatial_profile(df).first()
    assert (profile["rows"], profile["wkt"], profile["geojson"], profile["decoded"]) == (100, 60, 40, None)
    assert spatial.spatial_plan(df) is None


def test_unknown_systems_are_refused_before_writing(lake, tmp_path):
    df = lake.spark.createDataFrame([("POINT (1 2)", 31467), ("POINT (1 2)", 4326)], "geom string, srid int")
    writes.create_table(lake, df, "g.a.p")
    with pytest.raises(LakeError, match="31467: 1 row"):
        spatial.export_layers(lake, "g", str(tmp_path / "out"))
