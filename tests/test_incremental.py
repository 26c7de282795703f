"""Incremental loads into ordinary tables: stopped at any step, they load each file once."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from lakewright.errors import LakeError
from lakewright.operators import views, writes
from lakewright.sources.store import Store
from lakewright.streaming import incremental
from lakewright.streaming.incremental import incremental_ingest, loaded_batches

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("place", T.StringType())])


def rows(n, place="a", start=0):
    return "".join(f'{{"k": {i}, "place": "{place}"}}\n' for i in range(start, start + n))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for i, place in enumerate("abc"):
        (path / f"{i}.json").write_text(rows(2, place, 2 * i))
    return path


@pytest.fixture
def load(lake, folder, tmp_path):
    return lake, str(folder), "l.t", "json", SCHEMA, str(tmp_path / "log")


def keys(df):
    return sorted(r.k for r in df.collect())


def owned(lake, by=None):
    writes.create_table(lake, lake.spark.createDataFrame([(100, "z", 1.5)], "k int, place string, more double"), "l.t", by)


def stopped(monkeypatch, what, name, after=0):
    """``what.name`` fails once, after so many calls."""
    real, calls = getattr(what, name), []

    def one(*args, **more):
        calls.append(1)
        if len(calls) == after + 1:
            raise RuntimeError("stopped here")
        return real(*args, **more)

    monkeypatch.setattr(what, name, one)


@pytest.mark.parametrize("by", [None, ["place"]])
def test_an_owned_table_keeps_its_rows_and_types(lake, load, by):
    owned(lake, by)
    found = incremental_ingest(*load)
    assert keys(found) == [0, 1, 2, 3, 4, 5, 100]
    assert dict(found.dtypes) == {"k": "int", "place": "string", "more": "double"}
    assert keys(lake.table("l.t").where("place = 'b'")) == [2, 3]
    assert found.where("more is null").count() == 6


@pytest.mark.parametrize("by", [None, ["place"]])
@pytest.mark.parametrize(
    ("what", "name", "after"),
    [(Store, "write", 1), (Store, "move", 0), (Store, "move", 1), (incremental.Ledger, "add", 0), (Store, "drop", 0)],
    ids=["before the list", "before a rename", "between renames", "before the ledger", "after the ledger"],
)
def test_a_stopped_load_goes_on(lake, load, monkeypatch, what, name, after, by):
    owned(lake, by)
    incremental.Ledger(lake, load[-1]).stream(load[1], load[2])
    stopped(monkeypatch, what, name, after - (what is Store and name == "write"))
    with pytest.raises(Exception, match="stopped here"):
        incremental_ingest(*load, max_files_per_batch=2)
    writes.append_table(lake, lake.spark.createDataFrame([(200, "y")], "k int, place string"), "l.t")
    assert keys(incremental_ingest(*load, max_files_per_batch=2)) == [0, 1, 2, 3, 4, 5, 100, 200]
    assert keys(incremental_ingest(*load)) == [0, 1, 2, 3, 4, 5, 100, 200]
    assert [r.batch for r in loaded_batches(lake, load[-1]).orderBy("batch").collect()] == [0, 1]
    assert not [p for p in Store(lake.spark).files(incremental._location(lake, "l.t")) if "loads" in p]


def test_a_replaced_table_gets_the_whole_batch(lake, load, monkeypatch):
    owned(lake)
    stopped(monkeypatch, Store, "move", 1)
    with pytest.raises(Exception, match="stopped here"):
        incremental_ingest(*load)
    writes.replace_table(lake, lake.spark.createDataFrame([(300, "x")], "k long, place string"), "l.t")
    assert keys(incremental_ingest(*load)) == [0, 1, 2, 3, 4, 5, 300]


def test_refused_before_anything_is_loaded(lake, load, folder, tmp_path):
    writes.create_table(lake, lake.spark.createDataFrame([(1,)], "k long"), "l.t")
    with pytest.raises(LakeError, match="place"):
        incremental_ingest(*load)
    views.create_view_as(lake, "l.v", "SELECT 1 AS k")
    with pytest.raises(LakeError, match="view"):
        incremental_ingest(lake, str(folder), "l.v", "json", SCHEMA, str(tmp_path / "other"))
    incremental_ingest(lake, str(folder), "l.u", "json", SCHEMA, load[-1])
    with pytest.raises(LakeError, match="belongs to"):
        incremental_ingest(lake, str(folder), "l.w", "json", SCHEMA, load[-1])
    assert keys(lake.table("l.t")) == [1]


def test_a_bad_value_leaves_the_table(lake, load):
    writes.create_table(lake, lake.spark.createDataFrame([(True, 7)], "k boolean, place int"), "l.t")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        incremental_ingest(*load)
    assert lake.table("l.t").count() == 1


def test_no_ledger_yet(lake, tmp_path):
    assert loaded_batches(lake, str(tmp_path / "none")).collect() == []


def test_store(spark, tmp_path):
    store, top = Store(spark), str(tmp_path)
    assert store.read(f"{top}/a") is None and store.files(f"{top}/none") == []
    store.write(f"{top}/d/a", "one é")
    store.write(f"{top}/d/a", "two")
    store.write(f"{top}/d/_hidden/b", "three")
    assert store.read(f"{top}/d/a") == "two" and store.files(top) == ["d/a"]
    store.move(f"{top}/d/a", f"{top}/e/f/a")
    store.move(f"{top}/d/a", f"{top}/e/f/a")
    assert store.files(top) == ["e/f/a"]
    with pytest.raises(OSError):
        store.move(f"{top}/d/a", f"{top}/e/f/b")
    store.drop(f"{top}/e")
    assert not store.exists(f"{top}/e/f/a")
