import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.operators import ingest as ing
from lakewright.operators import writes
from lakewright.streaming.incremental import incremental_ingest


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "in"
    (where / "sub").mkdir(parents=True)
    pq.write_table(pa.table({"id": [1, 2], "name": ["a", "b"]}), where / "a.parquet")
    pq.write_table(pa.table({"id": [3], "name": ["c"]}), where / "sub" / "b.parquet")
    (where / "readme.txt").write_text("not data")
    return str(where)


def _ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_create_append_replace_fail(lake, folder):
    report = ing.ingest(lake, folder, "m.a.t", "parquet").first()
    assert tuple(report) == ("m.a.t", "create", 3, 2)
    assert ing.ingest(lake, folder, "m.a.t", "parquet", conflict_mode="append").first()["action"] == "append"
    assert _ids(lake.table("m.a.t")) == [1, 1, 2, 2, 3, 3]
    assert ing.ingest(lake, folder, "m.a.t", "parquet", conflict_mode="replace").first()["action"] == "replace"
    assert _ids(lake.table("m.a.t")) == [1, 2, 3]
    with pytest.raises(LakeError, match="already exists"):
        ing.ingest(lake, folder, "m.a.t", "parquet")


def test_no_files(lake, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n")
    with pytest.raises(LakeError, match="no parquet files found"):
        ing.ingest(lake, str(tmp_path), "m.a.t", "parquet")


def test_read_only_leaves_the_files(lake, folder):
    ing.ingest(lake, folder, "m.a.t", "parquet", intent="read_only")
    assert lake.kind("m.a.t") == "VIEW"
    assert _ids(lake.table("m.a.t")) == [1, 2, 3]
    assert lake.kind("m.a.t__files") == "TABLE"


def test_definition(lake, folder):
    definition = ing.TableDefinition(columns=[("ID", "BIGINT")], partition_by=["name"], sort_by=["ID"])
    ing.ingest(lake, folder, "m.a.t", "parquet", definition=definition)
    assert lake.partition_columns("m.a.t") == ["name"]
    wrong = ing.TableDefinition(columns=[("id", "INT"), ("gone", "DATE")])
    with pytest.raises(LakeError) as caught:
        ing.ingest(lake, folder, "m.a.u", "parquet", definition=wrong)
    assert "id: given INT, the files have BIGINT; gone: not in the files" in str(caught.value)


def test_plan_writes_nothing(lake, folder):
    plan = {r["name"]: r["ok"] for r in ing.ingest_plan(lake, folder, "m.a.t", "parquet").collect()}
    assert plan == {"files": True, "file sizes": None, "target": True}
    assert lake.entries() == []


def test_slices(lake, folder):
    assert ing.slice_name(" Q1 2026 ") == "q1_2026"
    ing.ingest_slice(lake, folder, "m.a.t", "parquet", "Q1 2026")
    ing.ingest_slice(lake, folder, "m.a.t", "parquet", "Q2 2026")
    with pytest.raises(LakeError, match="already exists"):
        ing.ingest_slice(lake, folder, "m.a.t", "parquet", "q1-2026")
    report = ing.ingest_slice(lake, folder, "m.a.t", "parquet", "q1-2026", conflict_mode="replace").first()
    assert tuple(report) == ("m.a.t", "replace", 3, 2)
    counts = {r[0]: r[1] for r in lake.table("m.a.t").groupBy("sub_path").count().collect()}
    assert counts == {"q1_2026": 3, "q2_2026": 3}


def test_batch_stops_at_the_first_failure(lake, folder):
    jobs = [{"folder": folder, "table": t, "fmt": "parquet"} for t in ("m.a.t", "m.a.t", "m.a.u")]
    rows = ing.ingest_batch(lake, jobs).collect()
    assert [r["action"] for r in rows] == ["create", "failed", "not started"]
    assert "already exists" in rows[1]["note"]


def test_a_failed_replace_keeps_the_table(lake, folder, spark):
    ing.ingest(lake, folder, "m.a.t", "parquet")
    bad = lake.table("m.a.t").withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        writes.replace_table(lake, bad, "m.a.t")
    assert _ids(lake.table("m.a.t")) == [1, 2, 3]
    assert [p for p, _ in lake.entries()] == ["m.a.t"]


def test_a_table_may_be_replaced_by_itself(lake, folder):
    ing.ingest(lake, folder, "m.a.t", "parquet")
    writes.replace_table(lake, lake.table("m.a.t").filter("id > 1"), "m.a.t")
    assert _ids(lake.table("m.a.t")) == [2, 3]


def test_a_half_done_switch_is_undone(lake, folder, spark):
    ing.ingest(lake, folder, "m.a.t", "parquet")
    ident = lake.ident("m.a.t")
    spark.sql(f"ALTER TABLE {ident.sql} RENAME TO `{ident.database}`.`{ident.table}{writes.OLD}`")
    assert lake.kind("m.a.t") is None
    writes.recover(lake, "m.a.t")
    assert _ids(lake.table("m.a.t")) == [1, 2, 3]


def test_every_file_is_loaded_once(lake, folder, tmp_path, spark):
    schema = spark.read.parquet(f"{folder}/a.parquet").schema
    args = (lake, folder, "m.a.t", "parquet", schema, str(tmp_path / "checkpoint"))
    assert _ids(incremental_ingest(*args)) == [1, 2, 3]
    assert _ids(incremental_ingest(*args)) == [1, 2, 3]
    pq.write_table(pa.table({"id": [4], "name": ["d"]}), f"{folder}/c.parquet")
    assert _ids(incremental_ingest(*args, max_files_per_batch=1)) == [1, 2, 3, 4]
    assert _ids(lake.table("m.a.t")) == [1, 2, 3, 4]


def test_unloaded_files(frame):
    listing, ledger = frame(["a", "b"], "rel_path string"), frame(["a"], "rel_path string")
    assert [r[0] for r in ing.unloaded_files(listing, ledger).collect()] == ["b"]
