"""Views over files in place give the rows that a load gives."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.operators import ingest as ing
from lakewright.sources.typing import given_sql, literal, parse_as, parse_sql


def write(folder, **texts):
    for name, text in texts.items():
        path = folder / name.replace("__", "/").replace("_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(folder)


def both(lake, folder, fmt, **more):
    """The rows of a view, which must be those of a load."""
    ing.ingest(lake, folder, "l.view", fmt, intent="read_only", **more)
    ing.ingest(lake, folder, "l.load", fmt, **more)
    view, load = lake.table("l.view"), lake.table("l.load")
    assert lake.kind("l.view") == "VIEW" and view.dtypes == load.dtypes
    assert sorted(map(str, view.collect())) == sorted(map(str, load.collect()))
    return view


def test_csv(lake, tmp_path):
    folder = write(tmp_path / "in", a_csv="id,when,what,ok\n1,2024-01-02,x,true\nNA,,'y',false\n", s__b_csv="id,when,what,ok\n7,2024-01-03 10:00:00,\\z,1\n")
    assert both(lake, folder, "csv").count() == 3


def test_csv_with_other_headers(lake, tmp_path):
    folder = write(tmp_path / "in", a_csv="id,name\n1,a\n", **{"s__b,c_csv": "name,more,id\nb,1.5,x\n"})
    view = both(lake, folder, "csv")
    assert sorted(map(tuple, view.select("id", "name", "more").collect())) == [("1", "a", None), ("x", "b", 1.5)]


def test_csv_definition_and_no_header(lake, tmp_path):
    folder = write(tmp_path / "in", a_csv="007;12345678901234567.89\n8;\n")
    definition = ing.TableDefinition([("f1", "DECIMAL(20,2)"), ("f0", "VARCHAR")])
    view = both(lake, folder, "csv", csv=ing.CsvOptions(delimiter=";", header=False), definition=definition)
    assert [(str(r.f1), r.f0) for r in view.orderBy("f0").collect()] == [("12345678901234567.89", "007"), ("None", "8")]


def test_ragged_rows_fail_the_query(lake, tmp_path):
    ing.ingest(lake, write(tmp_path / "in", a_csv="a,b\n1,2\n3,4,5\n"), "l.v", "csv", intent="read_only")
    with pytest.raises(Exception, match="more or fewer cells"):
        lake.table("l.v").collect()


def test_json(lake, tmp_path):
    folder = write(tmp_path / "in", a_json='{"id": 1, "at": "2024-01-02T10:00:00", "v": 1}\n{"id": 2, "more": true}\n', b_ndjson='{"v": 1.5, "id": 3}\n')
    assert both(lake, folder, "json").count() == 3
    definition = ing.TableDefinition([("id", "VARCHAR"), ("v", "DECIMAL(10,1)")])
    ing.ingest(lake, folder, "l.w", "json", intent="read_only", definition=definition)
    assert dict(lake.table("l.w").dtypes)["v"] == "decimal(10,1)"


def test_parquet_of_several_schemas(lake, tmp_path):
    folder = tmp_path / "in"
    (folder / "s").mkdir(parents=True)
    pq.write_table(pa.table({"id": pa.array([1, 2], pa.int32()), "name": ["a", "b"]}), folder / "a.parquet")
    pq.write_table(pa.table({"id": pa.array([3], pa.int64()), "more": [1.5]}), folder / "b.parquet")
    pq.write_table(pa.table({"id": ["x"], "name": ["c"]}), folder / "s" / "c.parquet")
    assert both(lake, str(folder), "parquet").count() == 4
    assert [p for p, k in lake.entries("l") if k == "TABLE" and "__files" in p] == ["l.view__files", "l.view__files1", "l.view__files2"]
    # The files are read in place: replacing registers them anew.
    (folder / "b.parquet").unlink()
    report = ing.ingest(lake, str(folder), "l.view", "parquet", intent="read_only", conflict_mode="replace").first()
    assert (report["action"], report["rows"]) == ("replace", 3) and lake.table("l.view").count() == 3
    assert len([p for p, k in lake.entries("l") if k == "TABLE" and "__files" in p]) == 2


def test_too_many_files_to_list(lake, tmp_path, monkeypatch):
    monkeypatch.setattr(ing, "LISTED", 10)
    folder = write(tmp_path / "in", a_csv="id\n1\n", b_csv="name\nx\n")
    with pytest.raises(LakeError, match="editable"):
        ing.ingest(lake, folder, "l.v", "csv", intent="read_only")
    assert lake.kind("l.v") is None


@pytest.mark.parametrize("kind", ["BIGINT", "INT", "BOOLEAN", "DATE", "TIMESTAMP", "DOUBLE", "FLOAT", "VARCHAR"])
def test_sql_and_columns_agree(spark, kind):
    texts = ["1", " 2 ", "-3", "true", "FALSE", "0", "2024-02-30", "2024-02-28", "2024-02-28 10:00:00", "2024-02-28T10:00Z", "1e5", ".5", "inf", "NaN", "null", "", "it's \\ x", "99999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(parse_as(F.col("t"), kind).alias("a"), F.expr(parse_sql("t", kind)).alias("b")).collect()
    assert [str(r.a) for r in rows] == [str(r.b) for r in rows]


def test_literals(spark):
    odd = "it's a \\ back\\\\slash \"quoted\" `x`"
    assert spark.sql(f"SELECT {literal(odd)} AS t").first().t == odd
    assert spark.sql(f"SELECT {given_sql(literal('5'), 'decimal(5,1)')} AS t").first().t == 5
