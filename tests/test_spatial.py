import json
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.errors import LakeError
from lakewright.functions import geocodec, geometry
from lakewright.functions.projection import project_arrays
from lakewright.operators import spatial


def _decode(value, encoding):
    kind = pa.binary() if encoding == "wkb" else pa.string()
    wkb, srids = geocodec.decode_batch(pa.array([value], kind), encoding)
    return wkb[0].as_py(), int(srids[0])


POINT = struct.pack("<BIdd", 1, 1, 1.0, 2.0)


@pytest.mark.parametrize(
    ("value", "encoding", "wkb", "srid"),
    [
        ("POINT (1 2)", "wkt", POINT, 0),
        (" point(1.0 2e0) ", "wkt", POINT, 0),
        ("SRID=3035;POINT (1 2)", "wkt", POINT, 3035),
        ("POINT Z (1 2 3)", "wkt", struct.pack("<BIddd", 1, 1001, 1, 2, 3), 0),
        ("POINT (1 2 3)", "wkt", struct.pack("<BIddd", 1, 1001, 1, 2, 3), 0),
        ("POINT M (1 2 9)", "wkt", POINT, 0),
        ("LINEARRING (0 0, 1 0, 1 1, 0 0)", "wkt", struct.pack("<BII8d", 1, 2, 4, 0, 0, 1, 0, 1, 1, 0, 0), 0),
        ("MULTIPOINT ((1 2), (1 2))", "wkt", struct.pack("<BII", 1, 4, 2) + POINT * 2, 0),
        ("MULTIPOINT (1 2, 1 2)", "wkt", struct.pack("<BII", 1, 4, 2) + POINT * 2, 0),
        ("GEOMETRYCOLLECTION (POINT (1 2), LINESTRING EMPTY)", "wkt", struct.pack("<BII", 1, 7, 2) + POINT + struct.pack("<BII", 1, 2, 0), 0),
        ('{"type":"Point","coordinates":[1,2]}', "geojson", POINT, 0),
        ('{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]}}', "geojson", POINT, 0),
        (POINT, "wkb", POINT, 0),
        (struct.pack(">BIdd", 0, 1, 1.0, 2.0), "wkb", POINT, 0),
        (struct.pack("<BIIdd", 1, 1 | 0x20000000, 4326, 1.0, 2.0), "wkb", POINT, 4326),
        (struct.pack("<BIddd", 1, 1 | 0x80000000, 1, 2, 3), "wkb", struct.pack("<BIddd", 1, 1001, 1, 2, 3), 0),
        (POINT.hex().upper(), "hexwkb", POINT, 0),
    ],
)
def test_decoding(value, encoding, wkb, srid):
    assert _decode(value, encoding) == (wkb, srid)


@pytest.mark.parametrize(
    ("value", "encoding"),
    [
        ("POINT (1)", "wkt"), ("POINT (1 2) x", "wkt"), ("POINT (1 2, 3 4)", "wkt"), ("LINESTRING (1 2)", "wkt"),
        ("POLYGON ((0 0, 1 0, 1 1, 0 1))", "wkt"), ("nonsense", "wkt"), ('{"type":"Point"}', "geojson"),
        ('{"type":"point","coordinates":[1,2]}', "geojson"), ("[1]", "geojson"), (POINT[:-1], "wkb"),
        (POINT + b"x", "wkb"), (b"", "wkb"), ("DEADBEEF", "hexwkb"), (struct.pack("<BII", 1, 2, 2**31), "wkb"),
    ],
)
def test_what_does_not_decode(value, encoding):
    assert _decode(value, encoding)[0] is None


def test_mixed_batches_keep_their_order():
    texts = ["POINT (1 2)", None, "LINESTRING (0 0, 4 8)", "POINT EMPTY", "bad", "SRID=4326;POINT (5 6)"]
    wkb, srids = geocodec.decode_batch(pa.array(texts), "wkt")
    assert [w.as_py() is None for w in wkb] == [False, True, False, False, True, False]
    assert srids.tolist() == [0, 0, 0, 0, 0, 4326]
    rows = geocodec.summary_batch(wkb.slice(0)).to_pylist()
    assert rows[2]["type"] == "LINESTRING" and rows[2]["max_y"] == 8.0
    assert rows[3]["empty"] and rows[3]["min_x"] is None and rows[1] is None
    # A slice of an array shares its buffers.
    assert geocodec.summary_batch(wkb.slice(5)).to_pylist()[0]["max_x"] == 5.0


def test_reprojection():
    x, y = project_arrays(np.array([10.0]), np.array([52.0]), 4326, 3035)
    assert abs(x[0] - 4321000) < 0.01 and abs(y[0] - 3210000) < 0.01
    lon, lat = np.meshgrid(np.linspace(-30, 60, 50), np.linspace(30, 75, 50))
    lon, lat = lon.ravel(), lat.ravel()
    for code in (3035, 3857):
        back = project_arrays(*project_arrays(lon, lat, 4326, code), code, 4326)
        assert np.abs(back[0] - lon).max() < 1e-8 and np.abs(back[1] - lat).max() < 1e-8
    assert project_arrays(lon, lat, 4258, 4326)[0] is lon
    with pytest.raises(ValueError, match="EPSG:9999"):
        project_arrays(lon, lat, 9999, 3035)


def test_z_is_kept_and_unknown_crs_stays():
    wkb, _ = geocodec.decode_batch(pa.array(["LINESTRING Z (10 52 7, 11 53 8)", "POINT (10 52)", "POINT (10 52)"]), "wkt")
    out = geocodec.transform_batch(wkb, np.array([4326, 4326, 0]), 3035, project_arrays)
    line = np.frombuffer(out[0].as_py(), "<f8", 6, 9).reshape(2, 3)
    assert abs(line[0, 0] - 4321000) < 0.01 and line[:, 2].tolist() == [7, 8]
    assert out[1] != wkb[1] and out[2] == wkb[2]


def test_export_binary():
    wkb, _ = geocodec.decode_batch(pa.array(["POLYGON ((1 2, 3 2, 3 4, 1 4, 1 2))", "POINT EMPTY", "POINT (1 2)", None]), "wkt")
    box, empty, point, none = geocodec.gpkg_batch(wkb, 3035).to_pylist()
    assert box[:8] == b"GP\x00\x03" + struct.pack("<i", 3035)
    assert struct.unpack("<4d", box[8:40]) == (1, 3, 2, 4) and box[40:] == wkb[0].as_py()
    assert empty[:4] == b"GP\x00\x11" and empty[8:] == wkb[1].as_py()
    assert struct.unpack("<4d", point[8:40]) == (1, 1, 2, 2) and none is None


@pytest.mark.parametrize(
    ("value", "code"),
    [
        ("3035", 3035), (" 3035 ", 3035), ("EPSG:3035", 3035), ("epsg:3035", 3035), ("urn:ogc:def:crs:EPSG::3035", 3035),
        ("urn:ogc:def:crs:EPSG:9.8:3035", 3035), ("ETRS89-extended / LAEA Europe", 3035), ("WGS 84", 4326),
        (None, 0), ("", 0), ("nonsense", 0), ("-1", 0), ("99999999999", 0),
    ],
)
def test_epsg_text(frame, value, code):
    df = frame([(value,)], "v string")
    assert df.select(geometry.epsg_code(F.col("v"), T.StringType())).first()[0] == code


def test_encodings(frame):
    texts = {"POINT(1 2)": "wkt", " srid=1;LineString(0 0,1 1)": "wkt", "POINTS": None, '{"type": 1}': "geojson",
             POINT.hex(): "hexwkb", "DEADBEEF": None, "abc": None}
    df = frame(list(texts), "v string").select("v", geometry.encoding_of(F.col("v"), T.StringType()))
    assert {r[0]: r[1] for r in df.collect()} == texts


@pytest.mark.parametrize(
    ("columns", "expected"),
    [
        ("'POINT(1 2)' AS anything, 3035 AS srid", ("geometry", "anything", "wkt", "srid")),
        ("'POINT(1 2)' AS a, 'POINT(1 2)' AS The_Geom", ("geometry", "The_Geom", "wkt", None)),
        ("unhex('{hex}') AS shape", ("geometry", "shape", "wkb", None)),
        ("1.5 AS LAT, 2 AS lng", ("latlon", None, None, None)),
        ("'1.5' AS lat, '2' AS lon", None),
        ("if(id = 1, 'bad', 'POINT(1 2)') AS geom", None),
        ("'DEADBEEF' AS geom", None),
        ("id AS code, 'x' AS label", None),
    ],
)
def test_plans(spark, columns, expected):
    df = spark.range(3).selectExpr("id", *[c for c in columns.replace("{hex}", POINT.hex()).split(", ") if "if(" not in columns] or [columns])
    plan = spatial.spatial_plan(df)
    assert (plan and (plan.kind, plan.geometry_column, plan.encoding, plan.crs_column)) == expected


def test_row_crs(frame):
    df = frame([("SRID=3035;POINT(1 2)", "4326"), ("POINT(1 2)", "EPSG:3857"), ("POINT(1 2)", None)], "geom string, crs string")
    out = spatial.with_geometry(df, spatial.spatial_plan(df))
    assert [r["__srid"] for r in out.collect()] == [3035, 3857, 0]
    assert [r[0] for r in spatial.row_srids(df, spatial.spatial_plan(df)).collect()] == [3035, 3857, 0]


def test_export(lake, spark, tmp_path):
    from lakewright.operators.writes import create_table

    stations = spark.createDataFrame(
        [(1, "SRID=4326;POINT (10 52)", "a"), (2, None, "b")], "fid int, geom string, geometry string"
    )
    create_table(lake, stations, "geo.a.stations")
    create_table(lake, spark.range(3).withColumnRenamed("id", "code"), "geo.b.codes")
    create_table(lake, spark.range(0).selectExpr("id", "'x' AS name"), "geo.b.empty")
    report = {r["layer"]: r for r in spatial.export_layers(lake, "geo", str(tmp_path / "out"), srid=3035).collect()}
    layer = report["stations"]
    assert (layer["data_type"], layer["rows"], layer["geometry_type"], layer["srs_id"]) == ("features", 2, "POINT", 3035)
    assert abs(layer["max_x"] - 4321000) < 0.01
    written = spark.read.parquet(layer["location"])
    assert written.columns == ["fid_src", "geometry", "geom"]
    assert (report["codes"]["data_type"], report["empty"]["notes"]) == ("attributes", "no rows")
    assert spatial.open_export(spark, str(tmp_path / "out"))["contents"].count() == 3
    with pytest.raises(LakeError, match="already holds"):
        spatial.export_layers(lake, "geo", str(tmp_path / "out"), overwrite=False)
    for bad in ({"limit": True}, {"limit": 0}, {"srid": 9999}, {"tables": ["none"]}):
        with pytest.raises(LakeError):
            spatial.export_layers(lake, "geo", str(tmp_path / "other"), **bad)


def _seen(spark, out):
    """The target system and the rows of all layers, as a reader finds them now."""
    tables = spatial.open_export(spark, out)
    rows = tables["contents"].collect()
    assert {r.layer for r in tables["geometry_columns"].collect()} == {r.layer for r in rows if r.data_type == "features"}
    return {r.srs_id for r in rows if r.srs_id}, {r.layer: spark.read.parquet(r.location).count() for r in rows}


def test_readers_see_a_whole_export_at_every_step(lake, spark, tmp_path, monkeypatch):
    from lakewright.operators.writes import create_table
    from lakewright.sources.store import Store

    out = str(tmp_path / "out")
    create_table(lake, spark.createDataFrame([("SRID=4326;POINT (10 52)",)], "geom string"), "geo.contents")
    create_table(lake, spark.range(3), "geo.codes")
    with pytest.raises(LakeError, match="no export"):
        spatial.open_export(spark, out)
    spatial.export_layers(lake, "geo", out, srid=3035)
    first = ({3035}, {"contents": 1, "codes": 3})
    assert _seen(spark, out) == first
    seen, real, written = [], Store.write, spatial._export_layer

    def layer(*args):
        found = written(*args)
        seen.append(_seen(spark, out))
        return found

    def write(self, path, text):
        seen.append(_seen(spark, out))
        real(self, path, text)
        seen.append(_seen(spark, out))

    monkeypatch.setattr(spatial, "_export_layer", layer)
    monkeypatch.setattr(Store, "write", write)
    spatial.export_layers(lake, "geo", out, srid=25832)
    assert seen[:-1] == [first] * 3 and seen[-1] == ({25832}, {"contents": 1, "codes": 3})
    # A failed export changes nothing and leaves nothing; the run before stays until the next.
    runs = {p.name for p in (tmp_path / "out").glob("run-*")}
    create_table(lake, spark.createDataFrame([("SRID=9999;POINT (1 2)",)], "geom string"), "geo.wrong")
    with pytest.raises(LakeError, match="9999"):
        spatial.export_layers(lake, "geo", out, srid=3035)
    assert _seen(spark, out) == seen[-1] and {p.name for p in (tmp_path / "out").glob("run-*")} == runs and len(runs) == 2
    spark.sql(f"DROP TABLE {lake.sql_name('geo.wrong')}")
    spatial.export_layers(lake, "geo", out)
    assert len(list((tmp_path / "out").glob("run-*"))) == 2


def test_export_values(spark):
    df = spark.sql(
        "SELECT 1 AS FID, CAST(1.5 AS DECIMAL(5,2)) AS d, DATE'2026-01-01' AS day, TIMESTAMP'2026-01-01 12:00:00+00:00' AS t, "
        "named_struct('a', 1) AS s, array(1) AS l, INTERVAL 1 DAY AS i, true AS b"
    )
    row = spatial.export_values(df).first()
    assert row["FID_src"] == 1 and row["d"] == 1.5 and row["day"] == "2026-01-01"
    assert row["t"] == "2026-01-01T12:00:00.000Z" and json.loads(row["s"]) == {"a": 1}
    assert [t for _, t in spatial.export_columns(df)] == [
        "MEDIUMINT", "DOUBLE", "DATE", "DATETIME", "TEXT", "TEXT", "TEXT", "BOOLEAN",
    ]


def test_a_layer_takes_one_python_process_a_task(frame):
    """Text with a CRS column, and coordinates: decoded, moved, summed up and packed in one go."""
    df = frame([(1, "SRID=4326;POINT (10 50)", 4326), (2, "POINT (10 50)", 25832), (3, None, 4326)], "k int, wkt string, srid int")
    places = frame([(1, 50.0, 10.0), (2, None, 10.0)], "k int, lat double, lon double")
    for table, there in ((df, [True, True, False]), (places, [True, False])):
        out = spatial.feature_layer(table, spatial.spatial_plan(table), 3857)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        assert [r.geom is not None for r in out.orderBy("k").collect()] == there
