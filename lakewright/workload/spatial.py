"""Spatial queries over points and polygons derived from the customers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import geometry
from lakewright.functions.projection import SUPPORTED, SYSTEMS, project_frame
from lakewright.operators import spatial
from lakewright.operators.writes import create_table
from lakewright.session import scratch
from lakewright.workload.ingest import new_lake
from lakewright.workload.inputs import read

_CRS = ("3857", "EPSG:4326", "urn:ogc:def:crs:EPSG::3035", None, "nonsense")


def geo(spark, sf):
    """One place per customer in every encoding, and a CRS column of all spellings."""
    k = F.col("c_custkey")
    lon, lat = (k % 360 - 180).cast("double"), (k % 170 - 85).cast("double")
    x, y = lon.cast("int").cast("string"), lat.cast("int").cast("string")
    wkt = F.concat(F.lit("POINT ("), x, F.lit(" "), y, F.lit(")"))
    box = F.concat(
        F.lit("POLYGON (("), x, F.lit(" "), y, F.lit(", "), (k % 360 - 179).cast("string"), F.lit(" "), y, F.lit(", "),
        (k % 360 - 179).cast("string"), F.lit(" "), (k % 170 - 83).cast("string"), F.lit(", "), x, F.lit(" "), y, F.lit("))"),
    )
    json = F.concat(F.lit('{"type": "Point", "coordinates": ['), x, F.lit(", "), y, F.lit("]}"))
    crs = F.element_at(F.array(*[F.lit(c) for c in _CRS]), (k % 5 + 1).cast("int"))
    return read(spark, sf, "customer").select(
        k.alias("k"), lon.alias("lon"), lat.alias("lat"), wkt.alias("wkt"), box.alias("box"), json.alias("json"),
        F.concat(F.lit("SRID="), F.when(k % 3 == 0, "4326").otherwise("3857"), F.lit(";"), wkt).alias("ewkt"),
        F.when(k % 4 == 0, wkt).when(k % 4 == 1, F.concat(F.lit("srid=4258; "), wkt)).when(k % 4 == 2, json)
        .otherwise(F.concat(F.lit("POINTLESS "), "c_name")).alias("mixed"),
        crs.alias("crs"), "c_mktsegment", "c_acctbal",
    )


GEO = """
geo AS (
  SELECT c_custkey AS k, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(c_custkey % 170 - 85 AS DOUBLE) AS lat,
    ['3857', 'EPSG:4326', 'urn:ogc:def:crs:EPSG::3035', NULL, 'nonsense'][1 + c_custkey % 5] AS crs,
    [3857, 4326, 3035, 0, 0][1 + c_custkey % 5] AS code, c_mktsegment, c_acctbal FROM customer)"""


def q_geometry_encoding(spark, sf):
    text = T.StringType()
    hexed = F.hex(F.concat(F.unhex(F.lit("01010000000000000000000000")), F.lit("        ").cast("binary")))
    return geo(spark, sf).select(
        "k",
        geometry.encoding_of(F.col("mixed"), text).alias("mixed"),
        geometry.encoding_of(F.col("box"), text).alias("box"),
        geometry.encoding_of(hexed, text).alias("hexed"),
        geometry.encoding_of(F.col("c_mktsegment"), text).alias("plain"),
        geometry.encoding_of(F.col("c_mktsegment").cast("binary"), T.BinaryType()).alias("bytes"),
    )


def q_decode_wkt_points(spark, sf):
    point = geometry.wkt_point(F.col("mixed"))
    return geo(spark, sf).select("k", point["x"].alias("x"), point["y"].alias("y"), point["srid"].cast("long").alias("srid"))


def q_decode_geojson_points(spark, sf):
    point = geometry.geojson_point(F.col("json"))
    return geo(spark, sf).select("k", point["x"].alias("x"), point["y"].alias("y"))


def _read_back(df, column, encoding):
    """Decode to WKB and read the bytes again, so both ways are checked."""
    decoded = df.withColumn("d", geometry.decode_geometry(F.col(column), encoding))
    seen = decoded.withColumn("s", geometry.geometry_summary(F.col("d.wkb")))
    return seen.select(
        "k", F.col("s.type").alias("type"), F.col("s.min_x").alias("min_x"), F.col("s.min_y").alias("min_y"),
        F.col("s.max_x").alias("max_x"), F.col("s.max_y").alias("max_y"),
        F.col("d.srid").cast("long").alias("srid"), F.length("d.wkb").cast("long").alias("bytes"),
    )


def q_decode_geometry_wkt(spark, sf):
    return _read_back(geo(spark, sf), "ewkt", "wkt")


def q_decode_geometry_polygons(spark, sf):
    return _read_back(geo(spark, sf), "box", "wkt")


def q_decode_geometry_geojson(spark, sf):
    return _read_back(geo(spark, sf), "json", "geojson")


def q_decode_geometry_wkb(spark, sf):
    df = geo(spark, sf).withColumn("d", geometry.decode_geometry(F.col("box"), "wkt"))
    # Every second value is cut short and must not decode; one byte order is
    # swapped for hex text.
    short = F.when(F.col("k") % 2 == 0, F.hex(F.col("d.wkb"))).otherwise(F.hex(F.substring(F.col("d.wkb"), 1, 40)))
    return _read_back(df.withColumn("h", short).drop("d"), "h", "hexwkb")


def q_latlon_points(spark, sf):
    df = geo(spark, sf).withColumn("lat", F.when(F.col("k") % 7 != 0, F.col("lat")))
    out = spatial.latlon_points(df, "lat", "lon").withColumn("s", geometry.geometry_summary(F.col("wkb")))
    return out.select("k", F.col("s.min_x").alias("x"), F.col("s.min_y").alias("y"), F.col("srid").cast("long").alias("srid"))


def q_epsg_codes(spark, sf):
    text = T.StringType()
    return geo(spark, sf).select(
        "k",
        geometry.epsg_code(F.col("crs"), text).cast("long").alias("crs"),
        geometry.epsg_code(F.lit(" etrs89-extended / LAEA Europe "), text).cast("long").alias("name"),
        geometry.epsg_code(F.col("k") - 5, T.LongType()).cast("long").alias("whole"),
        geometry.epsg_code(F.col("k") / 2, T.DoubleType()).cast("long").alias("half"),
        geometry.epsg_code(F.col("k") > 3, T.BooleanType()).cast("long").alias("truth"),
    )


def q_row_srid(spark, sf):
    df = geo(spark, sf).withColumn(
        "geom", F.when(F.col("k") % 2 == 0, F.col("ewkt")).otherwise(F.col("wkt"))
    ).select("k", "geom", "crs")
    plan = spatial.SpatialPlan("geometry", "geom", "wkt", crs_column="crs")
    # The quick way, without decoding, must find the same codes.
    quick = spatial.srid_column(df, plan)
    full = spatial.with_geometry(df.withColumn("quick", quick), plan)
    return full.select("k", F.col("__srid").cast("long").alias("srid"), (F.col("__srid") == F.col("quick")).alias("same"))


def q_layer_srid(spark, sf):
    df = geo(spark, sf)
    plan = spatial.SpatialPlan("geometry", "wkt", "wkt", crs_column="crs")
    own = spatial.layer_srid(spatial.row_srids(df, plan)).select(F.lit("own").alias("asked"), F.col("srid").cast("long").alias("srid"))
    given = spatial.layer_srid(spatial.row_srids(df, plan), target=3035).select(F.lit("given"), F.col("srid").cast("long"))
    bare = spatial.SpatialPlan("geometry", "wkt", "wkt")
    none = spatial.layer_srid(spatial.row_srids(df, bare)).select(F.lit("none"), F.col("srid").cast("long"))
    return own.unionAll(given).unionAll(none)


def q_layer_stats(spark, sf):
    df = geo(spark, sf)
    shape = F.when(F.col("k") % 4 == 3, F.col("mixed")).when(F.col("k") % 4 == 2, F.col("box")).otherwise(F.col("wkt"))
    df = df.withColumn("g", shape)
    plan = spatial.SpatialPlan("geometry", "g", "wkt", crs_column="crs")
    out = spatial.layer_stats(spatial.with_geometry(df, plan), source_present=F.col("g").isNotNull())
    return out.withColumn("z", F.col("z").cast("long"))


def _projected(spark, sf, target, source=4326):
    df = geo(spark, sf)
    x, y = geometry.reproject_point(F.col("lon"), F.col("lat"), F.lit(source), target)
    return df.select("k", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


def q_reproject_3857(spark, sf):
    return _projected(spark, sf, 3857)


def q_reproject_3035(spark, sf):
    return _projected(spark, sf, 3035)


def q_reproject_roundtrip(spark, sf):
    # To metres and back: within 1e-8 degrees, about a millimetre. The antipode
    # of the projection's centre has no image and is left out by its distance.
    df = geo(spark, sf)
    out = df
    for target in (3035, 3857):
        x, y = geometry.reproject_point(F.col("lon"), F.col("lat"), F.lit(4326), target)
        out = out.withColumn(f"x{target}", x).withColumn(f"y{target}", y)
    close = []
    for source in (3035, 3857):
        lon, lat = geometry.reproject_point(F.col(f"x{source}"), F.col(f"y{source}"), F.lit(source), 4326)
        gap = F.abs(F.cos(F.radians("lat")) * F.sin(F.radians(lon - F.col("lon")))) + F.abs(F.sin(F.radians(lat - F.col("lat"))))
        close.append((gap < 2e-10).alias(f"close{source}"))
    return out.select("k", *close)


def q_reproject_utm(spark, sf):
    """Every place in the zone that it lies in."""
    df = geo(spark, sf)
    zone = F.least(F.floor((F.col("lon") + 180) / 6) + 1, F.lit(60))
    code = (F.when(F.col("lat") >= 0, 32600).otherwise(32700) + zone).cast("int")
    systems = [4326, *(base + z for base in (32600, 32700) for z in range(1, 61))]
    out = project_frame(df.withColumn("srid", code), F.col("lon"), F.col("lat"), 4326, F.col("srid"), systems=systems)
    return out.select("k", F.col("srid").cast("long").alias("srid"), F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


def q_reproject_conic(spark, sf):
    df = geo(spark, sf).where("lat > -60")
    out = df
    for code in (2154, 3034):
        out = project_frame(out, F.col("lon"), F.col("lat"), 4326, code, (f"x{code}", f"y{code}"), systems=[4326, code])
    return out.select("k", *[F.round(f"{a}{code}", 2).alias(f"{a}{code}") for code in (2154, 3034) for a in "xy"])


def q_reproject_all_systems(spark, sf):
    """Places near the middle of each system's area, there and back, each row in its own system."""
    rows = [(i, c, *_middle(c)) for i, c in enumerate(SUPPORTED)]
    places = spark.createDataFrame(rows, "i int, srid int, lon0 double, lat0 double")
    df = geo(spark, sf).withColumn("i", (F.col("k") % len(SUPPORTED)).cast("int")).join(F.broadcast(places), "i")
    df = df.select("k", "srid", (F.col("lon0") + F.col("lon") / 60).alias("lon"), (F.col("lat0") + F.col("lat") / 10).alias("lat"))
    there = project_frame(df, F.col("lon"), F.col("lat"), 4326, F.col("srid"), ("px", "py"))
    back = project_frame(there, F.col("px"), F.col("py"), F.col("srid"), 4326, ("blon", "blat"))
    near = (F.abs(F.col("blon") - F.col("lon")) < 1e-8) & (F.abs(F.col("blat") - F.col("lat")) < 1e-8)
    return back.groupBy(F.col("srid").cast("long").alias("srid")).agg(F.count("*").alias("places"), F.count_if(near).alias("near"))


def _middle(code: int) -> tuple[float, float]:
    values = SYSTEMS[code].values
    return math.degrees(values.get("lon0", math.radians(10.0))), -45.0 if values.get("north") == 1e7 else 52.0


def q_reproject_geometry(spark, sf):
    # Whole polygons through the batch projection, each row from its own CRS.
    df = geo(spark, sf).withColumn("d", geometry.decode_geometry(F.col("box"), "wkt"))
    code = geometry.epsg_code(F.col("crs"), T.StringType())
    code = F.when(code == 4326, code).otherwise(0)
    moved = df.withColumn("s", geometry.geometry_summary(geometry.reproject(F.col("d.wkb"), code, 3857)))
    return moved.select(
        "k", *[F.round(F.col(f"s.{c}"), 2).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")]
    )


def q_export_values(spark, sf):
    events = read(spark, sf, "events")
    shaped = events.select(
        F.col("event_id").alias("fid"),
        F.col("ts"),
        F.col("ts").cast("date").alias("day"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.struct("user_id", "event_type").alias("who"),
    )
    out = spatial.export_values(shaped)
    return out.select("fid_src", "ts", "day", "value", F.get_json_object("who", "$.event_type").alias("who"))


def q_gpkg_point_blob(spark, sf):
    df = geo(spark, sf)
    blob = geometry.gpkg_blob(geometry.point_wkb(F.col("lon"), F.col("lat")), 4326)
    # "GP", version 0, flags 3, SRS 4326, then the envelope and the point.
    return df.withColumn("b", blob).select(
        "k", F.hex(F.substring("b", 1, 8)).alias("head"), F.length("b").cast("long").alias("bytes"),
        F.hex(F.substring("b", 41, 5)).alias("wkb"),
        (F.substring("b", 9, 8) == F.substring("b", 46, 8)).alias("min_x_is_x"),
        (F.substring("b", 33, 8) == F.substring("b", 54, 8)).alias("max_y_is_y"),
    )


def q_spatial_profile(spark, sf):
    df = geo(spark, sf).select("k", "mixed", F.col("ewkt").alias("Geom"), "json", "c_mktsegment", "crs")
    return spatial.spatial_profile(df).withColumn("rank", F.col("rank").cast("long"))


def q_spatial_plan(spark, sf):
    df = geo(spark, sf)
    tables = {
        "wkt": df.select("k", F.col("ewkt").alias("anything"), "crs"),
        "latlon": df.select("k", "lat", "lon", "c_mktsegment"),
        "mixed": df.select("k", "mixed"),
        "text": df.select(F.col("lat").cast("string").alias("lat"), F.col("lon").cast("string").alias("lon")),
    }
    rows = []
    for name, table in tables.items():
        p = spatial.spatial_plan(table)
        rows.append((name, *((p.kind, p.geometry_column, p.encoding, p.crs_column) if p else ("tabular", None, None, None))))
    return spark.createDataFrame(rows, "name string, kind string, geometry_column string, encoding string, crs_column string")


def _exported(spark, sf, *srids):
    """The export's report and folder; with several systems one export after the other."""
    lake, df = new_lake(spark), geo(spark, sf)
    stations = df.select("k", F.col("ewkt").alias("geom"), "c_acctbal")
    create_table(lake, stations, "catalog.a.places")
    create_table(lake, df.select("k", "lat", "lon"), "catalog.b.places")
    create_table(lake, read(spark, sf, "orders"), "catalog.b.orders")
    out = scratch(spark, "export")
    for srid in srids or (3857,):
        report = spatial.export_layers(lake, "catalog", out, srid=srid)
    return report, out


def q_export_report(spark, sf):
    report, _ = _exported(spark, sf)
    return report.select(
        "path", "layer", "data_type", "rows", "geometry_column", "geometry_type",
        F.col("srs_id").cast("long").alias("srs_id"), F.round("max_x", 2).alias("max_x"), F.round("max_y", 2).alias("max_y"),
    )


def q_export_again(spark, sf):
    """What readers find after a second export into the same folder: its tables, and the rows of every layer's files."""
    _, out = _exported(spark, sf, 3857, 4326)
    found = spatial.open_export(spark, out)
    held = None
    # One row per layer.
    for row in found["contents"].select("layer", "location").collect():
        one = spark.read.parquet(row["location"]).agg(F.count("*").alias("held")).withColumn("layer", F.lit(row["layer"]))
        held = one if held is None else held.unionByName(one)
    named = found["geometry_columns"].join(found["spatial_ref_sys"], "srs_id").select("layer", "srs_name", "geometry_type")
    bounds = [F.round(c, 6).alias(c) for c in ("min_x", "max_y")]
    layers = found["contents"].select("layer", "data_type", "rows", F.col("srs_id").cast("long").alias("srs_id"), *bounds)
    return layers.join(held, "layer").join(named, "layer", "left")


def q_export_layer(spark, sf):
    report, _ = _exported(spark, sf)
    # At most one row per exported table.
    where = report.filter("layer = 'b_places'").first()["location"]
    blob = spark.read.parquet(where)
    back = blob.withColumn("d", geometry.decode_geometry(F.substring("geom", 41, 21), "wkb"))
    seen = back.withColumn("s", geometry.geometry_summary(F.col("d.wkb")))
    return seen.select("k", "lat", "lon", F.round("s.min_x", 2).alias("x"), F.round("s.min_y", 2).alias("y"))


QUERIES = {
    "geometry_encoding": q_geometry_encoding,
    "decode_wkt_points": q_decode_wkt_points,
    "decode_geojson_points": q_decode_geojson_points,
    "decode_geometry_wkt": q_decode_geometry_wkt,
    "decode_geometry_polygons": q_decode_geometry_polygons,
    "decode_geometry_geojson": q_decode_geometry_geojson,
    "decode_geometry_wkb": q_decode_geometry_wkb,
    "latlon_points": q_latlon_points,
    "epsg_codes": q_epsg_codes,
    "row_srid": q_row_srid,
    "layer_srid": q_layer_srid,
    "layer_stats": q_layer_stats,
    "reproject_3857": q_reproject_3857,
    "reproject_3035": q_reproject_3035,
    "reproject_roundtrip": q_reproject_roundtrip,
    "reproject_utm": q_reproject_utm,
    "reproject_conic": q_reproject_conic,
    "reproject_all_systems": q_reproject_all_systems,
    "reproject_geometry": q_reproject_geometry,
    "export_values": q_export_values,
    "export_again": q_export_again,
    "gpkg_point_blob": q_gpkg_point_blob,
    "spatial_profile": q_spatial_profile,
    "spatial_plan": q_spatial_plan,
    "export_report": q_export_report,
    "export_layer": q_export_layer,
}

_MX = "6378137.0 * radians({0})"
_MY = "6378137.0 * ln(tan(radians({0}) / 2 + pi() / 4))"

# The projection written out once more, from its published formulas.
_LAEA = """
e AS (SELECT *, sqrt(e2) AS ec FROM (SELECT (1 / 298.257222101) * (2 - 1 / 298.257222101) AS e2)),
c AS (SELECT *, 6378137.0 * sqrt(qp / 2) AS rq, asin(q0 / qp) AS b0 FROM (
  SELECT *, (1 - e2) * (1 / (1 - e2) - ln((1 - ec) / (1 + ec)) / (2 * ec)) AS qp,
    (1 - e2) * (sin(radians(52)) / (1 - e2 * sin(radians(52)) ** 2) - ln((1 - ec * sin(radians(52))) / (1 + ec * sin(radians(52)))) / (2 * ec)) AS q0 FROM e)),
d AS (SELECT *, 6378137.0 * cos(radians(52)) / (sqrt(1 - e2 * sin(radians(52)) ** 2) * rq * cos(b0)) AS dd FROM c),
p AS (SELECT k, d.*, radians(lon) - radians(10) AS l, asin(greatest(-1, least(1, ((1 - e2) * (sin(radians(lat)) / (1 - e2 * sin(radians(lat)) ** 2) - ln((1 - ec * sin(radians(lat))) / (1 + ec * sin(radians(lat)))) / (2 * ec))) / qp))) AS b FROM geo, d),
m AS (SELECT *, rq * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(l))) AS s FROM p)
SELECT k, round(s * dd * cos(b) * sin(l) + 4321000, 2) AS x,
  round(s / dd * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(l)) + 3210000, 2) AS y FROM m"""

# Transverse Mercator by Krüger's series to the fourth power, on the ellipsoid of WGS 84.
_UTM = """
w AS (SELECT f / (2 - f) AS n, sqrt(f * (2 - f)) AS e FROM (SELECT 1 / 298.257223563::DOUBLE AS f)),
a AS (SELECT e, 0.9996 * 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS r, n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180 AS a1,
  13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440 AS a2, 61 * n ** 3 / 240 - 103 * n ** 4 / 140 AS a3, 49561 * n ** 4 / 161280 AS a4 FROM w),
z AS (SELECT k, radians(lat) AS p, lat, least(floor((lon + 180) / 6) + 1, 60) AS zone, radians(lon) AS lam FROM geo),
c AS (SELECT *, sinh(atanh(sin(p)) - e * atanh(e * sin(p))) AS t, lam - radians(6 * zone - 183) AS l FROM z, a),
x AS (SELECT *, atan2(t, cos(l)) AS xi, asinh(sin(l) / sqrt(t * t + cos(l) ** 2)) AS eta FROM c)
SELECT k, (CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone)::BIGINT AS srid,
  round(500000 + r * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta) + a4 * cos(8 * xi) * sinh(8 * eta)), 2) AS x,
  round(CASE WHEN lat >= 0 THEN 0 ELSE 10000000 END + r * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta) + a4 * sin(8 * xi) * cosh(8 * eta)), 2) AS y
FROM x"""

# Lambert conformal conic with two standard parallels: ln of Snyder's t is minus the isometric latitude.
_CONIC = """
w AS (SELECT sqrt(f * (2 - f)) AS e FROM (SELECT 1 / 298.257222101::DOUBLE AS f)),
s AS (SELECT *, atanh(sin(radians(lat0))) - e * atanh(e * sin(radians(lat0))) AS q0, atanh(sin(radians(lat1))) - e * atanh(e * sin(radians(lat1))) AS q1,
  atanh(sin(radians(lat2))) - e * atanh(e * sin(radians(lat2))) AS q2, cos(radians(lat1)) / sqrt(1 - (e * sin(radians(lat1))) ** 2) AS m1,
  cos(radians(lat2)) / sqrt(1 - (e * sin(radians(lat2))) ** 2) AS m2
  FROM w, (VALUES (2154, 46.5, 3, 49, 44, 700000, 6600000), (3034, 52, 10, 35, 65, 4000000, 2800000)) v(code, lat0, lon0, lat1, lat2, fe, fn)),
d AS (SELECT *, 6378137.0 * m1 / n * exp(n * q1) AS r FROM (SELECT *, (ln(m1) - ln(m2)) / (q2 - q1) AS n FROM s)),
t AS (SELECT k, d.*, r * exp(-n * (atanh(sin(radians(lat))) - e * atanh(e * sin(radians(lat))))) AS rho,
  n * atan2(sin(radians(lon - lon0)), cos(radians(lon - lon0))) AS turn FROM geo, d WHERE lat > -60),
p AS (SELECT k, d.code, fe + rho * sin(turn) AS x, fn + r * exp(-n * q0) - rho * cos(turn) AS y FROM t AS d)
SELECT a.k, round(a.x, 2) AS x2154, round(a.y, 2) AS y2154, round(b.x, 2) AS x3034, round(b.y, 2) AS y3034
FROM p a JOIN p b USING (k) WHERE a.code = 2154 AND b.code = 3034"""

_CODES = """codes AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS i FROM (
  SELECT unnest([2154, 3034, 3035, 3857, 4258, 4326]) AS code UNION ALL SELECT 3012 + unnest(range(26, 40))
  UNION ALL SELECT 25800 + unnest(range(28, 39)) UNION ALL SELECT 32600 + unnest(range(1, 61)) UNION ALL SELECT 32700 + unnest(range(1, 61))))"""

ORACLES = {
    "geometry_encoding": f"""WITH {GEO}
SELECT k, CASE WHEN k % 4 < 2 THEN 'wkt' WHEN k % 4 = 2 THEN 'geojson' END AS mixed, 'wkt' AS box, 'hexwkb' AS hexed,
  CAST(NULL AS VARCHAR) AS plain, 'wkb' AS bytes FROM geo""",
    "decode_wkt_points": f"""WITH {GEO}
SELECT k, CASE WHEN k % 4 < 2 THEN lon END AS x, CASE WHEN k % 4 < 2 THEN lat END AS y,
  CAST(CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 4258 END AS BIGINT) AS srid FROM geo""",
    "decode_geojson_points": f"WITH {GEO} SELECT k, lon AS x, lat AS y FROM geo",
    "decode_geometry_wkt": f"""WITH {GEO} SELECT k, 'POINT' AS type, lon AS min_x, lat AS min_y, lon AS max_x, lat AS max_y,
  CAST(CASE WHEN k % 3 = 0 THEN 4326 ELSE 3857 END AS BIGINT) AS srid, CAST(21 AS BIGINT) AS bytes FROM geo""",
    "decode_geometry_polygons": f"""WITH {GEO} SELECT k, 'POLYGON' AS type, lon AS min_x, lat AS min_y, lon + 1 AS max_x, lat + 2 AS max_y,
  CAST(0 AS BIGINT) AS srid, CAST(77 AS BIGINT) AS bytes FROM geo""",
    "decode_geometry_geojson": f"""WITH {GEO} SELECT k, 'POINT' AS type, lon AS min_x, lat AS min_y, lon AS max_x, lat AS max_y,
  CAST(0 AS BIGINT) AS srid, CAST(21 AS BIGINT) AS bytes FROM geo""",
    "decode_geometry_wkb": f"""WITH {GEO}, t AS (SELECT *, k % 2 = 0 AS whole FROM geo)
SELECT k, CASE WHEN whole THEN 'POLYGON' END AS type, CASE WHEN whole THEN lon END AS min_x, CASE WHEN whole THEN lat END AS min_y,
  CASE WHEN whole THEN lon + 1 END AS max_x, CASE WHEN whole THEN lat + 2 END AS max_y,
  CASE WHEN whole THEN CAST(0 AS BIGINT) END AS srid, CASE WHEN whole THEN CAST(77 AS BIGINT) END AS bytes FROM t""",
    "latlon_points": f"""WITH {GEO} SELECT k, CASE WHEN k % 7 <> 0 THEN lon END AS x, CASE WHEN k % 7 <> 0 THEN lat END AS y,
  CAST(CASE WHEN k % 7 <> 0 THEN 4326 ELSE 0 END AS BIGINT) AS srid FROM geo""",
    "epsg_codes": f"""WITH {GEO} SELECT k, CAST(code AS BIGINT) AS crs, CAST(3035 AS BIGINT) AS name, greatest(k - 5, 0) AS whole,
  CASE WHEN k % 2 = 0 THEN k // 2 ELSE 0 END AS half, CAST(0 AS BIGINT) AS truth FROM geo""",
    "row_srid": f"""WITH {GEO} SELECT k, CAST(CASE WHEN k % 2 = 0 THEN CASE WHEN k % 3 = 0 THEN 4326 ELSE 3857 END ELSE code END AS BIGINT) AS srid,
  true AS same FROM geo""",
    "layer_srid": f"""WITH {GEO}, c AS (SELECT code, count(*) AS n FROM geo WHERE code > 0 GROUP BY code)
SELECT 'own' AS asked, CAST((SELECT code FROM c ORDER BY n DESC, code LIMIT 1) AS BIGINT) AS srid
UNION ALL SELECT 'given', 3035 UNION ALL SELECT 'none', -1""",
    "layer_stats": f"""WITH {GEO}, g AS (SELECT * FROM geo WHERE k % 4 <> 3)
SELECT 'GEOMETRY' AS geometry_type, min(lon) AS min_x, min(lat) AS min_y, max(CASE WHEN k % 4 = 2 THEN lon + 1 ELSE lon END) AS max_x,
  max(CASE WHEN k % 4 = 2 THEN lat + 2 ELSE lat END) AS max_y, CAST(0 AS BIGINT) AS z, (SELECT count(*) FROM geo) AS rows,
  (SELECT count(*) FROM geo WHERE k % 4 = 3) AS undecoded, count(*) FILTER (WHERE code = 0) AS without_crs FROM g""",
    "reproject_3857": f"WITH {GEO} SELECT k, round({_MX.format('lon')}, 2) AS x, round({_MY.format('lat')}, 2) AS y FROM geo",
    "reproject_3035": f"WITH {GEO}, {_LAEA.lstrip()}",
    "reproject_roundtrip": f"WITH {GEO} SELECT k, true AS close3035, true AS close3857 FROM geo",
    "reproject_utm": f"WITH {GEO}, {_UTM.lstrip()}",
    "reproject_conic": f"WITH {GEO}, {_CONIC.lstrip()}",
    "reproject_all_systems": f"""WITH {GEO}, {_CODES}
SELECT codes.code::BIGINT AS srid, count(*) AS places, count(*) AS near FROM geo JOIN codes ON k % (SELECT count(*) FROM codes) = i GROUP BY ALL""",
    "reproject_geometry": f"""WITH {GEO}
SELECT k, CASE WHEN code = 4326 THEN round({_MX.format('lon')}, 2) ELSE lon END AS min_x, CASE WHEN code = 4326 THEN round({_MY.format('lat')}, 2) ELSE lat END AS min_y,
  CASE WHEN code = 4326 THEN round({_MX.format('(lon + 1)')}, 2) ELSE lon + 1 END AS max_x,
  CASE WHEN code = 4326 THEN round({_MY.format('(lat + 2)')}, 2) ELSE lat + 2 END AS max_y FROM geo""",
    "export_values": """SELECT event_id AS fid_src, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(microsecond(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z' AS ts,
  strftime(ts, '%Y-%m-%d') AS day, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value, event_type AS who FROM events""",
    "gpkg_point_blob": f"""WITH {GEO} SELECT k, '47500003E6100000' AS head, CAST(61 AS BIGINT) AS bytes, '0101000000' AS wkb,
  true AS min_x_is_x, true AS max_y_is_y FROM geo""",
    "spatial_profile": f"""WITH {GEO}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE k % 4 < 2) AS w, count(*) FILTER (WHERE k % 4 = 2) AS j FROM geo)
SELECT CAST(0 AS BIGINT) AS rank, 'Geom' AS "column", n AS rows, CAST(0 AS BIGINT) AS wkb, CAST(0 AS BIGINT) AS hexwkb, n AS wkt, CAST(0 AS BIGINT) AS geojson, n AS decoded FROM n
UNION ALL SELECT 1, 'mixed', n, 0, 0, w, j, NULL FROM n
UNION ALL SELECT 2, 'json', n, 0, 0, 0, n, n FROM n
UNION ALL SELECT 3, 'c_mktsegment', n, 0, 0, 0, 0, NULL FROM n""",
    "spatial_plan": """SELECT * FROM (VALUES ('wkt', 'geometry', 'anything', 'wkt', 'crs'), ('latlon', 'latlon', NULL, NULL, NULL),
  ('mixed', 'tabular', NULL, NULL, NULL), ('text', 'tabular', NULL, NULL, NULL)) v(name, kind, geometry_column, encoding, crs_column)""",
    "export_report": f"""WITH {GEO}, n AS (SELECT count(*) AS n,
  round(max(CASE WHEN k % 3 = 0 THEN {_MX.format('lon')} ELSE lon END), 2) AS ax, round(max(CASE WHEN k % 3 = 0 THEN {_MY.format('lat')} ELSE lat END), 2) AS ay,
  round(max({_MX.format('lon')}), 2) AS bx, round(max({_MY.format('lat')}), 2) AS byy FROM geo)
SELECT 'catalog.a.places' AS path, 'a_places' AS layer, 'features' AS data_type, n AS rows, 'geom' AS geometry_column, 'POINT' AS geometry_type,
  CAST(3857 AS BIGINT) AS srs_id, ax AS max_x, ay AS max_y FROM n
UNION ALL SELECT 'catalog.b.places', 'b_places', 'features', n, 'geom', 'POINT', 3857, bx, byy FROM n
UNION ALL SELECT 'catalog.b.orders', 'orders', 'attributes', (SELECT count(*) FROM orders), NULL, NULL, NULL, NULL, NULL""",
    "export_again": f"""WITH {GEO}, n AS (SELECT count(*) AS n, min(lon) AS bx, max(lat) AS byy,
  min(CASE WHEN k % 3 = 0 THEN lon ELSE degrees(lon / 6378137.0) END) AS ax,
  max(CASE WHEN k % 3 = 0 THEN lat ELSE degrees(2 * atan(exp(lat / 6378137.0)) - pi() / 2) END) AS ay FROM geo)
SELECT 'a_places' AS layer, 'features' AS data_type, n AS rows, CAST(4326 AS BIGINT) AS srs_id, round(ax, 6) AS min_x, round(ay, 6) AS max_y, n AS held, 'WGS 84' AS srs_name, 'POINT' AS geometry_type FROM n
UNION ALL SELECT 'b_places', 'features', n, 4326, bx, byy, n, 'WGS 84', 'POINT' FROM n
UNION ALL SELECT 'orders', 'attributes', count(*), NULL, NULL, NULL, count(*), NULL, NULL FROM orders""",
    "export_layer": f"""WITH {GEO} SELECT k, lat, lon, round({_MX.format('lon')}, 2) AS x, round({_MY.format('lat')}, 2) AS y FROM geo""",
}
