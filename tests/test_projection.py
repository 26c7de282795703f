"""Every supported system: there and back, against the definitions of the projections, and on frames."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.functions import projection
from lakewright.functions.projection import GRS80, SUPPORTED, SYSTEMS, WGS84, project_arrays, project_frame

METRE = 1 / 111_000


def around(code):
    """Longitudes and latitudes a system is made for."""
    s = SYSTEMS[code]
    if s.family.startswith("zone"):
        mid = math.degrees(s.values["lon0"])
        lat = np.linspace(-80, -0.5, 25) if s.values["north"] else np.linspace(0.5, 84, 25)
        lon = mid + np.linspace(-3.5, 3.5, 15)
    elif s.family == "conic":
        lon, lat = math.degrees(s.values["lon0"]) + np.linspace(-30, 30, 15), np.linspace(30, 72, 25)
    else:
        lon, lat = np.linspace(-10, 40, 15), np.linspace(33, 71, 25)
    lon, lat = np.meshgrid(lon, lat)
    return lon.ravel(), lat.ravel()


@pytest.mark.parametrize("code", SUPPORTED)
def test_there_and_back(code):
    lon, lat = around(code)
    back = project_arrays(*project_arrays(lon, lat, 4326, code), code, 4326)
    assert np.abs(back[0] - lon).max() < 1e-3 * METRE and np.abs(back[1] - lat).max() < 1e-3 * METRE


def radii(body, lat):
    w = np.sqrt(1 - body.e2 * np.sin(lat) ** 2)
    return body.a * (1 - body.e2) / w**3, body.a / w * np.cos(lat)


def scales(code, lon, lat, body):
    """Length on the map over length on the ellipsoid, northwards and eastwards, and whether angles are kept."""
    h = 1e-4
    (ex, ey), (wx, wy), (nx, ny), (sx, sy) = (project_arrays(lon + a, lat + b, 4326, code) for a, b in ((h, 0), (-h, 0), (0, h), (0, -h)))
    along, across = radii(body, np.radians(lat))
    step = 2 * math.radians(h)
    east, north = ((ex - wx) / step / across, (ey - wy) / step / across), ((nx - sx) / step / along, (ny - sy) / step / along)
    return np.hypot(*north), np.hypot(*east), east[0] * north[0] + east[1] * north[1]


@pytest.mark.parametrize("code", [2154, 3034, 3045, 25832, 32601, 32633, 32760])
def test_conformal(code):
    lon, lat = around(code)
    north, east, angle = scales(code, lon, lat, WGS84 if SYSTEMS[code].family.endswith("WGS84") else GRS80)
    assert np.abs(north - east).max() < 1e-6 and np.abs(angle).max() < 1e-6


@pytest.mark.parametrize("code", [3044, 25832, 32632, 32732])
def test_the_middle_of_a_zone_is_a_scaled_meridian(code):
    body, s = (WGS84 if code > 30000 else GRS80), SYSTEMS[code]
    for lat in (-72.0, -10.0) if s.values["north"] else (10.0, 52.0, 80.0):
        parts = np.linspace(0, math.radians(lat), 200_001)
        arc, _ = radii(body, parts)
        length = float(((arc[1:] + arc[:-1]) / 2 * np.diff(parts)).sum())
        x, y = project_arrays(np.array([9.0]), np.array([lat]), 4326, code)
        assert x[0] == pytest.approx(500000, abs=1e-6)
        assert y[0] == pytest.approx(s.values["north"] + 0.9996 * length, abs=1e-4)


@pytest.mark.parametrize(("code", "parallels", "origin"), [(2154, (49, 44), (3, 46.5, 700000, 6600000)), (3034, (35, 65), (10, 52, 4000000, 2800000))])
def test_conic_definition(code, parallels, origin):
    for lat in parallels:
        north, east, _ = scales(code, np.array([origin[0] + 5.0]), np.array([float(lat)]), GRS80)
        assert north[0] == pytest.approx(1, abs=1e-7) and east[0] == pytest.approx(1, abs=1e-7)
    x, y = project_arrays(np.array([float(origin[0])]), np.array([origin[1]]), 4326, code)
    assert (x[0], y[0]) == pytest.approx(origin[2:], abs=1e-6)


def test_frames_equal_arrays(spark):
    codes = [2154, 3034, 3035, 3045, 3857, 4258, 25832, 32601, 32633, 32760]
    rows = [(int(c), float(a), float(b)) for c in codes for a, b in list(zip(*around(c), strict=True))[::37]]
    df = spark.createDataFrame([*rows, (0, 1.0, 2.0), (None, 1.0, 2.0), (4326, None, 1.0)], "code int, x double, y double")
    there = project_frame(df.where("code <> 0"), F.col("x"), F.col("y"), 4326, F.col("code"), ("px", "py"), systems=[4326, *codes])
    assert there.columns == ["code", "x", "y", "px", "py"]
    for r in there.where("x is not null").collect():
        px, py = project_arrays(np.array([r.x]), np.array([r.y]), 4326, r.code)
        assert (r.px, r.py) == pytest.approx((px[0], py[0]), abs=1e-6)
    back = project_frame(there, F.col("px"), F.col("py"), F.col("code"), 4326, ("lon", "lat"), systems=[4326, *codes])
    for r in back.where("x is not null").collect():
        assert (r.lon, r.lat) == pytest.approx((r.x, r.y), abs=1e-8)
    kept = project_frame(df.where("code = 0 or code is null"), F.col("x"), F.col("y"), F.col("code"), 25832, systems=[4326, 25832]).orderBy("code").collect()
    assert [(r.code, r.x, r.y) for r in kept] == [(None, None, None), (0, 1.0, 2.0)]


def test_unknown_codes(spark):
    df = spark.createDataFrame([(9999, 1.0, 2.0)], "code int, x double, y double")
    with pytest.raises(Exception, match="no conversion from EPSG:9999"):
        project_frame(df, F.col("x"), F.col("y"), F.col("code"), 25832, systems=[25832]).collect()
    with pytest.raises(ValueError):
        project_frame(df, F.col("x"), F.col("y"), 4326, 25832, systems=[31467])
    with pytest.raises(ValueError):
        project_arrays(np.array([1.0]), np.array([1.0]), 4326, 31467)


def test_names():
    assert projection.CRS_NAMES["etrs89 / utm zone 32n"] == 25832
    assert projection.CRS_TITLES[32733] == "WGS 84 / UTM zone 33S"
    assert projection.CRS_NAMES["wgs 84"] == 4326 and projection.CRS_NAMES["etrs89-extended / laea europe"] == 3035
