"""The coordinate reference systems the library converts between.

Geographic WGS 84 (4326) and ETRS89 (4258) are taken as equal. Web Mercator (3857) is
spherical; LAEA Europe (3035) is the ellipsoidal Lambert azimuthal equal-area projection
(Snyder, Map Projections, USGS 1395, chapter 24); the Lambert conformal conic systems
follow chapter 15 there. UTM and the other transverse Mercator zones use the series of
Krüger in the third flattening, to its fourth power, which is exact to micrometres within
a zone. All systems stand in one table, most of them by rule.

The formulas run on columns or on numpy arrays alike. On a frame, each intermediate value
becomes a column of its own, so none is computed twice, and only for the rows whose system
needs it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Ellipsoid:
    """An ellipsoid with the coefficients of its transverse Mercator and conformal series."""

    def __init__(self, axis: float, flattening: float):
        self.a, self.e2 = axis, flattening * (2 - flattening)
        self.e = math.sqrt(self.e2)
        n = flattening / (2 - flattening)
        self.rectifying = axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

        def row(power: int, *terms: float) -> float:
            return sum(c * n ** (power + i) for i, c in enumerate(terms))

        # Krüger's series, forward, inverse, and from conformal to geodetic latitude.
        self.forward = (
            row(1, 1 / 2, -2 / 3, 5 / 16, 41 / 180),
            row(2, 13 / 48, -3 / 5, 557 / 1440),
            row(3, 61 / 240, -103 / 140),
            row(4, 49561 / 161280),
        )
        self.inverse = (
            row(1, 1 / 2, -2 / 3, 37 / 96, -1 / 360),
            row(2, 1 / 48, 1 / 15, -437 / 1440),
            row(3, 17 / 480, -37 / 840),
            row(4, 4397 / 161280),
        )
        self.geodetic = (
            row(1, 2, -2 / 3, -2, 116 / 45),
            row(2, 7 / 3, -8 / 5, -227 / 45),
            row(3, 56 / 15, -136 / 35),
            row(4, 4279 / 630),
        )

    def isometric(self, m, lat):
        sin_lat = m.sin(lat)
        return m.atanh(sin_lat) - self.e * m.atanh(self.e * sin_lat)

    def latitude(self, m, conformal):
        return conformal + sum(c * m.sin(2 * j * conformal) for j, c in enumerate(self.geodetic, 1))


# Axis and flattening of the two ellipsoids.
GRS80 = Ellipsoid(6378137.0, 1 / 298.257222101)
WGS84 = Ellipsoid(6378137.0, 1 / 298.257223563)


@dataclass(frozen=True)
class System:
    """A system: the family of its formulas, and the numbers that tell it from others of the family."""

    code: int
    title: str
    family: str
    values: dict[str, float] = field(default_factory=dict)


def _zone(code: int, zone: int, title: str, family: str, north: float = 0.0) -> System:
    return System(code, title, family, {"lon0": math.radians(6 * zone - 183), "east": 500000.0, "north": north})


def _conic(code: int, title: str, lat0: float, lon0: float, lat1: float, lat2: float, east: float, north: float) -> System:
    def spread(lat):
        return math.cos(lat) / math.sqrt(1 - GRS80.e2 * math.sin(lat) ** 2)

    lat0, lat1, lat2 = map(math.radians, (lat0, lat1, lat2))
    q0, q1, q2 = (GRS80.isometric(math, lat) for lat in (lat0, lat1, lat2))
    n = (math.log(spread(lat1)) - math.log(spread(lat2))) / (q2 - q1)
    radius = GRS80.a * spread(lat1) / n * math.exp(n * q1)
    values = {"lon0": math.radians(lon0), "n": n, "radius": radius, "top": radius * math.exp(-n * q0)}
    return System(code, title, "conic", {**values, "east": east, "north": north})


# The supported systems and their parameters.
SYSTEMS = {
    s.code: s
    for s in (
        _conic(2154, "RGF93 v1 / Lambert-93", 46.5, 3.0, 49.0, 44.0, 700000.0, 6600000.0),
        _conic(3034, "ETRS89-extended / LCC Europe", 52.0, 10.0, 35.0, 65.0, 4000000.0, 2800000.0),
        System(3035, "ETRS89-extended / LAEA Europe", "laea"),
        *(_zone(3012 + z, z, f"ETRS89 / TM{z}", "zone of GRS80") for z in range(26, 40)),
        System(3857, "WGS 84 / Pseudo-Mercator", "mercator"),
        System(4258, "ETRS89", "geographic"),
        System(4326, "WGS 84", "geographic"),
        *(_zone(25800 + z, z, f"ETRS89 / UTM zone {z}N", "zone of GRS80") for z in range(28, 39)),
        *(_zone(32600 + z, z, f"WGS 84 / UTM zone {z}N", "zone of WGS84") for z in range(1, 61)),
        *(_zone(32700 + z, z, f"WGS 84 / UTM zone {z}S", "zone of WGS84", 1e7) for z in range(1, 61)),
    )
}
SUPPORTED = tuple(sorted(SYSTEMS))
GEOGRAPHIC = (4326, 4258)
#: Systems whose conversion is one column expression of moderate size.
PLAIN = (3035, 3857, 4258, 4326)
CRS_TITLES = {code: s.title for code, s in SYSTEMS.items()}
#: Lower-case names of the supported systems; fixed values where a system has more than its title.
CRS_NAMES = {s.title.lower(): code for code, s in SYSTEMS.items()} | {
    "wgs84": 4326,
    "etrs89 / laea europe": 3035,
    "etrs89 / lcc europe": 3034,
    "rgf93 / lambert-93": 2154,
}

# The centre and offsets of the equal-area projection, the scale in the middle of a zone.
_A, _E, _E2 = GRS80.a, GRS80.e, GRS80.e2
_LAT0, _LON0 = math.radians(52.0), math.radians(10.0)
_EAST, _NORTH = 4321000.0, 3210000.0
_MIDDLE = 0.9996


def _q(sin_lat: float) -> float:
    tail = math.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    return (1 - _E2) * (sin_lat / (1 - _E2 * sin_lat**2) - tail)


_QP = _q(1.0)
_RQ = _A * math.sqrt(_QP / 2)
_BETA0 = math.asin(_q(math.sin(_LAT0)) / _QP)
_SIN0, _COS0 = math.sin(_BETA0), math.cos(_BETA0)
_D = _A * math.cos(_LAT0) / math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2) / (_RQ * _COS0)


class _Columns:
    """Column functions under the names the formulas use."""

    sin, cos, tan, asin, atan, atan2, sqrt, log, exp = (
        F.sin, F.cos, F.tan, F.asin, F.atan, F.atan2, F.sqrt, F.log, F.exp
    )
    sinh, cosh, asinh, atanh = F.sinh, F.cosh, F.asinh, F.atanh
    least = staticmethod(lambda a, b: F.least(a, F.lit(b)))
    greatest = staticmethod(lambda a, b: F.greatest(a, F.lit(b)))
    pick = staticmethod(lambda test, a, b: F.when(test, a).otherwise(b))


class _Arrays:
    sin, cos, tan, asin, atan, atan2, sqrt, log, exp = (
        np.sin, np.cos, np.tan, np.arcsin, np.arctan, np.arctan2, np.sqrt, np.log, np.exp
    )
    sinh, cosh, asinh, atanh = np.sinh, np.cosh, np.arcsinh, np.arctanh
    least, greatest, pick = np.minimum, np.maximum, np.where


def _once(*values):
    """Values as they are; a frame keeps each as a column instead."""
    return values


def _laea(m, keep, lon, lat, _):
    sin_lat = m.sin(lat)
    tail = m.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    q = (1 - _E2) * (sin_lat / (1 - _E2 * sin_lat * sin_lat) - tail)
    (beta,) = keep(m.asin(m.greatest(m.least(q / _QP, 1.0), -1.0)))
    sin_b, cos_b, cos_l = m.sin(beta), m.cos(beta), m.cos(lon - _LON0)
    (scale,) = keep(_RQ * m.sqrt(2.0 / (1 + _SIN0 * sin_b + _COS0 * cos_b * cos_l)))
    x = scale * _D * cos_b * m.sin(lon - _LON0)
    y = scale / _D * (_COS0 * sin_b - _SIN0 * cos_b * cos_l)
    return x + _EAST, y + _NORTH


def _laea_inverse(m, keep, x, y, _):
    x, y = (x - _EAST) / _D, (y - _NORTH) * _D
    (rho,) = keep(m.sqrt(x * x + y * y))
    away = rho > 1e-9
    safe = m.pick(away, rho, 1.0)
    (angle,) = keep(2 * m.asin(m.least(rho / (2 * _RQ), 1.0)))
    sin_c, cos_c = m.sin(angle), m.cos(angle)
    (ratio,) = keep(cos_c * _SIN0 + m.pick(away, y * sin_c * _COS0 / safe, 0.0))
    (beta,) = keep(m.asin(m.greatest(m.least(ratio, 1.0), -1.0)))
    lon = _LON0 + m.atan2(x * sin_c, rho * _COS0 * cos_c - y * _SIN0 * sin_c)
    # The series of the authalic latitude, then one Newton step.
    e4, e6 = _E2**2, _E2**3
    (lat,) = keep(
        beta
        + (_E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * m.sin(2 * beta)
        + (23 * e4 / 360 + 251 * e6 / 3780) * m.sin(4 * beta)
        + (761 * e6 / 45360) * m.sin(6 * beta)
    )
    sin_lat = m.sin(lat)
    flat = 1 - _E2 * sin_lat * sin_lat
    tail = m.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    step = flat * flat / (2 * m.greatest(m.cos(lat), 1e-9))
    lat = lat + step * (ratio * _QP / (1 - _E2) - sin_lat / flat + tail)
    return m.pick(away, lon, _LON0), m.pick(away, lat, _LAT0)


def _mercator(m, keep, lon, lat, _):
    return _A * lon, _A * m.log(m.tan(lat / 2 + math.pi / 4))


def _mercator_inverse(m, keep, x, y, _):
    return x / _A, 2 * m.atan(m.exp(y / _A)) - math.pi / 2


def _waves(m, factors, xi, eta):
    """The sums of a series over a pair of angles: what is added along the meridian and across it."""
    along = sum(c * m.sin(2 * j * xi) * m.cosh(2 * j * eta) for j, c in enumerate(factors, 1))
    across = sum(c * m.cos(2 * j * xi) * m.sinh(2 * j * eta) for j, c in enumerate(factors, 1))
    return along, across


def _zoned(body: Ellipsoid):
    radius = _MIDDLE * body.rectifying

    def forward(m, keep, lon, lat, of):
        t, turn = keep(m.sinh(body.isometric(m, lat)), lon - of["lon0"])
        xi, eta = keep(m.atan2(t, m.cos(turn)), m.asinh(m.sin(turn) / m.sqrt(t * t + m.cos(turn) * m.cos(turn))))
        along, across = _waves(m, body.forward, xi, eta)
        return of["east"] + radius * (eta + across), of["north"] + radius * (xi + along)

    def inverse(m, keep, x, y, of):
        xi, eta = keep((y - of["north"]) / radius, (x - of["east"]) / radius)
        along, across = _waves(m, body.inverse, xi, eta)
        xi, eta = keep(xi - along, eta - across)
        (conformal,) = keep(m.asin(m.sin(xi) / m.cosh(eta)))
        return of["lon0"] + m.atan2(m.sinh(eta), m.cos(xi)), body.latitude(m, conformal)

    return forward, inverse


def _conic_forward(m, keep, lon, lat, of):
    turn = lon - of["lon0"]
    angle, far = keep(of["n"] * m.atan2(m.sin(turn), m.cos(turn)), of["radius"] * m.exp(-of["n"] * GRS80.isometric(m, lat)))
    return of["east"] + far * m.sin(angle), of["north"] + of["top"] - far * m.cos(angle)


def _conic_inverse(m, keep, x, y, of):
    x, y = x - of["east"], of["top"] - (y - of["north"])
    (isometric,) = keep(m.log(of["radius"] / m.sqrt(x * x + y * y)) / of["n"])
    (conformal,) = keep(2 * m.atan(m.exp(isometric)) - math.pi / 2)
    return of["lon0"] + m.atan2(x, y) / of["n"], GRS80.latitude(m, conformal)


_TURN = math.pi / 180
#: Per family: from longitude and latitude in radians, and back.
_FAMILIES = {
    "geographic": (lambda m, keep, lon, lat, _: (lon / _TURN, lat / _TURN), lambda m, keep, x, y, _: (x * _TURN, y * _TURN)),
    "mercator": (_mercator, _mercator_inverse),
    "laea": (_laea, _laea_inverse),
    "conic": (_conic_forward, _conic_inverse),
    "zone of GRS80": _zoned(GRS80),
    "zone of WGS84": _zoned(WGS84),
}


def _known(code: int) -> System:
    if code not in SYSTEMS:
        raise ValueError(f"EPSG:{code} is not one of the supported systems {SUPPORTED}")
    return SYSTEMS[code]


def _project(m, x, y, source: int, target: int):
    old, new = _known(source), _known(target)
    if source == target or (source in GEOGRAPHIC and target in GEOGRAPHIC):
        return x, y
    lon, lat = _FAMILIES[old.family][1](m, _once, x, y, old.values)
    return _FAMILIES[new.family][0](m, _once, lon, lat, new.values)


def project_arrays(x: np.ndarray, y: np.ndarray, source: int, target: int):
    with np.errstate(all="ignore"):
        return _project(_Arrays, x, y, source, target)


def project_columns(x: Column, y: Column, srid: Column, target: int) -> tuple[Column, Column]:
    """``x, y`` in ``target``, each row from its own ``srid``, as expressions; for the
    systems of :data:`PLAIN`. 0 stays as it is, another code fails the job rather than
    being written untransformed."""
    if target not in PLAIN:
        raise ValueError(f"EPSG:{target} is not one of the systems {PLAIN}")
    message = F.concat(F.lit("EPSG:"), srid.cast("string"), F.lit(" cannot be reprojected"))
    keep = (srid == 0) | (srid == target)
    new_x, new_y = F.when(keep, x), F.when(keep, y)
    for source in PLAIN:
        if source != target:
            px, py = _project(_Columns, x, y, source, target)
            new_x, new_y = new_x.when(srid == source, px), new_y.when(srid == source, py)
    fail = F.raise_error(message).cast("double")
    return new_x.when(srid.isNotNull(), fail), new_y.when(srid.isNotNull(), fail)


class _Stages:
    """Values kept as columns of a frame, each under a name of its own."""

    def __init__(self, df: DataFrame):
        self.df, self.mine = df, []

    def keep(self, *values: Column) -> list[Column]:
        names = [f"__step{len(self.mine) + i}" for i in range(len(values))]
        self.mine += names
        self.df = self.df.withColumns(dict(zip(names, values, strict=True)))
        return [F.col(n) for n in names]

    def only(self, test: Column):
        """:meth:`keep` for the rows that pass a test; null for others."""
        return lambda *values: self.keep(*(F.when(test, v) for v in values))


def _values_of(systems: list[System], code: Column) -> dict[str, Column]:
    """The numbers of each row's system; those of one value need no look at the code."""
    out = {}
    for name in systems[0].values:
        known = {s.code: s.values[name] for s in systems}
        if len(set(known.values())) == 1:
            out[name] = F.lit(systems[0].values[name])
        else:
            table = F.create_map(*[F.lit(v) for pair in sorted(known.items()) for v in pair])
            out[name] = F.try_element_at(table, code)
    return out


def project_frame(
    df: DataFrame,
    x: Column,
    y: Column,
    source: Column | int,
    target: Column | int,
    to: tuple[str, str] = ("x", "y"),
    systems: Iterable[int] = SUPPORTED,
) -> DataFrame:
    """``df`` with ``x, y`` in another system as the columns ``to``.

    Both systems may differ from row to row. A source of 0 leaves the row's
    values as they are; a code that is not in ``systems`` fails the job rather
    than being written untransformed; a null gives null. Naming the systems that
    occur makes the plan smaller.
    """
    known = [_known(c) for c in sorted(set(systems))]
    stages = _Stages(df)
    codes = [F.lit(c) if isinstance(c, int) else c for c in (source, target)]
    x, y, old, new = stages.keep(x.cast("double"), y.cast("double"), *(c.cast("int") for c in codes))

    def through(turn: int, first: Column, second: Column, code: Column, fixed: Column | int):
        """The families' formulas one after the other, each for the rows of its systems."""
        out = [F.lit(None).cast("double")] * 2
        for family, formulas in _FAMILIES.items():
            mine = [s for s in known if s.family == family and (not isinstance(fixed, int) or s.code == fixed)]
            if mine:
                test = code.isin([s.code for s in mine])
                values = dict(zip(mine[0].values, stages.only(test)(*_values_of(mine, code).values()), strict=True)) if mine[0].values else {}
                made = formulas[turn](_Columns, stages.only(test), first, second, values)
                out = [F.when(test, v).otherwise(o) for v, o in zip(made, out, strict=True)]
        return stages.keep(*out)

    lon, lat = through(1, x, y, old, source)
    made = through(0, lon, lat, new, target)
    stays = (old == 0) | (old == new) | (old.isin(*GEOGRAPHIC) & new.isin(*GEOGRAPHIC))
    allowed = [s.code for s in known]
    told = F.concat(F.lit("no conversion from EPSG:"), old.cast("string"), F.lit(" to EPSG:"), new.cast("string"))
    wrong = ((old != 0) & ~old.isin(allowed)) | ~new.isin(allowed)
    out = [F.when(wrong, F.raise_error(told).cast("double")).when(stays, was).otherwise(now) for was, now in zip((x, y), made, strict=True)]
    return stages.df.withColumns(dict(zip(to, out, strict=True))).drop(*stages.mine)
