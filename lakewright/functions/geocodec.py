"""Geometry bytes inside Arrow batches: text and binary forms to ISO WKB and back.

Plain points, by far the commonest value, are handled a batch at a time with
numpy; every other shape goes through one small parser per value. The WKB made
here is always little-endian ISO, with Z as type + 1000.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Geometry type numbers.
TYPES = {
    "POINT": 1,
    "LINESTRING": 2,
    "POLYGON": 3,
    "MULTIPOINT": 4,
    "MULTILINESTRING": 5,
    "MULTIPOLYGON": 6,
    "GEOMETRYCOLLECTION": 7,
}
NAMES = {number: name for name, number in TYPES.items()}
# GeoJSON's spelling of the types.
_GEOJSON = {
    "Point": "POINT",
    "LineString": "LINESTRING",
    "Polygon": "POLYGON",
    "MultiPoint": "MULTIPOINT",
    "MultiLineString": "MULTILINESTRING",
    "MultiPolygon": "MULTIPOLYGON",
    "GeometryCollection": "GEOMETRYCOLLECTION",
}
_PART = {"MULTIPOINT": "POINT", "MULTILINESTRING": "LINESTRING", "MULTIPOLYGON": "POLYGON"}

# A shape is (type name, body): a point's body is its coordinates or None, a
# line's a list of coordinates, a polygon's a list of rings, others' shapes.
Shape = tuple[str, object]

_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_WKT_POINT = (
    rf"(?i)^\s*(?:SRID=(?P<srid>\d{{1,9}});)?\s*POINT\s*\(\s*(?P<x>{_NUMBER})\s+(?P<y>{_NUMBER})\s*\)\s*$"
)
_JSON_POINT = (
    rf'^\s*\{{\s*"type"\s*:\s*"Point"\s*,\s*"coordinates"\s*:\s*\[\s*(?P<x>{_NUMBER})\s*,\s*(?P<y>{_NUMBER})\s*\]\s*\}}\s*$'
)
_WKT_TOKEN = re.compile(rf"\s*(?:({_NUMBER}|nan|inf|-inf)(?![A-Za-z0-9_.])|([A-Za-z]+)|([(),]))", re.IGNORECASE)
_EWKT = re.compile(r"\s*SRID=(\d+);(.*)", re.DOTALL | re.IGNORECASE)


# Reading text ----------------------------------------------------------------


class _Wkt:
    """One WKT text, read token by token."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.rstrip()
        while at < len(text):
            found = _WKT_TOKEN.match(text, at)
            if found is None:
                raise ValueError(text[at:])
            number, word, mark = found.groups()
            self.tokens.append(float(number) if number else (word.upper() if word else mark))
            at = found.end()
        self.at = 0

    def next(self):
        self.at += 1
        return self.tokens[self.at - 1]

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def expect(self, mark: str) -> None:
        if self.next() != mark:
            raise ValueError(mark)

    def items(self, one: Callable) -> list:
        self.expect("(")
        out = [one()]
        while self.peek() == ",":
            self.next()
            out.append(one())
        self.expect(")")
        return out

    def coordinate(self) -> tuple:
        out = []
        while isinstance(self.peek(), float):
            out.append(self.next())
        if not 2 <= len(out) <= 4:
            raise ValueError("coordinate")
        return tuple(out[:2]) if len(out) == 3 and self.measured else tuple(out[:3])

    def single(self) -> tuple:
        (place,) = self.items(self.coordinate)
        return place

    def point_of_many(self) -> Shape:
        if self.peek() == "EMPTY":
            self.next()
            return "POINT", None
        return "POINT", self.single() if self.peek() == "(" else self.coordinate()

    def shape(self) -> Shape:
        name, self.measured = self.next(), False
        if not isinstance(name, str):
            raise ValueError("type")
        for suffix in ("ZM", "Z", "M", ""):
            if suffix and name.endswith(suffix) and name[: -len(suffix)] in (*TYPES, "LINEARRING"):
                name = name[: -len(suffix)]
                break
        else:
            suffix = self.next() if self.peek() in ("Z", "M", "ZM") else ""
        self.measured = suffix == "M"
        ring = name == "LINEARRING"
        name = "LINESTRING" if ring else name
        if name not in TYPES:
            raise ValueError(name)
        if self.peek() == "EMPTY":
            self.next()
            return name, None if name == "POINT" else []
        if name == "POINT":
            return name, self.single()
        if name == "LINESTRING":
            return name, self.items(self.coordinate)
        if name == "POLYGON":
            return name, self.items(self.ring)
        if name == "GEOMETRYCOLLECTION":
            return name, self.items(self.shape)
        if name == "MULTIPOINT":
            return name, self.items(self.point_of_many)
        if name == "MULTILINESTRING":
            return name, [("LINESTRING", line) for line in self.items(self.ring)]
        return name, [("POLYGON", rings) for rings in self.items(self.rings)]

    def ring(self) -> list:
        if self.peek() == "EMPTY":
            self.next()
            return []
        return self.items(self.coordinate)

    def rings(self) -> list:
        if self.peek() == "EMPTY":
            self.next()
            return []
        return self.items(self.ring)


def shape_of_wkt(text: str) -> tuple[Shape, int]:
    found, srid = _EWKT.match(text), 0
    if found:
        srid, text = int(found.group(1)), found.group(2)
    reader = _Wkt(text)
    shape = reader.shape()
    if reader.peek() is not None:
        raise ValueError("trailing text")
    return shape, srid


def shape_of_geojson(value: dict) -> Shape:
    kind = value["type"]
    if kind == "Feature":
        return shape_of_geojson(value["geometry"])
    if kind == "FeatureCollection":
        return "GEOMETRYCOLLECTION", [shape_of_geojson(f["geometry"]) for f in value["features"]]
    name = _GEOJSON[kind]
    if name == "GEOMETRYCOLLECTION":
        return name, [shape_of_geojson(g) for g in value["geometries"]]
    body = value["coordinates"]

    def place(c) -> tuple:
        if len(c) < 2:
            raise ValueError("coordinate")
        return tuple(float(v) for v in c[:3])

    if name == "POINT":
        return name, place(body) if body else None
    if name == "LINESTRING":
        return name, [place(c) for c in body]
    if name == "POLYGON":
        return name, [[place(c) for c in ring] for ring in body]
    part = next(k for k, v in _GEOJSON.items() if v == _PART[name])
    return name, [shape_of_geojson({"type": part, "coordinates": c}) for c in body]


# Reading and writing binary ----------------------------------------------------


class _Wkb:
    """One WKB or EWKB value, of either byte order."""

    def __init__(self, data: bytes):
        self.data, self.at, self.srid = data, 0, 0

    def take(self, form: str):
        size = struct.calcsize(form)
        if self.at + size > len(self.data):
            raise ValueError("short")
        out = struct.unpack_from(form, self.data, self.at)
        self.at += size
        return out

    def count(self, order: str, least: int) -> int:
        (n,) = self.take(order + "I")
        if n * least > len(self.data) - self.at:
            raise ValueError("count")
        return n

    def shape(self) -> Shape:
        (mark,) = self.take("B")
        if mark not in (0, 1):
            raise ValueError("byte order")
        order = "<" if mark else ">"
        (code,) = self.take(order + "I")
        has_z, has_m = bool(code & 0x80000000), bool(code & 0x40000000)
        if code & 0x20000000:
            (self.srid,) = self.take(order + "I")
        code &= 0x0FFFFFFF
        has_z, has_m = has_z or code // 1000 in (1, 3), has_m or code // 1000 in (2, 3)
        if code // 1000 > 3 or code % 1000 not in NAMES:
            raise ValueError("type")
        name, width = NAMES[code % 1000], 2 + has_z + has_m

        def coordinate() -> tuple:
            c = self.take(order + "d" * width)
            return c[: 2 + has_z]

        def coordinates() -> list:
            return [coordinate() for _ in range(self.count(order, 8 * width))]

        if name == "POINT":
            c = coordinate()
            return name, None if c[0] != c[0] and c[1] != c[1] else c
        if name == "LINESTRING":
            return name, coordinates()
        if name == "POLYGON":
            return name, [coordinates() for _ in range(self.count(order, 4))]
        return name, [self.shape() for _ in range(self.count(order, 5))]


def shape_of_wkb(data: bytes) -> tuple[Shape, int]:
    reader = _Wkb(data)
    shape = reader.shape()
    if reader.at != len(data):
        raise ValueError("trailing bytes")
    return shape, reader.srid


def _places(shape: Shape) -> Iterator[tuple]:
    name, body = shape
    if name == "POINT":
        if body is not None:
            yield body
    elif name == "LINESTRING":
        yield from body
    elif name == "POLYGON":
        for ring in body:
            yield from ring
    else:
        for part in body:
            yield from _places(part)


def _check(shape: Shape) -> None:
    """A line has no single point, a ring is closed."""
    name, body = shape
    if name == "LINESTRING" and len(body) == 1:
        raise ValueError("a line of one point")
    if name == "POLYGON":
        for ring in body:
            if ring and (len(ring) < 3 or ring[0][:2] != ring[-1][:2]):
                raise ValueError("an open ring")
    if name in _PART and any(part[0] != _PART[name] for part in body):
        raise ValueError("a part of another type")
    if name in _PART or name == "GEOMETRYCOLLECTION":
        for part in body:
            _check(part)


def wkb_of(shape: Shape) -> bytes:
    _check(shape)
    has_z = any(len(c) == 3 for c in _places(shape))
    width = 3 if has_z else 2
    out = bytearray()

    def place(c: tuple) -> None:
        filled = c if len(c) == width else (*c, float("nan"))
        out.extend(struct.pack(f"<{width}d", *filled))

    def write(part: Shape) -> None:
        name, body = part
        out.extend(struct.pack("<BI", 1, TYPES[name] + (1000 if has_z else 0)))
        if name == "POINT":
            place(body if body is not None else (float("nan"),) * width)
            return
        out.extend(struct.pack("<I", len(body)))
        for item in body:
            if name == "LINESTRING":
                place(item)
            elif name == "POLYGON":
                out.extend(struct.pack("<I", len(item)))
                for c in item:
                    place(c)
            else:
                write(item)

    write(shape)
    return bytes(out)


# Our own WKB: where its coordinates are ------------------------------------------


def runs(wkb: bytes) -> list[tuple[int, int, int]]:
    """``(offset, places, width)`` of every stretch of coordinates."""
    out: list[tuple[int, int, int]] = []

    def walk(at: int) -> int:
        (code,) = struct.unpack_from("<I", wkb, at + 1)
        at, width, kind = at + 5, 3 if code > 1000 else 2, code % 1000
        if kind == 1:
            out.append((at, 1, width))
            return at + 8 * width
        (n,) = struct.unpack_from("<I", wkb, at)
        at += 4
        if kind == 2:
            out.append((at, n, width))
            return at + 8 * width * n
        for _ in range(n):
            if kind == 3:
                (m,) = struct.unpack_from("<I", wkb, at)
                out.append((at + 4, m, width))
                at += 4 + 8 * width * m
            else:
                at = walk(at)
        return at

    walk(0)
    return out


def places_of(wkb: bytes) -> np.ndarray:
    """All ``(x, y)`` of a value, without the NaN of empty points."""
    parts = [
        np.frombuffer(wkb, "<f8", n * w, at).reshape(n, w)[:, :2] for at, n, w in runs(wkb) if n
    ]
    if not parts:
        return np.empty((0, 2))
    xy = np.concatenate(parts)
    return xy[~np.isnan(xy).all(axis=1)]


# Batches: plain points as matrices, the rest value by value ------------------------

POINT_HEAD = struct.pack("<BI", 1, 1)
_HEAD = np.frombuffer(POINT_HEAD, np.uint8)
_POINT = len(POINT_HEAD) + 16


def _bytes_of(numbers: np.ndarray) -> np.ndarray:
    """A matrix of doubles as a matrix of their bytes."""
    return np.ascontiguousarray(numbers, "<f8").view(np.uint8).reshape(len(numbers), 8 * numbers.shape[1])


def _point_block(xy: np.ndarray) -> np.ndarray:
    block = np.empty((len(xy), _POINT), np.uint8)
    block[:, : len(_HEAD)] = _HEAD
    block[:, len(_HEAD) :] = _bytes_of(xy)
    return block


def _binary(n: int, rows: np.ndarray, block: np.ndarray, others: dict[int, bytes]) -> pa.Array:
    """An array of ``n`` values: ``rows`` (ascending) from a matrix, ``others`` one by
    one, the remaining ones null."""
    if others:
        out: list = [None] * n
        data, width = block.tobytes(), block.shape[1]
        for k, i in enumerate(rows):
            out[i] = data[k * width : (k + 1) * width]
        for i, value in others.items():
            out[i] = value
        return pa.array(out, pa.binary())
    there = np.zeros(n, bool)
    there[rows] = True
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(there * block.shape[1], out=offsets[1:])
    valid = np.packbits(there, bitorder="little")
    buffers = [pa.py_buffer(valid.tobytes()), pa.py_buffer(offsets.tobytes()), pa.py_buffer(block.tobytes())]
    return pa.Array.from_buffers(pa.binary(), n, buffers)


def split_points(values: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
    """``(rows, xy, others)``: the plain 2D points, and all other values by row."""
    n = len(values)
    values = values.cast(pa.binary())
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    _, offset_buffer, data_buffer = values.buffers()
    if not n or data_buffer is None:
        return np.empty(0, int), np.empty((0, 2)), {}
    offsets = np.frombuffer(offset_buffer, np.int32)[values.offset : values.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8)
    rows = np.flatnonzero(valid & (np.diff(offsets) == _POINT))
    block = data[offsets[:-1][rows][:, None] + np.arange(_POINT)]
    plain = (block[:, : len(_HEAD)] == _HEAD).all(axis=1)
    rows, block = rows[plain], block[plain]
    xy = np.ascontiguousarray(block[:, len(_HEAD) :]).view("<f8").reshape(-1, 2)
    rest = valid.copy()
    rest[rows] = False
    return rows, xy, {int(i): values[int(i)].as_py() for i in np.flatnonzero(rest)}


def points_array(xs: pa.Array, ys: pa.Array) -> pa.Array:
    """WKB points of two columns of doubles; null where either is."""
    there = pc.and_(xs.is_valid(), ys.is_valid()).to_numpy(zero_copy_only=False)
    xy = np.column_stack(
        [xs.fill_null(0).to_numpy(zero_copy_only=False), ys.fill_null(0).to_numpy(zero_copy_only=False)]
    )
    rows = np.flatnonzero(there)
    return _binary(len(xs), rows, _point_block(xy[rows]), {})


def _slow(value, encoding: str) -> tuple[bytes | None, int]:
    try:
        if encoding == "wkt":
            shape, srid = shape_of_wkt(value)
        elif encoding == "geojson":
            shape, srid = shape_of_geojson(json.loads(value)), 0
        else:
            shape, srid = shape_of_wkb(bytes.fromhex(value.strip()) if encoding == "hexwkb" else value)
        return wkb_of(shape), srid
    # Whatever is wrong with the value, it is no geometry.
    except (ValueError, KeyError, TypeError, IndexError, AttributeError, struct.error, RecursionError):
        return None, 0


def decode_batch(values: pa.Array, encoding: str) -> tuple[pa.Array, np.ndarray]:
    """``(WKB, SRID)`` per value; null where it is none, SRID 0 where there is none."""
    n, srids = len(values), np.zeros(len(values), np.int64)
    rows, xy, rest = np.empty(0, int), np.empty((0, 2)), {}
    pattern = {"wkt": _WKT_POINT, "geojson": _JSON_POINT}.get(encoding)
    if encoding == "wkb":
        rows, xy, rest = split_points(values)
    elif pattern is not None and n:
        found = pc.extract_regex(values, pattern)
        hit = found.is_valid()
        rows = np.flatnonzero(hit.to_numpy(zero_copy_only=False))
        plain = found.filter(hit)
        xy = np.column_stack(
            [plain.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y")]
        )
        if encoding == "wkt" and len(rows):
            given = plain.field("srid")
            numbers = pc.if_else(pc.equal(given, ""), "0", given).fill_null("0")
            srids[rows] = numbers.cast(pa.int64()).to_numpy(zero_copy_only=False)
        left = np.flatnonzero(pc.and_not(values.is_valid(), hit).to_numpy(zero_copy_only=False))
        rest = {int(i): values[int(i)].as_py() for i in left}
    else:
        rest = {i: v for i, v in enumerate(values.to_pylist()) if v is not None}
    others = {}
    for i, value in rest.items():
        wkb, srids[i] = _slow(value, encoding)
        if wkb is not None:
            others[i] = wkb
    # No EPSG code is this large.
    return _binary(n, rows, _point_block(xy), others), np.where(srids > 2**31 - 1, 0, srids)


def summary(wkb: bytes) -> tuple[str, bool, bool, tuple | None]:
    """``(type name, has z, empty, (min x, min y, max x, max y))``."""
    (code,) = struct.unpack_from("<I", wkb, 1)
    xy = places_of(wkb)
    name, has_z = NAMES[code % 1000], code > 1000
    if not len(xy):
        return name, has_z, True, None
    low, high = xy.min(axis=0), xy.max(axis=0)
    return name, has_z, False, (float(low[0]), float(low[1]), float(high[0]), float(high[1]))


def summary_batch(values: pa.Array) -> pa.StructArray:
    """Type, Z, emptiness and bounds of every value."""
    n = len(values)
    rows, xy, others = split_points(values)
    there, has_z, empty = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    kinds, bounds = np.full(n, "POINT", object), np.full((n, 4), np.nan)
    there[rows], bounds[rows] = True, xy[:, [0, 1, 0, 1]]
    empty[rows] = np.isnan(xy).all(axis=1)
    for i, wkb in others.items():
        kinds[i], has_z[i], empty[i], box = summary(wkb)
        there[i] = True
        if box is not None:
            bounds[i] = box
    gone = ~there
    columns = [
        pa.array(kinds, pa.string(), mask=gone),
        pa.array(has_z, mask=gone),
        pa.array(empty, mask=gone),
        *[pa.array(bounds[:, k], pa.float64(), mask=gone | empty) for k in range(4)],
    ]
    names = ["type", "has_z", "empty", "min_x", "min_y", "max_x", "max_y"]
    return pa.StructArray.from_arrays(columns, names, mask=pa.array(gone))


def _transform_others(others: dict[int, bytes], srids: np.ndarray, target: int, project: Callable) -> dict[int, bytes]:
    out = dict(others)
    for source in {int(srids[i]) for i in others} - {0, target}:
        chosen = {i: bytearray(v) for i, v in others.items() if srids[i] == source}
        stretches = [(i, at, n, w) for i, v in chosen.items() for at, n, w in runs(v) if n]
        if not stretches:
            continue
        # All coordinates of one source CRS in the batch are projected together.
        xy = np.concatenate(
            [np.frombuffer(chosen[i], "<f8", n * w, at).reshape(n, w)[:, :2] for i, at, n, w in stretches]
        )
        x, y = project(xy[:, 0], xy[:, 1], source, target)
        start = 0
        for i, at, n, w in stretches:
            view = np.frombuffer(chosen[i], "<f8", n * w, at).reshape(n, w)
            view[:, 0], view[:, 1] = x[start : start + n], y[start : start + n]
            start += n
        out.update({i: bytes(v) for i, v in chosen.items()})
    return out


def transform_batch(values: pa.Array, srids: np.ndarray, target: int, project: Callable) -> pa.Array:
    """Every value in the CRS ``target``, each from its own; CRS 0 and equal ones stay."""
    rows, xy, others = split_points(values)
    moved, codes = xy.copy(), srids[rows]
    for source in np.unique(codes):
        if source not in (0, target):
            of = codes == source
            moved[of, 0], moved[of, 1] = project(xy[of, 0], xy[of, 1], int(source), target)
    return _binary(len(values), rows, _point_block(moved), _transform_others(others, srids, target, project))


def gpkg_batch(values: pa.Array, srid: int) -> pa.Array:
    """The export's binary per value: a header with SRS id and envelope, then the WKB."""
    with_envelope = b"GP\x00\x03" + struct.pack("<i", srid)
    empty = b"GP\x00\x11" + struct.pack("<i", srid)
    rows, xy, others = split_points(values)
    blank = np.isnan(xy).all(axis=1)
    made = {int(i): empty + block.tobytes() for i, block in zip(rows[blank], _point_block(xy[blank]))}
    rows, xy = rows[~blank], xy[~blank]
    head = np.broadcast_to(np.frombuffer(with_envelope, np.uint8), (len(rows), len(with_envelope)))
    block = np.hstack([head, _bytes_of(xy[:, [0, 0, 1, 1]]), _point_block(xy)])
    for i, wkb in others.items():
        _, _, is_empty, box = summary(wkb)
        if is_empty:
            made[i] = empty + wkb
        else:
            made[i] = with_envelope + struct.pack("<4d", box[0], box[2], box[1], box[3]) + wkb
    return _binary(len(values), rows, block, made)
