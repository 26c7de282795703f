import pytest
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import paths
from lakewright.lake import decode_name, encode_name

STORAGE = [
    ("lake.water.rivers", "lake/water/rivers"),
    (" lake.water.rivers. ", "lake/water/rivers"),
    ("lake/water/rivers", "lake/water/rivers"),
    ("lake/water/v1.0", "lake/water/v1.0"),
    ("rivers", "rivers"),
    ('lake."plain_name".rivers', "lake/plain_name/rivers"),
    ('lake."river names"."v1.0"', "lake/river names/v1.0"),
    ('src."a-b-01".data."[X 14_40] All waters."', "src/a-b-01/data/[X 14_40] All waters."),
    ('lake."say ""hi""".x', 'lake/say "hi"/x'),
    ('"a/b".c', "a/b/c"),
    ('lake/"v1.0"/x', "lake/v1.0/x"),
]
CATALOG = [
    ("lake/water_plans/rivers", "lake.water_plans.rivers"),
    ("lake/river names/v1.0", 'lake."river names"."v1.0"'),
    ("src/a-b-01/x", 'src."a-b-01".x'),
    ('lake."say ""hi"""', 'lake."say ""hi"""'),
]


def test_storage_form(frame):
    df = frame([p for p, _ in STORAGE], "path string")
    got = {r[0]: r[1] for r in df.select("path", paths.to_storage(F.col("path"))).collect()}
    assert got == dict(STORAGE)
    for path, expected in STORAGE:
        assert "/".join(paths.split_path(path)) == expected


def test_catalog_form(frame):
    df = frame([p for p, _ in CATALOG], "path string")
    twice = paths.to_storage(paths.to_catalog(F.col("path"))) == paths.to_storage(F.col("path"))
    rows = df.select("path", paths.to_catalog(F.col("path")), twice).collect()
    assert {r[0]: r[1] for r in rows} == dict(CATALOG)
    assert all(r[2] for r in rows)


def test_unclosed_quote(frame):
    df = frame(['lake."water.rivers'], "path string")
    assert df.select(paths.segments(F.col("path"))).first()[0] is None
    with pytest.raises(LakeError, match="unclosed quote"):
        paths.split_path('lake."water.rivers')


def test_parts_of_a_path(frame):
    df = frame(["a.b.c", "a"], "path string")
    p = F.col("path")
    rows = df.select(paths.leaf(p), paths.parent(p), paths.ancestors(p), paths.is_inside(p, F.lit("A.B"))).collect()
    assert tuple(rows[0]) == ("c", "a.b", ["a", "a.b"], True)
    assert tuple(rows[1]) == ("a", None, [], False)


def test_a_folder_is_not_inside_its_namesake(frame):
    df = frame(["a.bc.t", "a.b.t", "a.b"], "path string")
    got = [r[0] for r in df.filter(paths.is_inside(F.col("path"), F.lit("a.b"))).collect()]
    assert got == ["a.b.t", "a.b"]


@pytest.mark.parametrize("name", ["plain", "v1.0", "a_b", "a__b", "_x", "x_", "a_x", "tbl$1", "åre", "a b", "_x5fx"])
def test_database_names_are_reversible(name):
    coded = encode_name(name)
    assert decode_name(coded) == name
    assert "__" not in coded and not coded.startswith("_") or coded.startswith("_x")
