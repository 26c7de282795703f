import pytest
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.operators import listing

NAMES = ["Report_2025.PDF", "report_2024.pdf", "annex/a.xlsx", "annex/b.csv", "notes.txt"]
CASES = [
    (None, NAMES),
    ("", NAMES),
    ("*.pdf", NAMES[:2]),
    (".PDF", NAMES[:2]),
    ("pdf", NAMES[:2]),
    ("report_202?.*", NAMES[:2]),
    ("*2025*", NAMES[:1]),
    ("[ab].*", NAMES[2:4]),
    ("[!a].*", ["annex/b.csv"]),
    ("annex/*", NAMES[2:4]),
    ("annex", NAMES[2:4]),
    ([".xlsx", "*.csv"], NAMES[2:4]),
    (("notes*",), NAMES[4:]),
    (".tx", []),
    ("*.docx", []),
    ("[", []),
]


@pytest.mark.parametrize(("pattern", "expected"), CASES)
def test_patterns(frame, pattern, expected):
    got = listing.match_names(frame(NAMES, "name string"), pattern).collect()
    assert sorted(r["name"] for r in got) == sorted(expected)


def test_a_pattern_is_text():
    with pytest.raises(TypeError):
        from lakewright.functions.filenames import patterns

        patterns([1])


def test_invalid_names(frame):
    names = ["ok.txt", " ", "a/b", "..", "a\\b", "a:b", "tab\there", "\n"]
    got = {r["name"]: r["problem"] for r in listing.invalid_file_names(frame(names, "name string")).collect()}
    assert got == {
        " ": "empty", "a/b": "path", "..": "path", "a\\b": "path",
        "a:b": "character", "tab\there": "character", "\n": "empty",
    }


def test_relative_names(frame):
    names = ["annex/a.xlsx", "/annex/a.xlsx/", "annex//a", "annex/../a", "annex/a?b", "/"]
    got = {r["name"]: r["problem"] for r in listing.invalid_file_names(frame(names, "name string"), relative=True).collect()}
    assert got == {"annex//a": "empty", "annex/../a": "path", "annex/a?b": "character", "/": "empty"}


def _renames(frame, pairs):
    return frame(pairs, "name string, new_name string")


def test_rename(frame):
    files = frame(["a.pdf", "b.pdf"], "name string")
    got = listing.rename_files(files, _renames(frame, [("a.pdf", "c.pdf"), (" b.pdf ", " ")])).collect()
    assert {r["name"]: r["new_name"] for r in got} == {"a.pdf": "c.pdf", "b.pdf": "b.pdf"}


@pytest.mark.parametrize(
    ("pairs", "message"),
    [([("x.pdf", "y.pdf")], "names no file"), ([("a.pdf", "b.pdf")], "several files"), ([("a.pdf", "x/y")], "not a valid")],
)
def test_refused_renames(frame, pairs, message):
    with pytest.raises(LakeError, match=message):
        listing.rename_files(frame(["a.pdf", "b.pdf"], "name string"), _renames(frame, pairs))


def test_all_taken_targets_are_listed(frame):
    files, there = frame(["t/a", "t/b", "t/c"], "path string"), frame(["t/a", "t/c", "t/z"], "path string")
    got = listing.already_there(files, there).orderBy(F.col("path")).collect()
    assert [r["path"] for r in got] == ["t/a", "t/c"]
