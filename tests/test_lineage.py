import random

import pytest
from pyspark.sql import functions as F

from lakewright.functions import sqltext
from lakewright.operators import lineage

SOURCE, TARGET = "sea.draft", "sea.archive"
MAP = [
    ("sea.draft.raw.measurements", "sea.archive.raw.measurements"),
    ("sea.draft.assessments", "sea.archive.assessments"),
    ("sea.draft.raw", "sea.archive.raw"),
]


def _rewrite(frame, sql, context=None, outside=None):
    views = frame([("v", sql, context)], "path string, sql string, context array<string>")
    known = None if outside is None else frame(outside, "path string")
    return lineage.rewrite_references(
        views, frame(MAP, "path string, target string"), SOURCE, TARGET, outside=known
    ).first()


@pytest.mark.parametrize(
    ("sql", "expected"),
    [
        ('SELECT * FROM "sea"."draft"."raw"."measurements"', 'SELECT * FROM "sea"."archive"."raw"."measurements"'),
        ("SELECT sea.draft.assessments.value FROM sea.draft.assessments",
         'SELECT "sea"."archive"."assessments"."value" FROM "sea"."archive"."assessments"'),
        ("SELECT * FROM Sea.DRAFT.Assessments", 'SELECT * FROM "sea"."archive"."assessments"'),
        ("SELECT * FROM sea.draft.assessments a JOIN ref.codes c ON a.k = c.k",
         'SELECT * FROM "sea"."archive"."assessments" a JOIN ref.codes c ON a.k = c.k'),
        ("SELECT 'sea.draft.assessments' AS x, 'it''s sea.draft.raw' FROM t",
         "SELECT 'sea.draft.assessments' AS x, 'it''s sea.draft.raw' FROM t"),
        ("SELECT 1 -- sea.draft.assessments\nFROM t /* sea.draft.raw */", "SELECT 1 -- sea.draft.assessments\nFROM t /* sea.draft.raw */"),
        ("SELECT 1.5 AS x FROM t", "SELECT 1.5 AS x FROM t"),
        # Not scanned, but below the source.
        ("SELECT * FROM sea.draft.later.t", 'SELECT * FROM "sea"."archive"."later"."t"'),
        # A namesake of the source is another folder.
        ("SELECT * FROM sea.drafts.t", "SELECT * FROM sea.drafts.t"),
        ("SELECT * FROM /* open sea.draft.raw", "SELECT * FROM /* open sea.draft.raw"),
        ("SELECT 'open sea.draft.raw", "SELECT 'open sea.draft.raw"),
    ],
)
def test_rules(frame, sql, expected):
    assert _rewrite(frame, sql)["new_sql"] == expected


def test_references(frame):
    row = _rewrite(frame, "SELECT * FROM sea.draft.assessments JOIN sea.draft.raw.measurements USING (k)")
    assert row["references"] == ["sea.draft.assessments", "sea.draft.raw.measurements"]


def test_context_is_spelled_out(frame):
    row = _rewrite(frame, "SELECT assessments.value AS v FROM assessments", ["sea", "draft"])
    assert row["new_sql"] == (
        'SELECT "sea"."archive"."assessments"."value" AS v FROM "sea"."archive"."assessments"'
    )


def test_context_does_not_touch_keywords_or_aliases(frame):
    # The context itself is an entry (a folder); SELECT must stay SELECT.
    row = _rewrite(frame, "SELECT m.v AS measurements FROM measurements m", ["sea", "draft", "raw"])
    assert row["new_sql"] == 'SELECT m.v AS measurements FROM "sea"."archive"."raw"."measurements" m'


def test_reference_outside_by_context(frame):
    row = _rewrite(frame, "SELECT codes FROM codes, other", ["ref", "lists"], ["ref.lists.codes", "ref.lists.other"])
    assert row["new_sql"] == 'SELECT codes FROM "ref"."lists"."codes", other'
    assert len(row["notes"]) == 1


def test_unknown_context_is_noted(frame):
    row = _rewrite(frame, "SELECT * FROM assessments")
    assert row["new_sql"] == "SELECT * FROM assessments"
    assert "context is unknown" in row["notes"][0]


def test_pieces_join_to_the_text(frame):
    texts = ["", "a.b", "a . b", '"x""y".z', "--", "/*", "'", "a-b/c", "1.5e3 t.$x ünï", "`q`.`w`", "x'" + "''" * 500 + "'"]
    df = frame(texts, "sql string").select("sql", sqltext.pieces(F.col("sql")).alias("p"))
    for row in df.collect():
        assert "".join(row["p"]) == row["sql"]


def test_a_long_literal_is_one_piece(frame):
    text = "SELECT '" + "x." * 100_000 + "' FROM t"
    row = frame([text], "sql string").select(sqltext.pieces(F.col("sql")).alias("p")).first()
    assert len(row["p"]) == 7


def _levels(frame, views, edges):
    rows = lineage.view_levels(frame(views, "path string"), frame(edges, "path string, needs string")).collect()
    return {r["path"]: r["level"] for r in rows}


def test_levels(frame):
    edges = [("c", "b"), ("c", "a"), ("b", "A"), ("a", "a"), ("a", "table")]
    assert _levels(frame, ["a", "b", "c", "d"], edges) == {"a": 0, "b": 1, "c": 2, "d": 0}


def test_a_cycle_has_no_level(frame):
    assert _levels(frame, ["a", "b", "c", "d"], [("a", "b"), ("b", "a"), ("c", "a")]) == {
        "a": None, "b": None, "c": None, "d": 0,
    }


def _levels_of(spark, views, edges):
    frames = spark.createDataFrame([(v,) for v in views], "path string"), spark.createDataFrame(edges, "path string, needs string")
    return {r.path: r.level for r in lineage.view_levels(*frames).collect()}


def test_a_long_chain_takes_few_jobs(spark):
    tracker, group = spark.sparkContext.statusTracker(), "a chain of views"
    names = [f"a.v{i}" for i in range(500)]
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = _levels_of(spark, names, list(zip(names[1:], names, strict=False)))
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {name: i for i, name in enumerate(names)}
    assert jobs < 45


@pytest.mark.parametrize("seed", range(4))
def test_levels_of_drawn_graphs(spark, seed):
    draw = random.Random(seed)
    names = [f"v{i}" for i in range(40)]
    edges = {(a, b) for a, b in (draw.choices(names, k=2) for _ in range(70)) if seed % 2 or a > b} | {("v1", "elsewhere"), ("elsewhere", "v2"), ("v3", "v3")}
    needs = {v: {b for a, b in edges if a == v and b != v and b in names} for v in names}
    want, left = {}, set(names)
    while ready := {v for v in left if not needs[v] & left}:
        want |= {v: 1 + max((want[n] for n in needs[v]), default=-1) for v in ready}
        left -= ready
    assert _levels_of(spark, names, sorted(edges)) == want | dict.fromkeys(left)


def test_levels_of_no_views(spark):
    assert _levels_of(spark, [], []) == {}
    assert _levels_of(spark, ["A.b"], [("a.B", "a.b")]) == {"A.b": 0}
    assert _levels_of(spark, ["a", "b"], [("A", "b"), ("b", "a")]) == {"a": None, "b": None}
