import pytest

from lakewright.errors import LakeError
from lakewright.operators import metadata as md

SCHEMA = "path string, kind string, tags array<string>, wiki string"


@pytest.fixture
def meta(frame):
    old = 'Intro\n\n# Meta Data\n\tOwner : me\n<meta>\n<tag name="owner" value="me" title="Owner"/>\n</meta>'
    return frame(
        [("a.f", "FOLDER", None, old), ("a.f.t", "TABLE", ["x", "y"], None), ("a.f.v", "VIEW", [], "text")], SCHEMA
    )


def _changes(frame, path, tags):
    return frame([(path, tags)], "path string, tags array<string>")


def _tags(df, path="a.f.t"):
    return df.filter(f"path = '{path}'").first()["tags"]


def test_tags(meta, frame):
    assert _tags(md.tags_set(meta, _changes(frame, "a.f.t", ["z"]))) == ["z"]
    assert _tags(md.tags_add(meta, _changes(frame, "a.f.t", ["y", "z"]))) == ["x", "y", "z"]
    assert _tags(md.tags_remove(meta, _changes(frame, "a.f.t", ["x", "none"]))) == ["y"]
    assert _tags(md.tags_set(meta, _changes(frame, "a.f.t", ["z"])), "a.f.v") == []
    with pytest.raises(LakeError, match="is a folder"):
        md.tags_add(meta, _changes(frame, "a.f", ["z"]))
    with pytest.raises(LakeError, match="does not exist"):
        md.tags_add(meta, _changes(frame, "a.none", ["z"]))


def test_wiki(meta, frame):
    assert md.wiki_get(meta, "a.f.v") == "text"
    with pytest.raises(LakeError, match="no wiki"):
        md.wiki_get(meta, "a.f.t")
    gone = md.wiki_upsert(meta, frame([("a.f.v", "")], "path string, wiki string"))
    with pytest.raises(LakeError, match="no wiki"):
        md.wiki_get(gone, "a.f.v")


def test_block(meta, frame):
    entry = "path string, entries array<struct<tag_name:string,tag_value:string,tag_title:string>>"
    added = frame([("a.f", [("note", 'say "hi" & <go>', "Note")]), ("a.f.t", [("n", "v", "t")])], entry)
    out = md.wiki_meta_render(meta, added, overwrite=False)
    rows = md.wiki_meta_parse(out).orderBy("position").collect()
    assert [(r["base"], r["tag_name"], r["tag_value"]) for r in rows] == [
        ("Intro", "owner", "me"), ("Intro", "note", 'say "hi" & <go>'),
    ]
    assert out.filter("path = 'a.f.t'").first()["wiki"] is None
    replaced = md.wiki_meta_render(meta, added)
    assert [r["tag_name"] for r in md.wiki_meta_parse(replaced).collect()] == ["note"]
    assert md.wiki_meta_value(out, "owner", "tag_value").first()["tag_value"] == "me"
    assert md.wiki_meta_value(out, "none").count() == 2
    emptied = md.wiki_meta_render(meta, frame([("a.f", [])], entry))
    assert md.wiki_get(emptied, "a.f") == "Intro"
    with pytest.raises(LakeError, match="lacks"):
        md.wiki_meta_render(meta, frame([("a.f", [("x", None, "y")])], entry))
    with pytest.raises(LakeError, match="field"):
        md.wiki_meta_value(meta, "owner", "tag_name")
