import pytest

from lakewright.operators import records as rec

NS = 'xmlns:mdb="http://standards.iso.org/iso/19115/-3/mdb/2.0" xmlns:gco="g" xmlns:mcc="m" xmlns:cit="c" xmlns:mri="r"'


def _xml(body, root="mdb:MD_Metadata", head="", ns=NS):
    return f"{head}<{root} {ns}>{body}</{root}>"


BODY = (
    "<mdb:metadataIdentifier><mcc:MD_Identifier><mcc:code><gco:CharacterString> u1 </gco:CharacterString></mcc:code>"
    "</mcc:MD_Identifier></mdb:metadataIdentifier>"
    "<mdb:dateInfo><cit:CI_Date><cit:date><gco:Date>2024-03-01</gco:Date></cit:date><cit:dateType>"
    '<cit:CI_DateTypeCode codeListValue="creation"/></cit:dateType></cit:CI_Date></mdb:dateInfo>'
    "<mdb:identificationInfo><mri:MD_DataIdentification><mri:citation><cit:CI_Citation><cit:title>Plain</cit:title>"
    "</cit:CI_Citation></mri:citation></mri:MD_DataIdentification></mdb:identificationInfo>"
)


@pytest.fixture
def parse(frame):
    return lambda xml, id="u1": rec.iso_parse(frame([(id, xml)], "id string, xml string")).first()


def test_fields(parse):
    row = parse(_xml(BODY))
    assert (row["uuid"], row["title"], row["edition"], row["error"], row["children"]) == ("u1", "Plain", None, None, [])
    assert row["created"].isoformat() == "2024-03-01T00:00:00" and row["revised"] is None


@pytest.mark.parametrize(
    ("xml", "error"),
    [
        ("not xml", rec.NOT_WELL_FORMED),
        (_xml(BODY)[:-5], rec.NOT_WELL_FORMED),
        (_xml(BODY, root="mdb:Other"), rec.WRONG_ROOT),
        (_xml(BODY, ns=NS.replace("mdb/2.0", "mdb/1.0")), rec.WRONG_ROOT),
        (_xml(BODY, head="<!-- <mdb:Other> -->\n<?x y?>\n"), None),
        ('<MD_Metadata xmlns="http://standards.iso.org/iso/19115/-3/mdb/2.0"><a/></MD_Metadata>', None),
    ],
)
def test_errors(parse, xml, error):
    assert parse(xml)["error"] == error


def test_an_external_entity_is_not_read(parse, tmp_path):
    secret = tmp_path / "secret.txt"
    secret.write_text("hidden")
    xml = _xml(BODY.replace("Plain", "&x;"), head=f'<!DOCTYPE r [<!ENTITY x SYSTEM "file://{secret}">]>')
    assert "hidden" not in str(parse(xml))


def test_uuid_mismatch(frame):
    parsed = rec.iso_parse(frame([("u1", _xml(BODY)), ("u2", _xml(BODY))], "id string, xml string"))
    assert [tuple(r) for r in rec.uuid_mismatches(parsed).collect()] == [("u2", "u1")]


@pytest.mark.parametrize(
    ("statuses", "current"), [(("superseded", None), "c1"), ((None, None), None), (("superseded", "superseded"), None)]
)
def test_current_release(frame, statuses, current):
    parsed = frame([("s", ["c0", "c1"], None)], "id string, children array<string>, error string")
    index = frame(
        [(f"c{i}", f"release {i}", "01.00", "2026-06-02", s) for i, s in enumerate(statuses)],
        "uuid string, title string, edition string, publication_date string, status string",
    )
    row = rec.current_release(parsed, index).first()
    assert row["current"] == current and len(row["candidates"]) == 2
    assert (row["error"] is None) == (current is not None)


def test_validation(frame):
    docs = [
        ("ok", _xml(BODY)), ("broken", "<a>"), ("root", "\n" + _xml(BODY, root="mdb:Other")),
        ("entity", _xml(BODY.replace("Plain", "&e;"), head='<!DOCTYPE r [<!ENTITY e "x">]>\n')),
        ("escaped", _xml(BODY.replace("Plain", "a &amp; b &#65; <![CDATA[&e;]]>"))),
    ]
    rows = {r["id"]: r for r in rec.iso_validate(frame(docs, "id string, xml string")).collect()}
    assert {k: r["issue"] for k, r in rows.items()} == {
        "broken": rec.NOT_WELL_FORMED, "root": rec.WRONG_ROOT, "entity": "entity reference",
    }
    assert rows["root"]["line"] == 2 and rows["entity"]["line"] == 2
