"""All issues of records: lines, paths, messages; and the rules read from schemas."""

from __future__ import annotations

import pytest

from lakewright.functions import xsd
from lakewright.operators.validation import iso_issues

MDB = "http://standards.iso.org/iso/19115/-3/mdb/2.0"
MAIN = f"""<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:m="{MDB}" xmlns:p="urn:parts" targetNamespace="{MDB}" elementFormDefault="qualified">
<xs:import namespace="urn:parts" schemaLocation="sub/parts.xsd"/>
<xs:element name="MD_Metadata"><xs:complexType><xs:sequence>
  <xs:element name="key" type="xs:integer"/>
  <xs:element name="when" type="xs:date" minOccurs="0" maxOccurs="2"/>
  <xs:choice minOccurs="0" maxOccurs="unbounded"><xs:element ref="p:shape"/><xs:element name="note" type="m:noteType"/></xs:choice>
  <xs:element name="level" type="m:levelType" minOccurs="0"/>
  <xs:element name="free" type="xs:anyType" minOccurs="0"/>
</xs:sequence></xs:complexType></xs:element>
<xs:complexType name="noteType"><xs:sequence><xs:element name="by" type="xs:string"/><xs:element name="note" type="m:noteType" minOccurs="0"/></xs:sequence>
  <xs:attribute name="lang" use="required"/></xs:complexType>
<xs:simpleType name="levelType"><xs:restriction base="xs:string"><xs:enumeration value="low"/><xs:enumeration value="high"/></xs:restriction></xs:simpleType>
</xs:schema>"""
PARTS = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:p="urn:parts" targetNamespace="urn:parts" elementFormDefault="qualified">
<xs:element name="shape" abstract="true" type="p:baseType"/>
<xs:element name="round" substitutionGroup="p:shape" type="p:roundType"/>
<xs:element name="flat" substitutionGroup="p:shape"/>
<xs:complexType name="baseType"><xs:sequence><xs:element name="colour" type="xs:string"/></xs:sequence></xs:complexType>
<xs:complexType name="roundType"><xs:complexContent><xs:extension base="p:baseType"><xs:sequence><xs:element name="radius" type="xs:decimal"/></xs:sequence></xs:extension></xs:complexContent></xs:complexType>
</xs:schema>"""


@pytest.fixture(scope="module")
def schema(tmp_path_factory):
    top = tmp_path_factory.mktemp("xsd")
    (top / "sub").mkdir()
    (top / "main.xsd").write_text(MAIN)
    (top / "sub" / "parts.xsd").write_text(PARTS)
    return str(top / "main.xsd")


def record(body, root="m:MD_Metadata", head=""):
    return f'{head}<{root} xmlns:m="{MDB}" xmlns:p="urn:parts">\n{body}\n</{root}>'


@pytest.fixture
def issues(spark, schema):
    def run(*docs, xsd=schema):
        frame = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "id string, xml string")
        return sorted(((r.id, r.line, r.message, r.path) for r in iso_issues(frame, xsd).collect()), key=str)

    return run


WHOLE = """<m:key>7</m:key>
<m:when>2024-01-31</m:when><m:when>2024-02-01Z</m:when>
<p:round><p:colour>red</p:colour><p:radius>1.5</p:radius></p:round><m:note lang="en"><m:by>x</m:by><m:note lang="de"><m:by>y</m:by></m:note></m:note>
<p:flat><p:colour>blue</p:colour></p:flat>
<m:level>low</m:level><m:free><any><thing/></any></m:free>"""


def test_valid(issues):
    assert issues(record(WHOLE), record("<m:key>-1</m:key>")) == []


def test_two_faults_are_two_rows(issues):
    found = issues(record("<m:key>seven</m:key>\n<m:when>2024-13-01</m:when>\n<m:extra/>"))
    assert found == [
        ("0", 2, "m:key holds 'seven', which is no integer", "/m:MD_Metadata/m:key"),
        ("0", 3, "m:when holds '2024-13-01', which is no date", "/m:MD_Metadata/m:when"),
        ("0", 4, "m:extra is not expected in m:MD_Metadata", "/m:MD_Metadata/m:extra"),
    ]


def test_occurrence_and_nesting(issues):
    body = "<m:when>2024-01-01</m:when>\n<m:when>2024-01-02</m:when>\n<m:when>2024-01-03</m:when>\n<m:when>2024-01-04</m:when>\n<m:note lang='a'><m:by/><m:note><m:by/><m:by/></m:note></m:note>\n<p:round><p:colour/></p:round>"
    assert issues(record(body)) == [
        ("0", 1, "m:MD_Metadata has 0 of key, at least 1", "/m:MD_Metadata"),
        ("0", 4, "m:when occurs 4 times in m:MD_Metadata, at most 2", "/m:MD_Metadata/m:when[3]"),
        ("0", 6, "m:by occurs 2 times in m:note, at most 1", "/m:MD_Metadata/m:note/m:note/m:by[2]"),
        ("0", 6, "m:note has no attribute lang", "/m:MD_Metadata/m:note/m:note"),
        ("0", 7, "p:round has 0 of radius, at least 1", "/m:MD_Metadata/p:round"),
    ]


def test_values_and_substitutes(issues):
    body = "<m:key>1</m:key><p:flat><p:colour/><p:radius>1</p:radius></p:flat>\n<p:shape/><m:level>middle</m:level>"
    assert issues(record(body)) == [
        ("0", 2, "p:radius is not expected in p:flat", "/m:MD_Metadata/p:flat/p:radius"),
        ("0", 3, "m:level holds 'middle', which is not listed", "/m:MD_Metadata/m:level"),
        ("0", 3, "p:shape is not expected in m:MD_Metadata", "/m:MD_Metadata/p:shape"),
    ]


def test_order_alone_is_told_without_a_place(issues):
    assert issues(record("<m:when>2024-01-01</m:when><m:key>1</m:key>")) == [("0", None, None, None)]


def test_other_issues(issues):
    entity = record("<m:key>1</m:key>\n<m:level>&a;&b;</m:level>\n<m:free>&a; &amp; &#65;</m:free>", head='<!DOCTYPE r [<!ENTITY a "low"><!ENTITY b "high">]>\n')
    found = issues(record("<m:key>1</m:kay>"), record("", "m:Other"), entity, record("<m:key>x</m:key>"))
    assert found[0] == ("0", 2, "mismatched tag", None)
    assert found[1][:2] == ("1", 1) and "m:Other" not in found[1][2] and "root element is Other" in found[1][2]
    assert found[2:5] == [
        ("2", 4, "entity &a; is not allowed", "/m:MD_Metadata/m:level"),
        ("2", 4, "entity &b; is not allowed", "/m:MD_Metadata/m:level"),
        ("2", 5, "entity &a; is not allowed", "/m:MD_Metadata/m:free"),
    ]
    assert found[5:] == [("3", 2, "m:key holds 'x', which is no integer", "/m:MD_Metadata/m:key")]


def test_without_a_schema(issues):
    assert issues(record("<m:anything/>"), record("", "m:Other"), xsd=None)[0][0] == "1"


def test_rules(schema):
    from pathlib import Path

    rules = xsd.read_rules(schema, lambda p: Path(p).read_text())
    root = rules.types[rules.roots[f"{{{MDB}}}MD_Metadata"]]
    assert root.slots[f"{{{MDB}}}when"] == (0, 2) and root.slots["{urn:parts}shape"] == (0, xsd.UNBOUNDED)
    assert set(root.names) == {f"{{{MDB}}}{n}" for n in ("key", "when", "note", "level", "free")} | {"{urn:parts}round", "{urn:parts}flat"}
    assert rules.types["{urn:parts}roundType"].slots == {"{urn:parts}colour": (1, 1), "{urn:parts}radius": (1, 1)}
    assert rules.types[f"{{{MDB}}}noteType"].required == {"lang"}


def test_elements_are_told_in_small_batches():
    class Flagged:
        """Hands out the function that runs in a task."""

        def mapInArrow(self, function, schema):
            return function

    import pyarrow as pa
    from lakewright.operators import validation

    record = {"id": "a", "issue": None, "line": None, "message": None, "xml": "<r>" + "<a/>" * 50 + "</r>"}
    schema = pa.schema([(n, pa.int32() if n == "line" else pa.string()) for n in record])
    told = list(validation.elements(Flagged(), None)([pa.RecordBatch.from_pylist([record] * 300, schema=schema)]))
    assert sum(b.num_rows for b in told) == 300 * 51
    assert max(b.num_rows for b in told) <= validation.TOLD + 51
