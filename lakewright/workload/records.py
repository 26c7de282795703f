"""Metadata record queries: one XML document per given document, whole text inside."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewright.operators import records as rec
from lakewright.operators.validation import iso_issues
from lakewright.session import scratch
from lakewright.workload.inputs import read

_NS = " ".join(
    f'xmlns:{p}="http://standards.iso.org/iso/19115/-3/{p}/{v}"'
    for p, v in (("mdb", "2.0"), ("mcc", "1.0"), ("mri", "1.0"), ("cit", "2.0"), ("gco", "1.0"), ("gcx", "1.0"))
)


def _date(kind: str, element: str, value):
    return F.concat(
        F.lit(f"<mdb:dateInfo><cit:CI_Date><cit:date><gco:{element}>"), value,
        F.lit(f'</gco:{element}></cit:date><cit:dateType><cit:CI_DateTypeCode codeListValue="{kind}"/></cit:dateType></cit:CI_Date></mdb:dateInfo>\n'),
    )


def documents(spark, sf):
    """Record ``rec-<id>``: every 10th is cut off, every 11th has another root,
    every 13th identifies another record, every 5th is a series."""
    k = F.col("doc_id")
    text = F.regexp_replace("text", r"[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}]", "")
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    name = F.concat(F.lit("Data of "), "source", F.lit(" &amp; more"))
    title = (
        F.when(k % 4 == 1, F.concat(F.lit('<gcx:Anchor href="x">'), name, F.lit("</gcx:Anchor>")))
        .when(k % 4 == 2, name)
        .otherwise(F.concat(F.lit("<gco:CharacterString> "), name, F.lit(" </gco:CharacterString>")))
    )
    day = F.lpad((k % 28 + 1).cast("string"), 2, "0")
    revised = F.when(
        k % 3 == 0,
        F.concat(
            _date("revision", "DateTime", F.concat(F.lit("2024-06-"), day, F.lit("T10:00:00+02:00"))),
            _date("revision", "DateTime", F.lit("2023-01-01T00:00:00Z")),
        ),
    ).otherwise(F.lit(""))

    def member(n, kind):
        return F.concat(
            F.lit(f'<mri:associatedResource><mri:MD_AssociatedResource><mri:associationType><mri:DS_AssociationTypeCode codeListValue="{kind}"/></mri:associationType><mri:metadataReference uuidref="rec-'),
            (k + n).cast("string"), F.lit('"/></mri:MD_AssociatedResource></mri:associatedResource>'),
        )

    members = F.when(
        k % 5 == 0, F.concat(member(1, "isComposedOf"), member(2, "isComposedOf"), member(3, "crossReference"))
    ).otherwise(F.lit(""))
    root = F.when(k % 11 == 10, "MD_Record").otherwise("MD_Metadata")
    uuid = F.concat(F.lit("rec-"), F.when(k % 13 == 12, k + 1000000).otherwise(k))
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<!-- a record -->\n<mdb:'), root, F.lit(f" {_NS}>\n"),
        F.lit("<mdb:metadataIdentifier><mcc:MD_Identifier><mcc:code><gco:CharacterString>"), uuid,
        F.lit("</gco:CharacterString></mcc:code></mcc:MD_Identifier></mdb:metadataIdentifier>\n"),
        F.lit('<mdb:metadataScope><mdb:MD_MetadataScope><mdb:resourceScope><mcc:MD_ScopeCode codeListValue="'),
        F.when(k % 5 == 0, "series").otherwise("dataset"),
        F.lit('"/></mdb:resourceScope></mdb:MD_MetadataScope></mdb:metadataScope>\n'),
        _date("creation", "Date", F.concat(F.lit("2024-01-"), day)), revised,
        F.lit("<mdb:identificationInfo><mri:MD_DataIdentification><mri:citation><cit:CI_Citation><cit:title>"), title,
        F.lit("</cit:title><cit:edition><gco:CharacterString>"), F.col("lang"),
        F.lit("</gco:CharacterString></cit:edition></cit:CI_Citation></mri:citation><mri:abstract><gco:CharacterString>"), text,
        F.lit("</gco:CharacterString></mri:abstract>"), members,
        F.lit("</mri:MD_DataIdentification></mdb:identificationInfo>\n"),
        F.when(k % 10 == 9, "").otherwise(F.concat(F.lit("</mdb:"), root, F.lit(">"))),
    )
    return read(spark, sf, "documents").select(F.concat(F.lit("rec-"), k).alias("id"), xml.alias("xml"))


def _parsed(spark, sf):
    return rec.iso_parse(documents(spark, sf))


def _stamp(column):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


def q_iso_parse(spark, sf):
    return _parsed(spark, sf).select(
        "id", "uuid", "title", "edition", "hierarchy_level", _stamp("created").alias("created"),
        _stamp("revised").alias("revised"), F.array_join("children", ",").alias("children"), "error",
    )


def q_iso_date_stamp(spark, sf):
    return _parsed(spark, sf).select("id", _stamp(rec.date_stamp()).alias("stamp"))


def q_iso_uuid_mismatch(spark, sf):
    return rec.uuid_mismatches(_parsed(spark, sf))


def q_iso_children(spark, sf):
    return rec.series_members(_parsed(spark, sf)).withColumn("position", F.col("position").cast("long"))


def _index(spark, sf):
    k = F.col("doc_id")
    return read(spark, sf, "documents").select(
        F.concat(F.lit("rec-"), k).alias("uuid"), F.col("source").alias("title"), F.col("lang").alias("edition"),
        F.lit("2024-01-01").alias("publication_date"), F.when(k % 3 == 0, "superseded").alias("status"),
    )


def q_current_release(spark, sf):
    out = rec.current_release(_parsed(spark, sf), _index(spark, sf))
    return out.select("id", "current", F.array_join("candidates", "|").alias("candidates"), "error")


def q_iso_provenance(spark, sf):
    return rec.provenance_tags(_parsed(spark, sf))


# Only the root and its first element are fixed; the rest may be anything.
_XSD = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:m="http://standards.iso.org/iso/19115/-3/mdb/2.0"
  targetNamespace="http://standards.iso.org/iso/19115/-3/mdb/2.0" elementFormDefault="qualified">
<xs:element name="MD_Metadata"><xs:complexType><xs:sequence>
<xs:element name="metadataIdentifier" type="xs:anyType"/>
<xs:element name="metadataScope" type="xs:anyType"/>
<xs:element name="dateInfo" type="xs:anyType" maxOccurs="2"/>
<xs:element name="identificationInfo" type="xs:anyType"/>
</xs:sequence></xs:complexType></xs:element></xs:schema>
"""


def q_iso_validate(spark, sf):
    # A schema that allows two dates: records with three are not valid.
    folder = scratch(spark, "xsd")
    spark.createDataFrame([(_XSD.replace("\n", " "),)], "value string").coalesce(1).write.text(folder)
    path = spark.read.text(folder).select(F.input_file_name()).first()[0]
    docs = documents(spark, sf)
    k = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    # Every 17th whole record declares an entity and uses it.
    with_entity = F.replace(
        F.replace("xml", F.lit("<!-- a record -->"), F.lit('<!DOCTYPE r [<!ENTITY e "x">]>')), F.lit("&amp; more"), F.lit("&e; more")
    )
    return rec.iso_validate(docs.withColumn("xml", F.when(k % 17 == 0, with_entity).otherwise(F.col("xml"))), path).select(
        "id", "issue", F.col("line").cast("long").alias("line")
    )


# More is fixed: a scope with a code, two dates at most, a citation.
_CLOSED = _XSD.replace('name="metadataScope" type="xs:anyType"', 'name="metadataScope" type="m:scopeType"').replace(
    "</xs:schema>",
    """<xs:complexType name="scopeType"><xs:sequence><xs:element name="MD_MetadataScope"><xs:complexType><xs:sequence>
<xs:element name="resourceScope" type="xs:anyType"/></xs:sequence><xs:attribute name="level" use="required"/></xs:complexType></xs:element>
</xs:sequence></xs:complexType></xs:schema>""",
)


def q_iso_issues(spark, sf):
    folder = scratch(spark, "xsd")
    spark.createDataFrame([(_CLOSED.replace("\n", " "),)], "value string").coalesce(1).write.text(folder)
    path = spark.read.text(folder).select(F.input_file_name()).first()[0]
    k = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    # All scopes lack their level but every 4th; every 7th has an element too many; every 17th uses an entity twice.
    xml = F.when(k % 4 == 0, F.replace("xml", F.lit("<mdb:MD_MetadataScope>"), F.lit('<mdb:MD_MetadataScope level="1">'))).otherwise(F.col("xml"))
    xml = F.when(k % 7 == 0, F.replace(xml, F.lit("</mdb:metadataScope>"), F.lit("<mdb:more/></mdb:metadataScope>"))).otherwise(xml)
    used = F.replace(xml, F.lit("<!-- a record -->"), F.lit('<!DOCTYPE r [<!ENTITY e "x">]>'))
    used = F.replace(used, F.lit("&amp; more"), F.lit("&e; or &e; more"))
    found = iso_issues(documents(spark, sf).withColumn("xml", F.when(k % 17 == 0, used).otherwise(xml)), path)
    broken = F.col("issue") == rec.NOT_WELL_FORMED
    # A cut record ends on its last line.
    return found.select("id", "issue", F.when(~broken, F.col("line")).cast("long").alias("line"), F.when(~broken, F.col("message")).alias("message"), "path")


QUERIES = {
    "iso_issues": q_iso_issues,
    "iso_parse": q_iso_parse,
    "iso_date_stamp": q_iso_date_stamp,
    "iso_uuid_mismatch": q_iso_uuid_mismatch,
    "iso_children": q_iso_children,
    "current_release": q_current_release,
    "iso_provenance": q_iso_provenance,
    "iso_validate": q_iso_validate,
}

_R = """
r AS (SELECT *, 'rec-' || doc_id AS id,
    CASE WHEN doc_id % 10 = 9 THEN 'not well-formed XML' WHEN doc_id % 11 = 10 THEN 'wrong root element' END AS error,
    '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00' AS created,
    CASE WHEN doc_id % 3 = 0 THEN '2024-06-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T08:00:00' END AS revised
  FROM documents)"""
_UUID = "'rec-' || CASE WHEN doc_id % 13 = 12 THEN doc_id + 1000000 ELSE doc_id END"

ORACLES = {
    "iso_issues": f"""WITH {_R}, s AS (SELECT *, '/mdb:MD_Metadata' AS top FROM r),
w AS (SELECT * FROM s WHERE error IS NULL AND doc_id % 17 <> 0)
SELECT id, error AS issue, CASE WHEN error LIKE 'wrong%' THEN 3 END::BIGINT AS line,
  CASE WHEN error LIKE 'wrong%' THEN 'root element is MD_Record, expected MD_Metadata of http://standards.iso.org/iso/19115/-3/mdb/2.0' END AS message, NULL AS path
FROM s WHERE error IS NOT NULL
UNION ALL
SELECT id, 'entity reference', CASE WHEN doc_id % 3 = 0 THEN 9 ELSE 7 END, 'entity &e; is not allowed',
  top || '/mdb:identificationInfo/mri:MD_DataIdentification/mri:citation/cit:CI_Citation/cit:title' || CASE doc_id % 4 WHEN 1 THEN '/gcx:Anchor' WHEN 2 THEN '' ELSE '/gco:CharacterString' END
FROM s, range(2) WHERE error IS NULL AND doc_id % 17 = 0
UNION ALL
SELECT id, 'not valid against the schema', 8, 'mdb:dateInfo occurs 3 times in mdb:MD_Metadata, at most 2', top || '/mdb:dateInfo[3]' FROM w WHERE doc_id % 3 = 0
UNION ALL
SELECT id, 'not valid against the schema', 5, 'mdb:MD_MetadataScope has no attribute level', top || '/mdb:metadataScope/mdb:MD_MetadataScope' FROM w WHERE doc_id % 4 <> 0
UNION ALL
SELECT id, 'not valid against the schema', 5, 'mdb:more is not expected in mdb:metadataScope', top || '/mdb:metadataScope/mdb:more' FROM w WHERE doc_id % 7 = 0""",
    "iso_parse": f"""WITH {_R}
SELECT id, {_UUID} AS uuid, 'Data of ' || source || ' & more' AS title, lang AS edition,
  CASE WHEN doc_id % 5 = 0 THEN 'series' ELSE 'dataset' END AS hierarchy_level, created, revised,
  CASE WHEN doc_id % 5 = 0 THEN 'rec-' || (doc_id + 1) || ',rec-' || (doc_id + 2) ELSE '' END AS children, error FROM r WHERE error IS NULL
UNION ALL SELECT id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, error FROM r WHERE error IS NOT NULL""",
    "iso_date_stamp": f"WITH {_R} SELECT id, CASE WHEN error IS NULL THEN coalesce(revised, created) END AS stamp FROM r",
    "iso_uuid_mismatch": f"WITH {_R} SELECT id, {_UUID} AS uuid FROM r WHERE error IS NULL AND doc_id % 13 = 12",
    "iso_children": f"""WITH {_R}
SELECT id, CAST(n - 1 AS BIGINT) AS position, 'rec-' || (doc_id + n) AS child FROM r, (VALUES (1), (2)) v(n) WHERE error IS NULL AND doc_id % 5 = 0""",
    "current_release": f"""WITH {_R},
m AS (SELECT r.id, n, d.doc_id AS c, d.lang, d.source, d.doc_id % 3 <> 0 AS live FROM r, (VALUES (1), (2)) v(n)
  LEFT JOIN documents d ON d.doc_id = r.doc_id + n WHERE error IS NULL AND r.doc_id % 5 = 0),
g AS (SELECT id, count(*) FILTER (WHERE live) AS live, min('rec-' || c) FILTER (WHERE live) AS one,
  coalesce(string_agg('rec-' || c || '  ' || CASE WHEN live THEN 'current' ELSE 'superseded' END || '  ed. ' || lang || '  2024-01-01  ' || source, '|' ORDER BY n)
    FILTER (WHERE c IS NOT NULL), '') AS candidates FROM m GROUP BY id)
SELECT id, CASE WHEN live = 1 THEN one END AS current, candidates, CASE WHEN live <> 1 THEN live || ' current releases, expected 1' END AS error FROM g""",
    "iso_provenance": f"""WITH {_R}
SELECT id, n AS tag_name, CASE n WHEN 'record_uuid' THEN id WHEN 'record_edition' THEN lang ELSE coalesce(revised, created) || 'Z' END AS tag_value, t AS tag_title
FROM r, (VALUES ('record_uuid', 'Record UUID'), ('record_edition', 'Record edition'), ('record_date_stamp', 'Record metadata date')) v(n, t) WHERE error IS NULL""",
    "iso_validate": f"""WITH {_R},
i AS (SELECT id, coalesce(error, CASE WHEN doc_id % 17 = 0 THEN 'entity reference' WHEN doc_id % 3 = 0 THEN 'not valid against the schema' END) AS issue,
  doc_id % 3 = 0 AS three FROM r)
SELECT id, issue, CAST(CASE issue WHEN 'wrong root element' THEN 3 WHEN 'entity reference' THEN CASE WHEN three THEN 9 ELSE 7 END END AS BIGINT) AS line
FROM i WHERE issue IS NOT NULL""",
}
