"""ISO 19115-3 metadata records: read, checked and resolved, as a frame ``(id, xml)``.

Documents are parsed by Spark's own XML reader with a fixed schema of the
fields that matter; nothing outside a document is ever fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.once import computed_once
from lakewright.functions.skew import salted_join
from lakewright.functions.text import strip

# The root element's name and namespace.
ROOT = "MD_Metadata"
NAMESPACE = "http://standards.iso.org/iso/19115/-3/mdb/2.0"

_TEXT = "struct<CharacterString:string, Anchor:string, _VALUE:string>"
_CITATION = f"struct<CI_Citation:struct<title:{_TEXT}, edition:{_TEXT}>>"
_ASSOCIATED = (
    "array<struct<MD_AssociatedResource:struct<"
    "associationType:struct<DS_AssociationTypeCode:struct<_codeListValue:string>>, "
    "metadataReference:struct<_uuidref:string>>>>"
)
_RESOURCE = f"struct<citation:{_CITATION}, associatedResource:{_ASSOCIATED}>"
_SCHEMA = (
    "metadataIdentifier array<struct<MD_Identifier:struct<code:struct<CharacterString:string>>>>, "
    "metadataScope array<struct<MD_MetadataScope:struct<resourceScope:struct<MD_ScopeCode:struct<_codeListValue:string>>>>>, "
    "dateInfo array<struct<CI_Date:struct<date:struct<DateTime:string, Date:string>, "
    "dateType:struct<CI_DateTypeCode:struct<_codeListValue:string>>>>>, "
    f"identificationInfo array<struct<MD_DataIdentification:{_RESOURCE}, SV_ServiceIdentification:{_RESOURCE}>>, "
    "_corrupt_record string"
)
_OPTIONS = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"}

# What may stand before the root element: declaration, comments, a document type.
_PROLOG = r"^\x{FEFF}?(?:\s++|<\?[\s\S]*?\?>|<!--[\s\S]*?-->|<!DOCTYPE[^\[>]*+(?:\[[\s\S]*?\]\s*+)?>)*+"
_FIRST_TAG = _PROLOG + r"<(?:([A-Za-z_][\w.\-]*+):)?([A-Za-z_][\w.\-]*+)((?:\s[^>]*+)?)/?>"
_ENTITY = r"&(?!amp;|lt;|gt;|quot;|apos;)[A-Za-z_][\w.\-]*+;"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"

NOT_WELL_FORMED = "not well-formed XML"
WRONG_ROOT = "wrong root element"


def _parsed(xml: Column, options: dict[str, str] | None = None) -> Column:
    return F.from_xml(xml, _SCHEMA, {**_OPTIONS, **(options or {})})


def has_right_root(xml: Column) -> Column:
    """Whether the first element is ``MD_Metadata`` in the standard's namespace."""
    prefix, name, given = (F.regexp_extract(xml, _FIRST_TAG, i) for i in (1, 2, 3))
    declared = F.when(prefix == "", F.lit("xmlns")).otherwise(F.concat(F.lit("xmlns:"), prefix))
    flat = F.regexp_replace(F.translate(given, "'", '"'), r"\s*=\s*", "=")
    return (name == ROOT) & flat.contains(F.concat(declared, F.lit(f'="{NAMESPACE}"')))


def _text(node: Column) -> Column:
    """An element's own text, else its CharacterString's or Anchor's."""

    def full(value: Column) -> Column:
        return F.nullif(strip(value), F.lit(""))

    inner = F.when(node["CharacterString"].isNotNull(), full(node["CharacterString"])).otherwise(full(node["Anchor"]))
    return F.coalesce(full(node["_VALUE"]), inner)


def iso_timestamp(value: Column) -> Column:
    """An ISO date or time as a timestamp; without a zone it is UTC; else null."""
    text = F.regexp_replace(strip(value), ",", ".")
    zoned = text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & text.contains(":")
    full = F.when(zoned | ~text.contains(":"), text).otherwise(F.concat(text, F.lit("Z")))
    dated = F.when(F.length(full) == 10, F.concat(full, F.lit("T00:00:00Z"))).otherwise(full)
    return F.when(text.rlike(_ISO_DATE), dated.try_cast("timestamp"))


def _latest(record: Column, kind: str) -> Column:
    of_kind = F.filter(
        record["dateInfo"], lambda d: d["CI_Date"]["dateType"]["CI_DateTypeCode"]["_codeListValue"] == kind
    )
    return F.array_max(
        F.transform(
            of_kind,
            lambda d: iso_timestamp(F.coalesce(d["CI_Date"]["date"]["DateTime"], d["CI_Date"]["date"]["Date"])),
        )
    )


def _children(resource: Column) -> Column:
    composed = F.filter(
        resource["associatedResource"],
        lambda a: (a["MD_AssociatedResource"]["associationType"]["DS_AssociationTypeCode"]["_codeListValue"] == "isComposedOf")
        & (a["MD_AssociatedResource"]["metadataReference"]["_uuidref"] != ""),
    )
    refs = F.transform(composed, lambda a: a["MD_AssociatedResource"]["metadataReference"]["_uuidref"])
    return F.coalesce(refs, F.array().cast("array<string>"))


def iso_parse(records: DataFrame) -> DataFrame:
    """``(id, uuid, title, edition, hierarchy_level, created, revised, children, error)``.

    A document that is not well formed, or has another root, keeps only its id
    and its error. Of several dates of one type the latest counts.
    """
    root = has_right_root(F.col("xml"))
    parsed = computed_once(records, root=root, r=_parsed(F.col("xml"))).drop("xml")
    r = F.col("r")
    broken = r["_corrupt_record"].isNotNull() | r.isNull()
    error = F.when(broken, F.lit(NOT_WELL_FORMED)).when(~F.col("root"), F.lit(WRONG_ROOT))
    # The first resource that has the citation, and all resources' children.
    resources = F.flatten(
        F.transform(
            F.coalesce(r["identificationInfo"], F.array()),
            lambda i: F.filter(
                F.array(i["MD_DataIdentification"], i["SV_ServiceIdentification"]), lambda x: x.isNotNull()
            ),
        )
    )
    checked = parsed.withColumn("error", error).withColumn("resources", resources)
    cited = F.get(F.filter("resources", lambda x: x["citation"]["CI_Citation"].isNotNull()), F.lit(0))
    citation = cited["citation"]["CI_Citation"]
    code = F.get(F.filter(r["metadataIdentifier"], lambda m: m["MD_Identifier"]["code"]["CharacterString"].isNotNull()), F.lit(0))
    scope = F.get(
        F.filter(r["metadataScope"], lambda m: m["MD_MetadataScope"]["resourceScope"]["MD_ScopeCode"].isNotNull()), F.lit(0)
    )
    fields = {
        "uuid": F.coalesce(strip(code["MD_Identifier"]["code"]["CharacterString"]), F.lit("")),
        "title": _text(citation["title"]),
        "edition": _text(citation["edition"]),
        "hierarchy_level": scope["MD_MetadataScope"]["resourceScope"]["MD_ScopeCode"]["_codeListValue"],
        "created": _latest(r, "creation"),
        "revised": _latest(r, "revision"),
        "children": F.flatten(F.transform("resources", _children)),
    }
    good = F.col("error").isNull()
    return checked.select("id", *[F.when(good, c).alias(n) for n, c in fields.items()], "error")


def date_stamp() -> Column:
    """A parsed record's last change: its revision, else its creation."""
    return F.coalesce("revised", "created")


def uuid_mismatches(parsed: DataFrame) -> DataFrame:
    """``(id, uuid)`` of the readable records that identify another record."""
    return parsed.filter("error IS NULL AND uuid <> id").select("id", "uuid")


def series_members(parsed: DataFrame) -> DataFrame:
    """``(id, position, child)``: the records a series is composed of."""
    return parsed.filter("error IS NULL").select("id", F.posexplode("children").alias("position", "child"))


def current_release(parsed: DataFrame, index: DataFrame) -> DataFrame:
    """``(id, current, candidates, error)`` per record with children.

    ``index(uuid, title, edition, publication_date, status)`` is the search
    index. The one member that is not superseded is current; none or several
    are an error that lists all. A series' members stood in one document, so
    they fit into one row.
    """
    members = series_members(parsed)
    known = index.withColumnRenamed("uuid", "child")
    found = salted_join(members, known, ["child"], "left", ["id", "position"])
    hit = F.col("title").isNotNull() | F.col("edition").isNotNull() | F.col("publication_date").isNotNull() | F.col("status").isNotNull()
    live = hit & (F.coalesce("status", F.lit("")) != "superseded")
    candidate = F.struct("position", "child", "edition", "publication_date", "status", "title")
    per_series = found.groupBy("id").agg(
        F.count_if(live).alias("live"),
        F.min(F.when(live, F.col("child"))).alias("one"),
        F.sort_array(F.collect_list(F.when(hit, candidate))).alias("listed"),
    )
    line = F.transform(
        "listed",
        lambda c: F.concat_ws(
            "  ", c["child"], F.coalesce(c["status"], F.lit("current")),
            F.concat(F.lit("ed. "), F.coalesce(c["edition"], F.lit("-"))),
            F.coalesce(c["publication_date"], F.lit("-")), F.coalesce(c["title"], F.lit("")),
        ),
    )
    wrong = F.concat(F.col("live").cast("string"), F.lit(" current releases, expected 1"))
    one = F.col("live") == 1
    return per_series.select(
        "id",
        F.when(one, F.col("one")).alias("current"),
        line.alias("candidates"),
        F.when(~one, wrong).alias("error"),
    )


def iso_validate(records: DataFrame, xsd: str | None = None) -> DataFrame:
    """``(id, line, issue, message)``: one row per record with an issue.

    Checked in this order: well-formed, root element, no entity references,
    valid against the schema at ``xsd`` (a path every executor can read).
    ``line`` is given where the text itself shows it.
    """
    return flagged(records, xsd).drop("xml")


def flagged(records: DataFrame, xsd: str | None = None) -> DataFrame:
    """:func:`iso_validate` with the records' ``xml``."""
    xml = F.col("xml")
    entities = F.regexp_replace(xml, r"<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>", "")
    declared = xml.contains("<!ENTITY")
    entity = F.regexp_extract(entities, _ENTITY, 0)

    def line_of(position: Column) -> Column:
        before = F.substr(xml, F.lit(1), position - 1)
        return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1

    root_at = F.length(F.regexp_extract(xml, _PROLOG, 0)) + 1
    has_entity = declared & (entity != "")
    # An entity that is not expanded reads as broken text: tell it apart first.
    plain = F.when(has_entity, F.regexp_replace(F.regexp_replace(xml, _ENTITY, "x"), r"<!DOCTYPE[^\[>]*+\[[\s\S]*?\]\s*>", "")).otherwise(xml)
    checked = computed_once(
        records.select("id", "xml"),
        root=has_right_root(xml),
        has_entity=has_entity,
        entity=entity,
        broken=_parsed(plain).getField("_corrupt_record").isNotNull(),
        invalid=_parsed(xml, {"rowValidationXSDPath": xsd}).getField("_corrupt_record").isNotNull() if xsd else F.lit(False),
    )
    issue = (
        F.when(F.col("broken"), F.lit(NOT_WELL_FORMED))
        .when(~F.col("root"), F.lit(WRONG_ROOT))
        .when(F.col("has_entity"), F.lit("entity reference"))
        .when(F.col("invalid"), F.lit("not valid against the schema"))
    )
    message = F.when(
        F.col("issue") == WRONG_ROOT,
        F.concat(F.lit("root element is "), F.regexp_extract(xml, _FIRST_TAG, 2), F.lit(f", expected {ROOT} of {NAMESPACE}")),
    ).when(F.col("issue") == "entity reference", F.concat(F.lit("entity "), "entity", F.lit(" is not allowed")))
    line = F.when(F.col("issue") == WRONG_ROOT, line_of(root_at)).when(
        F.col("issue") == "entity reference", line_of(F.instr(xml, F.col("entity")))
    )
    return checked.withColumn("issue", issue).filter("issue IS NOT NULL").select(
        "id", line.cast("int").alias("line"), "issue", message.alias("message"), "xml"
    )


def provenance_tags(parsed: DataFrame) -> DataFrame:
    """``(id, tag_name, tag_value, tag_title)``: three rows per readable record, in
    the form the wiki's metadata block takes."""
    stamp = F.coalesce(F.date_format(date_stamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit(""))

    def tag(name: str, value: Column, title: str) -> Column:
        return F.struct(F.lit(name).alias("tag_name"), value.alias("tag_value"), F.lit(title).alias("tag_title"))

    tags = F.array(
        tag("record_uuid", F.col("id"), "Record UUID"),
        tag("record_edition", F.coalesce("edition", F.lit("")), "Record edition"),
        tag("record_date_stamp", stamp, "Record metadata date"),
    )
    return parsed.filter("error IS NULL").select("id", F.inline(tags))
