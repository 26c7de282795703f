"""Every issue of a record, with its line, path and message.

Records without an issue are told apart by Spark's own XML reader. Only the others are
parsed once more, into one row per element (number, parent, path, line, type); these rows
are joined with the rules of the schema: which elements a type holds and how often, which
attributes it asks for, and what its text looks like.
"""

from __future__ import annotations

import re
from collections import Counter
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions import xsd as schemas
from lakewright.operators import records
from lakewright.session import materialise

NOT_VALID, ENTITY = "not valid against the schema", "entity reference"
#: Records read, and rows of elements told, at a time: a task holds no more of them as objects.
RECORDS, TOLD = 64, 4096
ELEMENTS = (
    "id string, issue string, line int, message string, path string, n int, parent int, owner string, holder string, "
    "name string, shown string, slot string, turn int, type string, text string, attributes array<string>, open boolean"
)
_REFERENCE = re.compile(r"&([^#;\s][^;\s]*);")


class _Elements:
    """The elements of one document, in order, as the parser meets them."""

    def __init__(self, rules: schemas.Rules | None):
        self.rules, self.rows, self.stack, self.entities, self.error = rules, [], [], [], None
        parser = self.parser = expat.ParserCreate(namespace_separator="}")
        parser.namespace_prefixes = True
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler = self.start, self.end
        parser.CharacterDataHandler = self.characters
        # With this handler references to declared entities come here and are not expanded.
        parser.DefaultHandler = self.other

    def read(self, text: str) -> _Elements:
        try:
            self.parser.Parse(text.encode(), True)
        except expat.ExpatError as wrong:
            self.error = (wrong.lineno, expat.ErrorString(wrong.code))
        return self

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        space, local, prefix = (["", tag, ""] if "}" not in tag else [*tag.split("}"), ""])[:3]
        name, shown = f"{{{space}}}{local}", f"{prefix}:{local}" if prefix else local
        parent = self.stack[-1] if self.stack else None
        slot, kind, turn, owner, loose = name, schemas.OPEN, 1, None, True
        if self.rules is not None:
            if parent is None:
                kind = self.rules.roots.get(name, schemas.OPEN)
            else:
                held = self.rules.types.get(parent["type"])
                owner, loose = parent["type"], held is None or held.open
                # What the type does not name has no slot, even where it heads one.
                slot, kind = held.names.get(name, (f"!{name}", schemas.OPEN)) if held else (name, schemas.OPEN)
        if parent is not None:
            parent["slots"][slot] += 1
            parent["children"][shown] += 1
            turn = parent["slots"][slot]
        row = {
            "n": len(self.rows), "parent": parent and parent["n"], "owner": owner, "holder": parent and parent["shown"], "name": name, "shown": shown,
            "slot": slot, "turn": turn, "type": kind, "text": "", "line": self.parser.CurrentLineNumber, "open": loose,
            "attributes": ["{%s}%s" % tuple(a.split("}")[:2]) if "}" in a else a for a in attributes],
            "slots": Counter(), "children": Counter(), "place": parent["children"][shown] if parent else 1,
        }
        self.rows.append(row)
        self.stack.append(row)

    def end(self, tag: str) -> None:
        self.stack.pop()

    def characters(self, text: str) -> None:
        if self.stack:
            self.stack[-1]["text"] += text

    def other(self, text: str) -> None:
        if self.stack and (found := _REFERENCE.fullmatch(text)):
            self.entities.append((self.parser.CurrentLineNumber, found[1], self.stack[-1]["n"]))

    def paths(self) -> list[str]:
        """The path of each element; a place is shown where several have the name."""
        out = []
        for row in self.rows:
            above = None if row["parent"] is None else self.rows[row["parent"]]
            place = f"[{row['place']}]" if above and above["children"][row["shown"]] > 1 else ""
            out.append(f"{'' if above is None else out[row['parent']]}/{row['shown']}{place}")
        return out


def elements(flagged: DataFrame, rules: schemas.Rules | None) -> DataFrame:
    """One row per element of records that break the schema; for other records their issues, one row each.

    ``flagged`` are rows of :func:`records.flagged`.
    """

    def parsed(batches):
        for batch in batches:
            out = []
            for r in (r for at in range(0, batch.num_rows, RECORDS) for r in batch.slice(at, RECORDS).to_pylist()):
                if len(out) >= TOLD:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
                if r["issue"] == records.WRONG_ROOT:
                    out.append({k: r[k] for k in ("id", "issue", "line", "message")})
                    continue
                found = _Elements(rules).read(r["xml"])
                paths = found.paths()
                if r["issue"] == records.NOT_WELL_FORMED:
                    line, told = found.error or (r["line"], r["message"])
                    out.append({"id": r["id"], "issue": r["issue"], "line": line, "message": told})
                elif r["issue"] == ENTITY:
                    out += [{"id": r["id"], "issue": ENTITY, "line": line, "message": f"entity &{name}; is not allowed", "path": paths[n]} for line, name, n in found.entities] or [
                        {k: r[k] for k in ("id", "issue", "line", "message")}
                    ]
                else:
                    for row, path in zip(found.rows, paths, strict=True):
                        kept = {k: v for k, v in row.items() if k not in ("slots", "children", "place")}
                        out.append({**kept, "id": r["id"], "path": path, "text": row["text"].strip(" \t\r\n")})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            (name, {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}[kind])
            for name, kind in (part.split(" ") for part in ELEMENTS.split(", "))
        ]
    )
    return flagged.mapInArrow(parsed, ELEMENTS)


def _rule_frames(spark, rules: schemas.Rules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Slots of each type, attributes it asks for, and the form or values of its text."""
    slots = [(t, s, s.rpartition("}")[2], *times) for t, c in rules.types.items() for s, times in c.slots.items()]
    asked = [(t, a, a.rpartition("}")[2]) for t, c in rules.types.items() for a in sorted(c.required)]
    texts = [(t, t.rpartition("}")[2] if t.startswith(schemas.XS) else None, c.form, c.values) for t, c in rules.types.items() if c.form or c.values]
    return (
        spark.createDataFrame(slots, "owner string, slot string, local string, least int, most int"),
        spark.createDataFrame(asked, "type string, attribute string, local string"),
        spark.createDataFrame(texts, "type string, called string, form string, allowed array<string>"),
    )


def _broken_rules(found: DataFrame, rules: schemas.Rules) -> DataFrame:
    """``(id, line, message, path)`` of every rule that an element breaks."""
    slots, asked, texts = _rule_frames(found.sparkSession, rules)
    where = ["id", "line", "path"]

    def told(frame: DataFrame, *message: Column | str) -> DataFrame:
        parts = [F.lit(m) if isinstance(m, str) else m.cast("string") for m in message]
        return frame.select(*where, F.concat(*parts).alias("message"))

    inner = found.filter("parent IS NOT NULL")
    known = inner.join(slots, ["owner", "slot"], "left")
    unexpected = told(known.filter("most IS NULL AND NOT open"), F.col("shown"), " is not expected in ", F.col("holder"))
    total = inner.groupBy("id", F.col("parent").alias("n"), "slot").agg(F.count("*").cast("int").alias("times"))
    over = known.filter(F.col("turn") == F.col("most") + 1).drop("n").withColumnRenamed("parent", "n")
    over = over.join(total, ["id", "n", "slot"])
    too_many = told(over, F.col("shown"), " occurs ", F.col("times"), " times in ", F.col("holder"), ", at most ", F.col("most"))
    wanted = found.select(*where, "n", "shown", F.col("type").alias("owner")).join(slots.filter("least > 0"), "owner")
    short = wanted.join(total, ["id", "n", "slot"], "left").filter(F.coalesce("times", F.lit(0)) < F.col("least"))
    missing = told(short, F.col("shown"), " has ", F.coalesce("times", F.lit(0)), " of ", F.col("local"), ", at least ", F.col("least"))
    typed = found.join(texts, "type")
    misspelt = told(typed.filter(F.col("form").isNotNull() & ~F.rlike(F.col("text"), F.concat(F.lit("^(?:"), "form", F.lit(")$")))), F.col("shown"), " holds '", F.substring("text", 1, 100), "', which is no ", F.coalesce("called", F.lit("value of its type")))
    not_listed = told(typed.filter(F.col("allowed").isNotNull() & ~F.array_contains("allowed", F.col("text"))), F.col("shown"), " holds '", F.substring("text", 1, 100), "', which is not listed")
    lacking = found.join(asked, "type").filter(~F.array_contains("attributes", F.col("attribute")))
    without = told(lacking, F.col("shown"), " has no attribute ", F.col("local"))
    out = unexpected
    for more in (too_many, missing, misspelt, not_listed, without):
        out = out.unionByName(more)
    return out


def iso_issues(frame: DataFrame, xsd: str | None = None) -> DataFrame:
    """``(id, line, issue, message, path)``: one row per issue of ``frame(id, xml)``.

    Broken text and a wrong root are one issue; every reference to an entity is
    one, and every rule of the schema at ``xsd`` that an element breaks. A record
    that the schema refuses for a reason these rules do not cover, such as the
    order of elements, has one row without line and path. Ids tell records apart.
    """
    spark = frame.sparkSession
    rules = None
    if xsd is not None:
        def text_of(path: str) -> str:
            return "\n".join(r["value"] for r in spark.read.option("wholetext", "true").text(path).collect())

        rules = schemas.read_rules(xsd, text_of)
    flagged = records.flagged(frame, xsd)
    rows = materialise(elements(flagged, rules), "elements")
    told = rows.filter("issue IS NOT NULL").select("id", "line", "issue", "message", "path")
    if rules is None:
        return told
    refused = rows.filter("issue IS NULL")
    broken = materialise(_broken_rules(refused, rules), "issues").withColumn("issue", F.lit(NOT_VALID))
    rest = refused.filter("parent IS NULL").select("id").join(broken.select("id").distinct(), "id", "left_anti")
    nothing = F.lit(None).cast("string")
    rest = rest.select("id", F.lit(None).cast("int").alias("line"), F.lit(NOT_VALID).alias("issue"), nothing.alias("message"), nothing.alias("path"))
    return told.unionByName(broken).unionByName(rest)
