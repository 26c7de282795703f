"""The metadata block inside a wiki text: rendered, parsed, replaced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates the text from its block, and one entry's form.
MARKER = "\n\n# Meta Data\n"
ENTRY = r'<tag\s+name="([^"]*)"\s+value="([^"]*)"\s+title="([^"]*)"\s*/>'
TAGS_TYPE = "array<struct<tag_name:string,tag_value:string,tag_title:string>>"

# Order matters: & last when reading, first when writing.
_ESCAPES = (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"))


def _escape(value: Column) -> Column:
    for plain, coded in _ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def _unescape(value: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def base_text(wiki: Column) -> Column:
    """The text before the block, all of it when there is none."""
    return F.substring_index(F.coalesce(wiki, F.lit("")), MARKER, 1)


def tags(wiki: Column) -> Column:
    """The block's entries in order; none for a text without a block."""
    text = F.coalesce(wiki, F.lit(""))
    block = F.substr(text, F.length(base_text(text)) + 1)

    def part(i: int) -> Column:
        return F.regexp_extract_all(block, F.lit(ENTRY), F.lit(i))

    return F.transform(
        F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c")),
        lambda t: F.struct(
            _unescape(t["a"]).alias("tag_name"),
            _unescape(t["b"]).alias("tag_value"),
            _unescape(t["c"]).alias("tag_title"),
        ),
    )


def render(entries: Column) -> Column:
    """The block for ``entries``: a readable line and a coded line each."""
    shown = F.transform(
        entries, lambda t: F.concat(F.lit("\t"), t["tag_title"], F.lit(" : "), t["tag_value"])
    )
    coded = F.transform(
        entries,
        lambda t: F.concat(
            F.lit('<tag name="'), _escape(t["tag_name"]),
            F.lit('" value="'), _escape(t["tag_value"]),
            F.lit('" title="'), _escape(t["tag_title"]), F.lit('"/>'),
        ),
    )
    lines = F.concat(F.array(F.lit("# Meta Data")), shown, F.array(F.lit("<meta>")), coded, F.array(F.lit("</meta>")))
    return F.array_join(lines, "\n")


def with_tags(wiki: Column, entries: Column, overwrite: bool = True) -> Column:
    """``wiki`` with its block replaced by ``entries``, or extended by them."""
    wanted = entries if overwrite else F.concat(tags(wiki), entries)
    base = base_text(wiki)
    return F.when(F.size(wanted) > 0, F.concat(base, F.lit("\n\n"), render(wanted))).otherwise(base)
