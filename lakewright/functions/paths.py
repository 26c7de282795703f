"""Catalog paths as columns.

A catalog path is dotted (``a.b.c``); a name that is no plain identifier is in
double quotes (``a."v1.0"``). Its storage form joins the same names with ``/``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions.text import strip

# Fixed value: a name that needs no quotes.
PLAIN_NAME = "^[A-Za-z_][A-Za-z0-9_]*$"
# Quantifiers are possessive: a long name must not deepen the matcher's stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
# One run of quoted parts and of anything but the separator.
_DOTTED_PART = rf'(?:{_QUOTED}|[^".]++)++'
_SLASHED_PART = rf'(?:{_QUOTED}|[^"/]++)++'
_QUOTED_RUN = r'"([^"]*+(?:""[^"]*+)*+)"'


def _unquote(part: Column) -> Column:
    bare = F.regexp_replace(part, _QUOTED_RUN, "$1")
    return strip(F.replace(bare, F.lit('""'), F.lit('"')))


def is_storage_form(path: Column) -> Column:
    """Whether a ``/`` stands outside double quotes."""
    return F.regexp_replace(path, '"[^"]*"', "").contains("/")


def quotes_closed(path: Column) -> Column:
    """False for a path with an odd number of double quotes."""
    return F.length(F.regexp_replace(path, '[^"]', "")) % 2 == 0


def segments(path: Column) -> Column:
    """The names of ``path`` in either form; null for an unclosed quote."""
    text = strip(path)
    parts = F.when(
        is_storage_form(text), F.regexp_extract_all(text, F.lit(_SLASHED_PART), F.lit(0))
    ).otherwise(F.regexp_extract_all(text, F.lit(_DOTTED_PART), F.lit(0)))
    named = F.filter(F.transform(parts, _unquote), lambda s: s != "")
    return F.when(quotes_closed(text), named)


def to_storage(path: Column) -> Column:
    """Folder names joined with ``/``."""
    return F.array_join(segments(path), "/")


def quote_name(name: Column) -> Column:
    """``name``, double-quoted unless it is a plain identifier."""
    return F.when(name.rlike(PLAIN_NAME), name).otherwise(
        F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    )


def to_catalog(path: Column) -> Column:
    """Names joined with ``.``, quoted where they need it."""
    return F.array_join(F.transform(segments(path), quote_name), ".")


# Plain dotted paths (no quoting), as inventories hold them -------------------


def names(path: Column) -> Column:
    return F.filter(F.split(path, r"\."), lambda s: s != "")


def leaf(path: Column) -> Column:
    return F.substring_index(path, ".", -1)


def parent(path: Column) -> Column:
    """Everything above the leaf, null for a one-name path."""
    cut = F.length(path) - F.length(leaf(path)) - 1
    return F.when(cut > 0, F.substr(path, F.lit(1), cut))


def depth(path: Column) -> Column:
    return F.size(names(path))


def ancestors(path: Column) -> Column:
    """Every folder above ``path``, shallowest first."""
    seg = names(path)
    return F.when(
        F.size(seg) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(seg) - 1),
            lambda i: F.array_join(F.slice(seg, F.lit(1), i), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))


def prefixes(path: Column) -> Column:
    """:func:`ancestors` and the path itself."""
    return F.concat(ancestors(path), F.array(path))


def is_inside(path: Column, ancestor: Column) -> Column:
    """``path`` is ``ancestor`` or below it, ignoring case."""
    low, top = F.lower(path), F.lower(ancestor)
    return (low == top) | low.startswith(F.concat(top, F.lit(".")))


def is_below(path: Column, root: str) -> Column:
    """Strictly below ``root``; wildcard characters in it mean nothing."""
    return path.startswith(F.lit(root + "."))


def relative_to(path: Column, root: Column) -> Column:
    """``path`` without the ``root.`` in front; unchanged when not below it."""
    return F.when(
        path.startswith(F.concat(root, F.lit("."))),
        F.substr(path, F.length(root) + 2),
    ).otherwise(path)


def remap(path: Column, source: str, target: str) -> Column:
    """``path`` with as many leading names as ``source`` has swapped for ``target``."""
    seg = names(path)
    skip = len([s for s in source.split(".") if s])
    rest = F.slice(seg, F.lit(skip + 1), F.greatest(F.size(seg) - skip, F.lit(0)))
    return F.array_join(F.concat(F.split(F.lit(target), r"\."), rest), ".")


# Driver-side twins, for arguments (never for rows) ---------------------------


def split_path(path: str) -> list[str]:
    """One argument's names, by the same rules as :func:`segments`."""
    text = path.strip()
    if text.count('"') % 2:
        raise LakeError(f"unclosed quote in path {path!r}")
    slashed = "/" in re.sub(r'"[^"]*"', "", text)
    parts = re.findall(_SLASHED_PART if slashed else _DOTTED_PART, text)
    unquoted = [
        re.sub(_QUOTED_RUN, lambda m: m.group(1).replace('""', '"'), p).strip()
        for p in parts
    ]
    return [p for p in unquoted if p]
