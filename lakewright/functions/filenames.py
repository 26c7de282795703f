"""Rules for document file names, as columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewright.functions.text import strip

# Characters no file system accepts in a name, and control characters.
_BAD_CHARACTERS = r'[<>:"|?*\x00-\x1f\x7f]'


def file_name_problem(name: Column) -> Column:
    """Why ``name`` is no single valid file name; null when it is one."""
    clean = strip(name)
    return (
        F.when(name.isNull() | (clean == ""), F.lit("empty"))
        .when(clean.contains("/") | clean.contains("\\") | clean.isin(".", ".."), F.lit("path"))
        .when(clean.rlike(_BAD_CHARACTERS), F.lit("character"))
    )


def relative_name_problem(name: Column) -> Column:
    """Why ``name`` is no path of valid file names; the first bad part decides."""
    clean = F.regexp_replace(strip(name), "^/+|/+$", "")
    found = F.filter(
        F.transform(F.split(clean, "/"), lambda part: file_name_problem(part)),
        lambda why: why.isNotNull(),
    )
    return F.when(name.isNull() | (clean == ""), F.lit("empty")).otherwise(F.get(found, F.lit(0)))


def patterns(given: str | Iterable[str] | None) -> list[str]:
    """The distinct non-blank patterns in ``given``, in order."""
    listed = [given] if isinstance(given, str) else [*(given or ())]
    wrong = {type(p).__name__ for p in listed if not isinstance(p, str)}
    if wrong:
        raise TypeError(f"a pattern is text, not {', '.join(sorted(wrong))}")
    return [p for p in dict.fromkeys(map(str.strip, listed)) if p]


def glob_regex(pattern: str) -> str:
    """A Java regex for a shell wildcard: ``*``, ``?``, ``[set]`` and ``[!set]``."""
    # A bracket without its closing partner is an ordinary character.
    pieces = re.split(r"(\*|\?|\[!?\]?[^\]]*\])", pattern)
    out = []
    for piece in pieces:
        if piece == "*":
            out.append(r"[\s\S]*")
        elif piece == "?":
            out.append(r"[\s\S]")
        elif piece.startswith("[") and piece.endswith("]") and len(piece) > 2:
            negated = piece.startswith("[!")
            inside = re.sub(r"([\\\[\]^&])", r"\\\1", piece[2 if negated else 1 : -1])
            out.append(f"[{'^' if negated else ''}{inside}]")
        else:
            out.append(re.escape(piece))
    return "^(?:" + "".join(out) + ")$"


def name_regex(pattern: str) -> str:
    """The regex that finds one pattern in a lower-case name.

    A pattern with ``* ? [`` is a wildcard for the whole name or its last part,
    one starting with ``.`` is an extension, any other is text to be found.
    """
    if any(c in pattern for c in "*?["):
        whole = glob_regex(pattern)[1:-1]
        return rf"^(?:[\s\S]*/(?=[^/]*$))?{whole}$|^{whole}$"
    return re.escape(pattern) + (r"$" if pattern.startswith(".") else "")


def matches_any(name: Column, wanted: str | Iterable[str] | None) -> Column:
    """Whether ``name`` fits any pattern, ignoring case; no pattern fits all."""
    rules = [name_regex(p.lower()) for p in patterns(wanted)]
    return F.lower(name).rlike("|".join(f"(?:{r})" for r in rules)) if rules else F.lit(True)
