"""SQL text as an array of pieces, so references in it can be swapped safely.

A piece is a string literal, a comment, a chain of identifiers joined by dots,
or other text; the pieces joined give the text back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTIFIER = r'(?:"[^"]*+(?:""[^"]*+)*+"|`[^`]*+`|[A-Za-z_][A-Za-z0-9_$]*+)'
CHAIN = rf"{IDENTIFIER}(?:\.{IDENTIFIER})*"
PIECE = (
    r"'[^']*+(?:''[^']*+)*+(?:'|\z)"  # a string literal, to the end when unclosed
    r"|--[^\n]*+"
    r"|/\*[\s\S]*?(?:\*/|\z)"
    rf"|{CHAIN}"
    r"""|[^'"`\-/A-Za-z_]++"""
    r"|[\s\S]"
)
# The words a reference to a table follows.
REFERENCE_WORDS = ("FROM", "JOIN", "INTO", "TABLE", "UPDATE")


def pieces(sql: Column) -> Column:
    return F.regexp_extract_all(sql, F.lit(PIECE), F.lit(0))


def is_chain(piece: Column) -> Column:
    return piece.rlike(rf"^{CHAIN}$")


def chain_names(chain: Column) -> Column:
    """The identifiers of a chain without their quotes."""
    found = F.regexp_extract_all(chain, F.lit(IDENTIFIER), F.lit(0))

    def plain(name: Column) -> Column:
        inside = F.substr(name, F.lit(2), F.length(name) - 2)
        return (
            F.when(name.startswith('"'), F.replace(inside, F.lit('""'), F.lit('"')))
            .when(name.startswith("`"), inside)
            .otherwise(name)
        )

    return F.transform(found, plain)


def quoted_names(names: Column, mark: str = '"') -> Column:
    """``names`` as a chain, each between ``mark`` and with ``mark`` doubled inside."""
    return F.array_join(
        F.transform(
            names,
            lambda n: F.concat(F.lit(mark), F.replace(n, F.lit(mark), F.lit(mark * 2)), F.lit(mark)),
        ),
        ".",
    )
