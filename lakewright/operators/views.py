"""Views whose SQL is written with catalog paths."""

from __future__ import annotations

import re

from lakewright.errors import LakeError
from lakewright.functions import sqltext
from lakewright.lake import TABLE, VIEW, WIKI_PROPERTY, Lake, quote

SQL_PROPERTY = "lakewright.sql"
CONTEXT_PROPERTY = "lakewright.context"

# Java's \z is Python's \Z.
_PIECE = re.compile(sqltext.PIECE.replace(r"\z", r"\Z"))
_CHAIN = re.compile(sqltext.CHAIN)
_NAME = re.compile(sqltext.IDENTIFIER)
_CLAUSE_WORDS = {*sqltext.REFERENCE_WORDS, "SELECT", "WHERE", "ON", "USING", "GROUP", "ORDER", "HAVING"}


def _plain(name: str) -> str:
    if name.startswith('"'):
        return name[1:-1].replace('""', '"')
    return name[1:-1] if name.startswith("`") else name


def written_path(names: list[str]) -> str:
    """Names as a path argument, quoted."""
    return ".".join('"' + n.replace('"', '""') + '"' for n in names)


def executable_sql(lake: Lake, sql: str, context: list[str] | None = None) -> str:
    """One statement with the paths of existing entries as session catalog names.

    The longest prefix of a chain that is an entry counts, by itself or, where
    a table is named, behind the context; other quoted names only change their
    quotes.
    """

    def replaced(names: list[str], names_table: bool) -> str | None:
        for count in range(len(names), 0, -1):
            for before in ([], list(context or [])) if names_table else ([],):
                full = before + names[:count]
                if len(full) > 1 and lake.kind(written_path(full)) is not None:
                    rest = "".join("." + quote(n) for n in names[count:])
                    return lake.sql_name(written_path(full)) + rest
        return None

    out, word, clause, comma = [], "", "", False
    for piece in _PIECE.findall(sql):
        if _CHAIN.fullmatch(piece):
            names = [_plain(n) for n in _NAME.findall(piece)]
            upper = piece.upper()
            # After FROM and the like, or a comma in the same clause.
            names_table = word in sqltext.REFERENCE_WORDS or (comma and clause in sqltext.REFERENCE_WORDS)
            quoted = ".".join(quote(n) for n in names) if '"' in piece else piece
            out.append(replaced(names, names_table) or quoted)
            clause = upper if upper in _CLAUSE_WORDS else clause
            word, comma = upper, False
        else:
            out.append(piece)
            comma = comma or piece.rstrip().endswith(",")
    return "".join(out)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_view_as(
    lake: Lake, path: str, sql: str, overwrite: bool = False, context: list[str] | None = None
) -> None:
    """A view over any SELECT; its text is kept as written, with its context."""
    kind = lake.kind(path)
    if kind == TABLE:
        raise LakeError(f"{path!r} is a table: a view never replaces one")
    if kind == VIEW and not overwrite:
        raise LakeError(f"view {path!r} already exists")
    lake.ensure_folder(path.rpartition(".")[0])
    properties = f"'{SQL_PROPERTY}' = {_literal(sql)}"
    if context:
        properties += f", '{CONTEXT_PROPERTY}' = {_literal('.'.join(context))}"
    if kind == VIEW:
        kept, wiki = lake.tags(path), lake.property(path, WIKI_PROPERTY)
    lake.spark.sql(
        f"CREATE OR REPLACE VIEW {lake.sql_name(path)} TBLPROPERTIES ({properties}) "
        f"AS {executable_sql(lake, sql, context)}"
    )
    if kind == VIEW and kept:
        lake.set_tags(path, kept)
    if kind == VIEW and wiki:
        lake.set_wiki(path, wiki)


def create_view(lake: Lake, source: str, path: str, overwrite: bool = False) -> None:
    """A view of all rows of a table or view."""
    if lake.kind(source) is None:
        raise LakeError(f"{source!r} does not exist")
    from lakewright.functions.paths import split_path

    create_view_as(lake, path, f"SELECT * FROM {written_path(split_path(source))}", overwrite)
