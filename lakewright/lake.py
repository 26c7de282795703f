"""A lake: catalog paths of any depth kept as tables and views of a session catalog.

The session catalog knows one-part namespaces only, so the folder ``a.b.c``
becomes the database ``a__b__c``; names that a database cannot carry are
escaped reversibly. Paths compare without regard to case, as table names do.
"""

from __future__ import annotations

import base64
import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakewright.errors import LakeError
from lakewright.functions.paths import split_path
from lakewright.session import scratch

TABLE, VIEW, FOLDER = "TABLE", "VIEW", "FOLDER"
TAGS_PROPERTY = "lakewright.tags"
WIKI_PROPERTY = "lakewright.wiki"
# Tables of a replacement in progress; encoded names of users never end so.
STAGING, OLD = "__staging", "__old"
INVENTORY_SCHEMA = "path string, kind string"
METADATA_SCHEMA = "path string, kind string, tags array<string>, wiki string"

_KEPT = re.compile(r"[a-z0-9]")
_ESCAPED = re.compile(r"_x([0-9a-f]+)x")


def encode_name(name: str) -> str:
    """``name`` in lower case with everything but letters, digits and single
    inner underscores written as ``_x<hex>x``."""
    low, out = name.lower(), []
    for i, c in enumerate(low):
        following = low[i + 1 : i + 2]
        plain_underscore = (
            c == "_" and i > 0 and following != "x" and bool(_KEPT.fullmatch(following))
        )
        out.append(c if _KEPT.fullmatch(c) or plain_underscore else f"_x{ord(c):x}x")
    return "".join(out)


def decode_name(name: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), name)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Ident:
    """Where a path lives in the session catalog."""

    database: str
    table: str

    @property
    def sql(self) -> str:
        return f"{quote(self.database)}.{quote(self.table)}"


class Lake:
    """Reads and changes the entries below ``root`` in a session catalog.

    ``prefix`` keeps several lakes apart in one catalog (as tests need);
    ``location`` is where the databases keep their managed tables.
    """

    def __init__(self, spark: SparkSession, prefix: str = "", location: str | None = None):
        self.spark = spark
        self.prefix = prefix
        self.location = location or scratch(spark, "lake")

    # names ------------------------------------------------------------------

    def database(self, folder: str) -> str:
        return self.prefix + "__".join(encode_name(s) for s in split_path(folder))

    def ident(self, path: str) -> Ident:
        parts = split_path(path)
        if len(parts) < 2:
            raise LakeError(f"{path!r} names no entry inside a folder")
        database = self.prefix + "__".join(encode_name(s) for s in parts[:-1])
        return Ident(database, encode_name(parts[-1]))

    def sql_name(self, path: str) -> str:
        return self.ident(path).sql

    @staticmethod
    def canonical(path: str) -> str:
        """A plain dotted path as entries are listed: the catalog ignores case."""
        return path.strip().lower()

    def folder_path(self, database: str) -> str:
        names = database[len(self.prefix) :].split("__")
        return ".".join(decode_name(n) for n in names)

    # looking up ---------------------------------------------------------------

    def databases(self) -> list[str]:
        # SHOW commands answer from the catalog at once; listing functions of
        # the catalog API run a job each.
        rows = self.spark.sql(f"SHOW DATABASES LIKE '{self.prefix}*'").collect()
        return sorted(
            r["namespace"]
            for r in rows
            if r["namespace"].startswith(self.prefix) and (self.prefix or r["namespace"] != "default")
        )

    def _listed(self, database: str) -> list[tuple[str, str]]:
        """``(table name, kind)`` of one database."""
        views = self.spark.sql(f"SHOW VIEWS IN {quote(database)}").collect()
        named = {r["viewName"] for r in views if not r["isTemporary"]}
        tables = self.spark.sql(f"SHOW TABLES IN {quote(database)}").collect()
        return [
            (r["tableName"], VIEW if r["tableName"] in named else TABLE)
            for r in tables
            if not r["isTemporary"] and not r["tableName"].endswith((STAGING, OLD))
        ]

    def set_aside(self, folder: str) -> list[str]:
        """Paths below ``folder`` whose entry a stopped switch has left aside."""
        top, found = self.database(folder), []
        for database in self.databases():
            if database == top or database.startswith(top + "__"):
                rows = self.spark.sql(f"SHOW TABLES IN {quote(database)} LIKE '*{OLD}'").collect()
                where = self.folder_path(database)
                found += [f"{where}.{decode_name(r['tableName'].removesuffix(OLD))}" for r in rows]
        return found

    def partition_columns(self, path: str) -> list[str]:
        """The columns a table is partitioned by, none for a view."""
        rows = [r["col_name"] for r in self.spark.sql(f"DESCRIBE TABLE {self.sql_name(path)}").collect()]
        if "# Partition Information" not in rows:
            return []
        return [c for c in rows[rows.index("# Partition Information") + 1 :] if not c.startswith("#")]

    def folders(self) -> list[str]:
        """Every folder that exists, also the empty ones; parents first."""
        found: set[str] = set()
        for database in self.databases():
            parts = self.folder_path(database).split(".")
            found.update(".".join(parts[:n]) for n in range(1, len(parts) + 1))
        return sorted(found, key=lambda p: (p.count("."), p))

    def is_folder(self, path: str) -> bool:
        wanted = self.database(path)
        return any(d == wanted or d.startswith(wanted + "__") for d in self.databases())

    def kind(self, path: str) -> str | None:
        """TABLE, VIEW or None."""
        return self.kind_of(self.ident(path))

    def kind_of(self, ident: Ident) -> str | None:
        if not self.spark.catalog.tableExists(ident.sql):
            return None
        return VIEW if self.spark.catalog.getTable(ident.sql).tableType == "VIEW" else TABLE

    def entries(self, folder: str | None = None) -> list[tuple[str, str]]:
        """``(path, kind)`` below ``folder`` at any depth, in path order."""
        top = None if folder is None else self.database(folder)
        rows = []
        for database in self.databases():
            if top is not None and database != top and not database.startswith(top + "__"):
                continue
            where = self.folder_path(database)
            rows += [(f"{where}.{decode_name(t)}", kind) for t, kind in self._listed(database)]
        return sorted(rows)

    def inventory(self, folder: str | None = None) -> DataFrame:
        return self.spark.createDataFrame(self.entries(folder), INVENTORY_SCHEMA)

    def table(self, path: str) -> DataFrame:
        if self.kind(path) is None:
            raise LakeError(f"{path!r} does not exist")
        return self.spark.table(self.sql_name(path))

    # folders -----------------------------------------------------------------

    def ensure_folder(self, path: str) -> bool:
        """Make the folder; True when it was not there."""
        name = self.database(path)
        if self.spark.catalog.databaseExists(name):
            return False
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)} LOCATION '{self.location}/{name}'")
        return True

    def drop_folder(self, path: str, cascade: bool = False) -> None:
        """Remove a folder; what is below it goes only with ``cascade``."""
        top = self.database(path)
        inside = [d for d in self.databases() if d == top or d.startswith(top + "__")]
        filled = [d for d in inside if d != top or self._listed(d)]
        if filled and not cascade:
            raise LakeError(f"folder {path!r} is not empty")
        for database in sorted(inside, key=lambda d: -d.count("__")):
            self.spark.sql(f"DROP DATABASE IF EXISTS {quote(database)} CASCADE")

    def drop_if_empty(self, path: str) -> bool:
        """Remove one folder unless it holds anything; True when it went."""
        try:
            self.spark.sql(f"DROP DATABASE IF EXISTS {quote(self.database(path))} RESTRICT")
        except Exception as exc:  # noqa: BLE001 - catalogs differ in the class they raise
            if "NOT_EMPTY" not in str(exc) and "not empty" not in str(exc):
                raise
            return False
        return True

    def drop_empty_folders(self, path: str) -> None:
        """Remove a folder and all below it, deepest first; an entry in one is an error."""
        top = self.database(path)
        inside = [d for d in self.databases() if d == top or d.startswith(top + "__")]
        for database in sorted(inside, key=lambda d: -d.count("__")):
            if self._listed(database):
                raise LakeError(f"folder {self.folder_path(database)!r} is not empty")
            self.spark.sql(f"DROP DATABASE {quote(database)} RESTRICT")

    # properties ----------------------------------------------------------------

    def property(self, path: str, key: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.sql_name(path)}").collect()
        return next((r["value"] for r in rows if r["key"] == key), None)

    def _set_property(self, path: str, key: str, value: str) -> None:
        kind = self.kind(path)
        if kind is None:
            raise LakeError(f"{path!r} is no table or view")
        # \' and \\ are the two characters a quoted SQL string needs escaped.
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER {kind} {self.sql_name(path)} SET TBLPROPERTIES ('{key}' = '{text}')")

    def tags(self, path: str) -> list[str]:
        if self.kind(path) is None:
            raise LakeError(f"{path!r} is no table or view")
        return json.loads(self.property(path, TAGS_PROPERTY) or "[]")

    def set_tags(self, path: str, tags: list[str]) -> None:
        self._set_property(path, TAGS_PROPERTY, json.dumps(list(tags)))

    def wiki(self, path: str) -> str:
        """The wiki of a table or view, or where there is none of that name, of a folder."""
        text = self.folder_wiki(path) if self._only_folder(path) else self.property(path, WIKI_PROPERTY)
        if not text:
            raise LakeError(f"{path!r} has no wiki")
        return text

    def set_wiki(self, path: str, text: str) -> None:
        if self._only_folder(path):
            self.set_folder_wiki(path, text)
        else:
            self._set_property(path, WIKI_PROPERTY, text)

    def delete_wiki(self, path: str) -> None:
        self.set_wiki(path, "")

    def _only_folder(self, path: str) -> bool:
        return (len(split_path(path)) < 2 or self.kind(path) is None) and self.is_folder(path)

    def folder_wiki(self, path: str) -> str | None:
        """What a folder's database keeps; encoded, as its description lists properties as plain text."""
        if not self.spark.catalog.databaseExists(self.database(path)):
            return None
        told = self.spark.sql(f"DESCRIBE DATABASE EXTENDED {quote(self.database(path))}").collect()
        held = " ".join(r["info_value"] for r in told if r["info_name"] == "Properties")
        found = re.search(rf"\({re.escape(WIKI_PROPERTY)},([A-Za-z0-9+/=]*)\)", held)
        return base64.b64decode(found[1]).decode() or None if found else None

    def set_folder_wiki(self, path: str, text: str) -> None:
        if not self.is_folder(path):
            raise LakeError(f"folder {path!r} does not exist")
        self.ensure_folder(path)  # one that is only the way to others has no database yet
        held = base64.b64encode(text.encode()).decode()
        self.spark.sql(f"ALTER DATABASE {quote(self.database(path))} SET DBPROPERTIES ('{WIKI_PROPERTY}' = '{held}')")

    def metadata(self, folder: str | None = None, folders: bool = False) -> DataFrame:
        """Tags and wiki of every entry, as the metadata operators take them; with ``folders`` also of those."""
        rows = [
            (p, k, self.tags(p), self.property(p, WIKI_PROPERTY) or None)
            for p, k in self.entries(folder)
        ]
        if folders:
            top = None if folder is None else self.canonical(folder)
            inside = [p for p in self.folders() if top is None or p == top or p.startswith(top + ".")]
            rows += [(p, FOLDER, [], self.folder_wiki(p)) for p in inside]
        return self.spark.createDataFrame(rows, METADATA_SCHEMA)

    def store_metadata(self, meta: DataFrame) -> None:
        """Keep the tags and wikis of a frame like :meth:`metadata`; a null wiki goes. One row per entry."""
        for row in meta.collect():
            if row["kind"] == FOLDER:
                self.set_folder_wiki(row["path"], row["wiki"] or "")
            else:
                self.set_tags(row["path"], row["tags"] or [])
                self._set_property(row["path"], WIKI_PROPERTY, row["wiki"] or "")
