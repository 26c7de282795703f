"""The rules of an XML schema as plain rows: what an element may hold, how often, and of which type.

Read on the driver: a schema is a handful of files, whatever the number of records.
"""

from __future__ import annotations

import posixpath
import xml.etree.ElementTree as ET
from collections.abc import Callable
from dataclasses import dataclass, field

XS = "{http://www.w3.org/2001/XMLSchema}"
UNBOUNDED = 1 << 30
#: The type of content that may be anything.
OPEN = "*"

_INTEGER, _DECIMAL = r"[+-]?\d+", r"[+-]?(\d+(\.\d*)?|\.\d+)"
_DAY, _ZONE = r"-?\d{4,}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])", r"(Z|[+-]\d{2}:\d{2})?"
_TIME = r"([01]\d|2[0-4]):[0-5]\d:[0-5]\d(\.\d+)?"
# The lexical forms of the built-in types that restrict their text.
FORMS = {
    "boolean": "true|false|0|1",
    "decimal": _DECIMAL,
    "double": rf"{_DECIMAL}([eE][+-]?\d+)?|[+-]?INF|NaN",
    "float": rf"{_DECIMAL}([eE][+-]?\d+)?|[+-]?INF|NaN",
    "date": _DAY + _ZONE,
    "dateTime": f"{_DAY}T{_TIME}{_ZONE}",
    "time": _TIME + _ZONE,
    "gYear": rf"-?\d{{4,}}{_ZONE}",
    **dict.fromkeys(("integer", "long", "int", "short", "byte"), _INTEGER),
    "nonNegativeInteger": r"\+?\d+|-0+",
    "positiveInteger": r"\+?0*[1-9]\d*",
    **dict.fromkeys(("unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte"), r"\+?\d+"),
}


@dataclass
class Content:
    """What elements of one type hold: per slot how often, per name its slot and type."""

    slots: dict[str, tuple[int, int]] = field(default_factory=dict)
    names: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: set[str] = field(default_factory=set)
    form: str | None = None
    values: list[str] | None = None
    open: bool = False


@dataclass
class Rules:
    """The type of each root element, and what elements of each type hold."""

    roots: dict[str, str]
    types: dict[str, Content]


def _occurs(node: ET.Element) -> tuple[int, int]:
    most = node.get("maxOccurs", "1")
    return int(node.get("minOccurs", "1")), UNBOUNDED if most == "unbounded" else int(most)


class _Reader:
    def __init__(self, path: str, text_of: Callable[[str], str]):
        self.top: dict[tuple[str, str], tuple[ET.Element, dict]] = {}
        self.members: dict[str, list[str]] = {}
        self.types: dict[str, Content] = {}
        self._files(path, text_of, set(), None)
        for (kind, name), (node, at) in list(self.top.items()):
            if kind == "element" and node.get("substitutionGroup"):
                self.members.setdefault(self._name(node.get("substitutionGroup"), at), []).append(name)

    def _files(self, path: str, text_of: Callable, seen: set[tuple], into: str | None) -> None:
        if (path, into) in seen:
            return
        seen.add((path, into))
        prefixes: dict[str, str] = {}
        parser = ET.XMLPullParser(("start-ns", "start"))
        parser.feed(text_of(path).encode())
        root = None
        for event, value in parser.read_events():
            if event == "start-ns":
                prefixes.setdefault(*value)
            elif root is None:
                root = value
        parser.close()
        space = root.get("targetNamespace", into or "")
        at = {"prefixes": prefixes, "space": space, "qualified": root.get("elementFormDefault") == "qualified"}
        for node in root:
            kind = node.tag.removeprefix(XS)
            if kind in ("include", "import") and node.get("schemaLocation"):
                beside = posixpath.normpath(posixpath.join(posixpath.dirname(path), node.get("schemaLocation")))
                self._files(beside if "://" not in node.get("schemaLocation") else node.get("schemaLocation"), text_of, seen, space if kind == "include" else None)
            elif node.get("name"):
                self.top[kind, f"{{{space}}}{node.get('name')}"] = (node, at)

    @staticmethod
    def _name(text: str, at: dict) -> str:
        prefix, _, local = text.rpartition(":")
        space = at["prefixes"].get(prefix, "" if prefix else at["space"])
        return f"{{{space}}}{local}"

    def _alike(self, head: str) -> list[str]:
        """An element and all that may stand in its place."""
        found = [head]
        for name in found:
            found += [m for m in self.members.get(name, []) if m not in found]
        node, _ = self.top.get(("element", head), (ET.Element(""), {}))
        return found[1:] if node.get("abstract") == "true" else found

    def type_of(self, node: ET.Element, at: dict, label: str) -> str:
        """The name of an element's type, whose content is worked out once."""
        inner = next((c for c in node if c.tag in (f"{XS}complexType", f"{XS}simpleType")), None)
        if inner is not None:
            if label not in self.types:
                self.types[label] = Content()
                self._fill(self.types[label], inner, at, label)
            return label
        if node.get("type"):
            return self._named(self._name(node.get("type"), at))
        if node.get("substitutionGroup"):
            head = self.top.get(("element", self._name(node.get("substitutionGroup"), at)))
            return self.type_of(*head, self._name(node.get("substitutionGroup"), at) + "()") if head else OPEN
        return OPEN

    def _named(self, name: str) -> str:
        if name.startswith(XS):
            return OPEN if name == f"{XS}anyType" else self._built_in(name)
        if name not in self.types:
            found = self.top.get(("complexType", name)) or self.top.get(("simpleType", name))
            if found is None:
                return OPEN
            self.types[name] = Content()
            self._fill(self.types[name], *found, name)
        return name

    def _built_in(self, name: str) -> str:
        self.types.setdefault(name, Content(form=FORMS.get(name.removeprefix(XS))))
        return name

    def _fill(self, content: Content, node: ET.Element, at: dict, label: str, times: tuple[int, int] = (1, 1)) -> None:
        """Add what a piece of a type says, standing ``times`` in it."""
        for child in node:
            kind = child.tag.removeprefix(XS) if isinstance(child.tag, str) else ""
            least, most = _occurs(child)
            both = (times[0] * least, min(UNBOUNDED, times[1] * most))
            if kind in ("complexContent", "simpleContent"):
                self._fill(content, child, at, label, times)
            elif kind in ("extension", "restriction"):
                base = self.types.get(self._named(self._name(child.get("base"), at))) if child.get("base") else None
                if base is None and child.get("base"):
                    content.open = content.open or kind == "extension"
                if base is not None:
                    content.form, content.values = base.form, base.values
                    content.required |= base.required
                    content.open = content.open or base.open
                    if kind == "extension":
                        content.slots |= base.slots
                        content.names |= base.names
                allowed = [c.get("value") for c in child if c.tag == f"{XS}enumeration"]
                content.values = allowed or content.values
                self._fill(content, child, at, label, times)
            elif kind in ("union", "list"):
                content.form = content.values = None
            elif kind == "sequence" or kind == "all":
                self._fill(content, child, at, label, both)
            elif kind == "choice":
                self._fill(content, child, at, label, (0, both[1]))
            elif kind == "group" and child.get("ref"):
                found = self.top.get(("group", self._name(child.get("ref"), at)))
                if found:
                    self._fill(content, *found, label, both)
                else:
                    content.open = True
            elif kind == "any":
                content.open = True
            elif kind in ("attribute", "attributeGroup"):
                self._attribute(content, child, at)
            elif kind == "element":
                self._element(content, child, at, label, both)

    def _attribute(self, content: Content, node: ET.Element, at: dict) -> None:
        if node.tag == f"{XS}attributeGroup":
            found = self.top.get(("attributeGroup", self._name(node.get("ref", ""), at)))
            for child in found[0] if found else ():
                if child.tag in (f"{XS}attribute", f"{XS}attributeGroup"):
                    self._attribute(content, child, found[1])
        elif node.get("use") == "required":
            content.required.add(node.get("name") or self._name(node.get("ref"), at))

    def _element(self, content: Content, node: ET.Element, at: dict, label: str, times: tuple[int, int]) -> None:
        if node.get("ref"):
            slot = self._name(node.get("ref"), at)
            held = [(n, *self.top[("element", n)]) for n in self._alike(slot) if ("element", n) in self.top]
            content.open = content.open or not held
        else:
            qualified = node.get("form", "qualified" if at["qualified"] else "") == "qualified"
            slot = f"{{{at['space'] if qualified else ''}}}{node.get('name')}"
            held = [(slot, node, at)]
        least, most = content.slots.get(slot, (0, 0))
        content.slots[slot] = (least + times[0], min(UNBOUNDED, most + times[1]))
        for name, found, where in held:
            # The slot comes first: a type may hold itself.
            content.names[name] = (slot, "")
            content.names[name] = (slot, self.type_of(found, where, f"{name}()" if node.get("ref") else f"{label}/{name}"))


def read_rules(path: str, text_of: Callable[[str], str]) -> Rules:
    """The rules of the schema at ``path`` and all files it takes in; ``text_of`` reads one."""
    reader = _Reader(path, text_of)
    roots = {name: reader.type_of(node, at, f"{name}()") for (kind, name), (node, at) in list(reader.top.items()) if kind == "element"}
    return Rules(roots, reader.types)
