"""Copying and moving whole folders, with a status for every entry."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakewright.errors import LakeError
from lakewright.lake import FOLDER, TABLE, VIEW, WIKI_PROPERTY, Lake
from lakewright.operators import lifecycle
from lakewright.operators.lineage import view_definition
from lakewright.operators.views import create_view_as
from lakewright.plans.folders import folder_scan

REPORT_SCHEMA = (
    "kind string, source string, target string, status string, "
    "source_rows long, target_rows long, note string"
)
VIEW_SCHEMA = "path string, sql string, context array<string>"


def view_definitions(lake: Lake, folder: str | None = None) -> DataFrame:
    """``(path, sql, context)`` of the views below ``folder``; unreadable ones are left out."""
    rows = []
    for path, kind in lake.entries(folder):
        if kind == VIEW:
            try:
                sql, context = view_definition(lake, path)
            except LakeError:
                continue
            rows.append((path, sql, context))
    return lake.spark.createDataFrame(rows, VIEW_SCHEMA)


def scan(lake: Lake, source: str, target: str) -> DataFrame:
    """:func:`lakewright.plans.folders.folder_scan` of a lake's own entries."""
    source, target = lake.canonical(source), lake.canonical(target)
    known = lake.spark.createDataFrame([(f,) for f in lake.folders()], "path string")
    return folder_scan(lake.inventory(), view_definitions(lake, source), source, target, known)


def _rows(lake: Lake, path: str) -> int:
    return lake.table(path).count()


def _copy_one(lake: Lake, entry, overwrite: bool, skip_existing: bool) -> tuple:
    """``(status, source rows, target rows, note)`` of one table."""
    source, target = entry["source"], entry["target"]
    rows = _rows(lake, source)
    if lake.kind(target) is not None and not overwrite:
        there = _rows(lake, target)
        if skip_existing and there == rows:
            return "skipped", rows, there, None
        return "failed", rows, there, f"already exists with {there} row(s), the source has {rows}"
    lifecycle.copy_table(lake, source, target, overwrite=overwrite, create_folder=True)
    return "copied", rows, _rows(lake, target), None


def _view_one(lake: Lake, entry, overwrite: bool, skip_existing: bool, verify: bool) -> tuple:
    source, target = entry["source"], entry["target"]
    if entry["new_sql"] is None:
        return "failed", None, None, "; ".join(entry["notes"])
    status = "created"
    if lake.kind(target) is not None and skip_existing and not overwrite:
        status = "skipped"
    else:
        create_view_as(lake, target, entry["new_sql"], overwrite)
    if not verify:
        return status, None, None, "; ".join(entry["notes"]) or None
    left, right = _rows(lake, source), _rows(lake, target)
    if left != right:
        return "failed", left, right, "the rewritten view gives another number of rows"
    return status, left, right, "; ".join(entry["notes"]) or None


def _carry(lake: Lake, entry) -> None:
    if entry["kind"] == FOLDER:
        _carry_folder(lake, entry["source"], entry["target"])
        return
    tags, wiki = lake.tags(entry["source"]), lake.property(entry["source"], WIKI_PROPERTY)
    if tags:
        lake.set_tags(entry["target"], tags)
    if wiki:
        lake.set_wiki(entry["target"], wiki)


def _carry_folder(lake: Lake, source: str, target: str) -> None:
    if wiki := lake.folder_wiki(source):
        lake.ensure_folder(target)
        lake.set_folder_wiki(target, wiki)


def folder_copy(
    lake: Lake,
    source: str,
    target: str,
    *,
    dry_run: bool = False,
    overwrite: bool = False,
    skip_existing: bool = True,
    verify_views: bool = True,
    copy_metadata: bool = True,
    plan: DataFrame | None = None,
) -> DataFrame:
    """Reproduce a folder below ``target``; one report row per entry.

    A failed entry does not stop the others. An occupied target is left alone
    when it has as many rows as its source, else it is a failure, unless
    ``overwrite``.
    """
    # One row per catalog entry, in the order they can be made.
    entries = (scan(lake, source, target) if plan is None else plan).collect()
    order = {FOLDER: 0, TABLE: 1, VIEW: 2}
    unordered = 1 << 30
    entries.sort(
        key=lambda e: (
            order[e["kind"]],
            e["source"].count(".") if e["kind"] == FOLDER else unordered if e["level"] is None else e["level"],
            e["source"],
        )
    )

    def one(entry) -> tuple:
        head = (entry["kind"], entry["source"], entry["target"])
        if dry_run:
            if entry["kind"] == VIEW and entry["new_sql"] is None:
                return (*head, "failed", None, None, "; ".join(entry["notes"]))
            rows = _rows(lake, entry["source"]) if entry["kind"] == TABLE else None
            return (*head, "planned", rows, None, "; ".join(entry["notes"]) or None)
        try:
            if entry["kind"] == FOLDER:
                lake.ensure_folder(entry["target"])
                result = ("created", None, None, None)
            elif entry["kind"] == TABLE:
                result = _copy_one(lake, entry, overwrite, skip_existing)
            else:
                result = _view_one(lake, entry, overwrite, skip_existing, verify_views)
            if copy_metadata and result[0] != "failed":
                _carry(lake, entry)
        except Exception as exc:  # noqa: BLE001 - the report carries the reason
            result = ("failed", None, None, str(exc))
        return (*head, *result)

    report = [one(e) for e in entries if e["kind"] == FOLDER]
    report += lifecycle.in_parallel(lake, one, [e for e in entries if e["kind"] == TABLE])
    report += [one(e) for e in entries if e["kind"] == VIEW]
    if copy_metadata and not dry_run:
        # The folder itself is no entry of its plan.
        _carry_folder(lake, source, target)
    return lake.spark.createDataFrame(report, REPORT_SCHEMA)


def is_verified(report: DataFrame) -> bool:
    """No failure, nothing only planned, and every table counted equal."""
    # SQL three-valued logic: a table without a count is not equal.
    bad = report.filter(
        "status IN ('failed', 'planned') OR "
        "(kind = 'TABLE' AND NOT coalesce(source_rows = target_rows, false))"
    )
    return bad.isEmpty()


def folder_move(lake: Lake, source: str, target: str, *, overwrite: bool = False) -> DataFrame:
    """:func:`folder_copy`, then remove the source if, and only if, the copy is proven.

    The proof is the report plus equal content of every copied table.
    """
    plan = scan(lake, source, target).collect()
    frame = lake.spark.createDataFrame(plan, scan_schema())
    report = folder_copy(lake, source, target, overwrite=overwrite, plan=frame)
    if not is_verified(report):
        return report
    tables = [e for e in plan if e["kind"] == TABLE]

    def same(entry) -> bool:
        pair = (lake.table(entry["source"]), lake.table(entry["target"]))
        return lifecycle.verify_copy({entry["target"]: pair}).first()["same"]

    if not all(lifecycle.in_parallel(lake, same, tables)):
        raise LakeError(f"a copy differs from its source: {source!r} stays")
    views = sorted((e for e in plan if e["kind"] == VIEW), key=lambda e: -(e["level"] or 0))
    for entry in views:
        lifecycle.drop_view(lake, entry["source"])
    for entry in tables:
        lifecycle.drop_table(lake, entry["source"])
    # Not by cascade: what came in meanwhile was not copied and must stay.
    lake.drop_empty_folders(source)
    return report


def scan_schema() -> str:
    return (
        "kind string, source string, target string, level int, new_sql string, "
        "references array<string>, notes array<string>"
    )
