"""Copying, moving, versioning, releasing and publishing tables.

Every job checks everything first and raises all problems together; new data
is written to staging tables and put in place only when all of it is there.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions.content import fingerprint
from lakewright.functions.paths import split_path
from lakewright.lake import OLD, TABLE, VIEW, Ident, Lake
from lakewright.operators import writes
from lakewright.operators.inventory import DRAFT, REFERENCE, VERSIONS
from lakewright.operators.lineage import view_definition
from lakewright.operators.metadata import untag_below
from lakewright.operators.views import create_view, create_view_as
from lakewright.plans.lifecycle import PUBLIC_TAG, publish_plan, release_plan, version_plan

# Table jobs of one plan that run at the same time.
PARALLEL_JOBS = 4
REPORT_SCHEMA = "source string, target string, status string, rows long, note string"


def _report(lake: Lake, rows: list[tuple]) -> DataFrame:
    return lake.spark.createDataFrame(rows, REPORT_SCHEMA)


def partition_columns(lake: Lake, path: str) -> list[str]:
    """The columns a table is partitioned by, none for a view."""
    return lake.partition_columns(path) if lake.kind(path) == TABLE else []


def in_parallel(lake: Lake, work: Callable, items: list) -> list:
    """``work`` over ``items``, a few at a time; the first failure is raised
    when all that were started have ended."""
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        futures = [pool.submit(inheritable_thread_target(lake.spark)(work), item) for item in items]
    return [f.result() for f in futures]


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def target_path(lake: Lake, source: str, target: str) -> str:
    """A target that is a folder receives the source's own name."""
    plain = target.rstrip("/")
    if target.endswith("/") or lake.is_folder(plain):
        return f"{plain}.{split_path(source)[-1]}"
    return plain


def copy_table(
    lake: Lake, source: str, target: str, overwrite: bool = False, create_folder: bool = False
) -> DataFrame:
    """Copy a table's (or a view's) rows into a table of its own."""
    if lake.kind(source) is None:
        raise LakeError(f"{source!r} does not exist")
    target = target_path(lake, source, target)
    folder = target.rpartition(".")[0]
    if not create_folder and not lake.is_folder(folder):
        raise LakeError(f"folder {folder!r} does not exist")
    writes.recover(lake, target)  # what a stopped switch set aside counts as there
    kind = lake.kind(target)
    if kind is not None and not overwrite:
        raise LakeError(f"{target!r} already exists")
    # A partitioned source is read partition by partition: no shuffle is needed.
    counted, seen = _counted(lake.table(source))
    by = partition_columns(lake, source)
    writes.stage(lake, counted, target, by, clustered=True)
    writes.switch(lake, target)
    return _report(lake, [(source, target, "replaced" if kind else "copied", seen.get["rows"], None)])


def drop_table(lake: Lake, path: str) -> bool:
    return _drop(lake, path, TABLE)


def drop_view(lake: Lake, path: str) -> bool:
    return _drop(lake, path, VIEW)


def _drop(lake: Lake, path: str, wanted: str) -> bool:
    kind = lake.kind(path)
    if kind is None:
        return False
    if kind != wanted:
        raise LakeError(f"{path!r} is a {kind.lower()}, not a {wanted.lower()}")
    lake.spark.sql(f"DROP {wanted} {lake.sql_name(path)}")
    return True


def drop_entry(lake: Lake, path: str) -> bool:
    kind = lake.kind(path)
    return False if kind is None else _drop(lake, path, kind)


def table_to_view(lake: Lake, view: str, source: str) -> None:
    """Put a view over ``source`` in place of the table ``view``."""
    if lake.kind(source) is None:
        raise LakeError(f"{source!r} does not exist")
    if lake.ident(view) == lake.ident(source):
        raise LakeError("a view cannot select from itself")
    if lake.kind(view) != TABLE:
        create_view(lake, source, view, overwrite=True)
        return
    # The table is only set aside until the view stands.
    ident = lake.ident(view)
    aside = Ident(ident.database, ident.table + OLD)
    writes.rename_table(lake, ident, aside)
    try:
        create_view(lake, source, view)
    except Exception:
        writes.rename_table(lake, aside, ident)
        raise
    lake.spark.sql(f"DROP TABLE {aside.sql}")


def verify_copy(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(path, source_rows, target_rows, same)``: equal counts and content per pair."""
    parts = []
    for path, sides in pairs.items():
        for side, df in zip(("source", "target"), sides):
            parts.append(fingerprint(df).select(F.lit(path).alias("path"), F.lit(side).alias("side"), F.struct("*").alias("print")))
    prints = parts[0]
    for part in parts[1:]:
        prints = prints.unionAll(part)

    def of(side: str):
        return F.max(F.when(F.col("side") == side, F.col("print"))).alias(side)

    # Two rows per pair: one fingerprint for each side.
    return prints.groupBy("path").agg(of("source"), of("target")).select(
        "path",
        F.col("source.rows").alias("source_rows"),
        F.col("target.rows").alias("target_rows"),
        (F.col("source") == F.col("target")).alias("same"),
    )


def move_table(
    lake: Lake, source: str, target: str, overwrite: bool = False, create_folder: bool = False
) -> DataFrame:
    """Move a table or view; the source goes only when the target is proven."""
    kind = lake.kind(source)
    if kind is None:
        raise LakeError(f"{source!r} does not exist")
    target = target_path(lake, source, target)
    if lake.ident(source) == lake.ident(target):
        raise LakeError("source and target are the same")
    writes.recover(lake, target)
    if lake.kind(target) is not None and not overwrite:
        raise LakeError(f"{target!r} already exists")
    folder = target.rpartition(".")[0]
    if not create_folder and not lake.is_folder(folder):
        raise LakeError(f"folder {folder!r} does not exist")
    lake.ensure_folder(folder)
    tags, wiki = lake.tags(source), lake.property(source, "lakewright.wiki")
    if kind == VIEW:
        # The view's own text is kept: a view over the old one would break.
        sql, context = view_definition(lake, source)
        if lake.kind(target) == TABLE:
            raise LakeError(f"{target!r} is a table: a view never replaces one")
        create_view_as(lake, target, sql, overwrite, context)
        drop_view(lake, source)
        rows = None
    elif lake.ident(source).database == lake.ident(target).database:
        writes.rename_over(lake, source, target)
        rows = lake.table(target).count()
    else:
        rows = copy_table(lake, source, target, overwrite, create_folder).first()["rows"]
        check = verify_copy({target: (lake.table(source), lake.table(target))}).first()
        if not check["same"]:
            raise LakeError(f"{target!r} does not equal {source!r}: the source stays")
        drop_table(lake, source)
    if lake.kind(target) is None:
        raise LakeError(f"{target!r} is not there after the move")
    if tags:
        lake.set_tags(target, tags)
    if wiki:
        lake.set_wiki(target, wiki)
    return _report(lake, [(source, target, "moved", rows, None)])


def _stage_all(lake: Lake, copies: list[tuple[str, str, list[str], bool]]) -> dict[str, int]:
    """Write every ``(source, target, partition, clustered)`` to staging and check
    that as many rows can be read as were written; all or nothing."""

    def one(copy):
        source, target, partition, clustered = copy
        writes.recover(lake, target)
        counted, seen = _counted(lake.table(source))
        writes.stage(lake, counted, target, partition, clustered=clustered)
        rows = seen.get["rows"]
        if writes.staged(lake, target).count() != rows:
            raise LakeError(f"{target!r} cannot be read back whole")
        return target, rows

    try:
        return dict(in_parallel(lake, one, copies))
    except Exception:
        for _, target, _, _ in copies:
            writes.drop_staged(lake, target)
        raise


def create_version(
    lake: Lake,
    source: str,
    version: str,
    target: str,
    tables: list[str] | None = None,
    overwrite: bool = False,
    create_target_folder: bool = False,
    include_views: bool = False,
) -> DataFrame:
    """Snapshot a selection of tables into ``{target}.{version}``."""
    source, target, version = (lake.canonical(p) for p in (source, target, version))
    tables = [lake.canonical(t) for t in tables or []]
    if not version or "." in version:
        raise LakeError(f"a version is one non-blank folder name, not {version!r}")
    if not lake.is_folder(source):
        raise LakeError(f"source {source!r} does not exist")
    if not create_target_folder and not lake.is_folder(target):
        raise LakeError(f"target {target!r} does not exist")
    version_path = f"{target}.{version}"
    writes.recover_below(lake, version_path)
    existed = lake.is_folder(version_path)
    if existed and not overwrite:
        raise LakeError(f"version {version_path!r} already exists")
    plan = version_plan(lake.inventory(source), source, version_path, tables, include_views).collect()
    copies = [r for r in plan if r["action"] == "copy"]
    skipped = [r for r in plan if r["action"] == "skip"]
    if not copies:
        raise LakeError("nothing to copy", [f"{r['source']}: {r['reason']}" for r in skipped])
    made = [f for f in sorted({r["target"].rpartition(".")[0] for r in copies}) if lake.ensure_folder(f)]
    try:
        rows = _stage_all(
            lake, [(r["source"], r["target"], partition_columns(lake, r["source"]), True) for r in copies]
        )
        switched = writes.switch_all(lake, [r["target"] for r in copies])
    except Exception:
        # Only folders of this call, and only while nothing of anyone else is in them.
        for folder in reversed(made):
            lake.drop_if_empty(folder)
        raise
    report = []
    for r in copies:
        replaced = switched[r["target"]]
        note = "from a view" if r["kind"] == VIEW else None
        report.append((r["source"], r["target"], "replaced" if replaced else "copied", rows[r["target"]], note))
    report += [(r["source"], None, "skipped", None, r["reason"]) for r in skipped]
    return _report(lake, report)


def find_draft(lake: Lake, context: str) -> str:
    """The nearest ``draft`` in the context, else the ``draft`` right below it."""
    context = lake.canonical(context)
    names = context.split(".")
    if DRAFT in names:
        return ".".join(names[: len(names) - names[::-1].index(DRAFT)])
    if lake.is_folder(f"{context}.{DRAFT}"):
        return f"{context}.{DRAFT}"
    raise LakeError(f"{context!r} neither is in a {DRAFT!r} folder nor holds one")


def draft_to_version(
    lake: Lake, context: str, version: str, tables: list[str] | None = None, overwrite: bool = False
) -> DataFrame:
    """Snapshot the draft beside itself; its views become tables."""
    draft = find_draft(lake, context)
    parent = draft.rpartition(".")[0]
    if not parent:
        raise LakeError(f"{draft!r} has no parent folder for versions")
    return create_version(
        lake, draft, version, f"{parent}.{VERSIONS}", tables, overwrite,
        create_target_folder=True, include_views=True,
    )


def require_area(lake: Lake, area: str, publish: bool = False) -> None:
    """An area holds a draft and versions, and to be published a reference folder."""
    missing = [f for f in (DRAFT, VERSIONS) if not lake.is_folder(f"{area}.{f}")]
    if publish and not any(lake.is_folder(f"{area}.{f}") for f in REFERENCE):
        missing.append(REFERENCE[0])
    if missing:
        raise LakeError(f"{area!r} is no area: it lacks", missing)


def update_latest_release(lake: Lake, area: str, version: str, overwrite: bool = True) -> DataFrame:
    """One public view at the area's root per table of the version."""
    area, version = lake.canonical(area), lake.canonical(version)
    require_area(lake, area)
    if not lake.is_folder(f"{area}.{VERSIONS}.{version}"):
        raise LakeError(f"version {version!r} of {area!r} does not exist")
    rows = release_plan(lake.inventory(area), area, version, overwrite).collect()
    problems = [f"{r['target']}: {r['problem']}" for r in rows if r["problem"]]
    if problems:
        raise LakeError("no views created", problems)
    todo = [r for r in rows if r["action"] != "skip"]
    if not todo:
        raise LakeError(f"version {version!r} of {area!r} has no tables")
    created: list[str] = []
    untagged: list[tuple[str, list[str]]] = []
    try:
        for r in todo:
            create_view(lake, r["source"], r["target"], overwrite=True)
            if r["action"] == "create":
                created.append(r["target"])
            tags = lake.tags(r["target"])
            if PUBLIC_TAG not in tags:
                lake.set_tags(r["target"], [*tags, PUBLIC_TAG])
        versions = f"{area}.{VERSIONS}"
        for r in untag_below(lake.metadata(versions), versions, PUBLIC_TAG).collect():
            lake.set_tags(r["path"], r["tags"])
            untagged.append((r["path"], r["previous"]))
    except Exception:
        for path, tags in untagged:
            lake.set_tags(path, tags)
        for path in created:
            drop_view(lake, path)
        raise
    status = {"create": "created", "replace": "replaced", "skip": "skipped"}
    return _report(
        lake,
        [
            (r["source"], r["target"], status[r["action"]], None,
             "view: only tables get a view" if r["action"] == "skip" else None)
            for r in rows
        ],
    )


def publish(
    lake: Lake, area: str, public_root: str, overwrite: bool = True, partition_by=None
) -> DataFrame:
    """Write every public view of the area as a Parquet table below ``public_root``.

    All tables are staged and counted before the first is put in place, so a
    failure leaves what was published before untouched.
    """
    area, public_root = lake.canonical(area), lake.canonical(public_root)
    if isinstance(partition_by, dict):
        partition_by = {lake.canonical(v): fields for v, fields in partition_by.items()}
    require_area(lake, area, publish=True)
    writes.recover_below(lake, public_root)
    meta = lake.metadata(area)
    views = [p for p, k in lake.entries(area) if k == VIEW]
    columns = lake.spark.createDataFrame(
        [(v, lake.table(v).columns) for v in views], "path string, names array<string>"
    )
    published = lake.inventory(public_root)
    rows = publish_plan(meta, columns, published, area, public_root, overwrite, partition_by).collect()
    problems = [f"{r['view']}: {r['problem']}" for r in rows if r["problem"]]
    todo = [r for r in rows if r["action"] != "skip"]
    if isinstance(partition_by, dict):
        known = {r["view"] for r in todo}
        wanted = [area + "." + v.strip().replace("/", ".").strip(".") for v in partition_by]
        problems += [f"{v} is to be partitioned but is not published" for v in wanted if v not in known]
    if problems:
        raise LakeError("nothing published", problems)
    if not todo:
        raise LakeError(f"{area!r} has no views tagged {PUBLIC_TAG!r}")
    staged = _stage_all(lake, [(r["view"], r["target"], list(r["partition"]), False) for r in todo])
    switched = writes.switch_all(lake, [r["target"] for r in todo])
    report = []
    for r in todo:
        replaced = switched[r["target"]]
        note = f"partitioned by {', '.join(r['partition'])}" if r["partition"] else None
        report.append((r["view"], r["target"], "replaced" if replaced else "copied", staged[r["target"]], note))
    report += [
        (r["view"], None, "skipped", None, f"no {PUBLIC_TAG} tag") for r in rows if r["action"] == "skip"
    ]
    return _report(lake, report)
