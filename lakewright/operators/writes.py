"""Writing tables: create, append, and replace through a staging table.

A replaced table is written to ``<name>__staging`` in its own database first;
the switch is two renames and a drop, so a failed write leaves the old table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.lake import OLD, STAGING, VIEW, Ident, Lake


def arranged(df: DataFrame, partition_by: list[str], sort_by: list[str] | None = None) -> DataFrame:
    """``df`` laid out for a partitioned write.

    The rebalance groups rows by partition value but lets the adaptive planner
    split a value that holds much of the data, so there are neither tiny files
    nor one task with a hot partition.
    """
    sort_by = list(sort_by or [])
    if partition_by:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


def _save(
    df: DataFrame,
    name: str,
    partition_by: list[str],
    sort_by: list[str] | None,
    clustered: bool = False,
) -> None:
    laid_out = df if clustered else arranged(df, partition_by, sort_by)
    writer = laid_out.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def create_table(
    lake: Lake,
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    if lake.kind(path) is not None:
        raise LakeError(f"{path!r} already exists")
    lake.ensure_folder(path.rpartition(".")[0])
    _save(df, lake.sql_name(path), list(partition_by or []), sort_by)


def aligned(lake: Lake, df: DataFrame, path: str) -> DataFrame:
    """``df`` with the columns of a table, by name; the table's types win, absent columns are null."""
    target = lake.table(path)
    have = {c.lower(): c for c in df.columns}
    unknown = [c for c in df.columns if c.lower() not in {t.lower() for t in target.columns}]
    if unknown:
        raise LakeError(f"{path!r} has no column(s)", unknown)
    columns = [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    return df.select(*columns)


def append_table(lake: Lake, df: DataFrame, path: str) -> None:
    """Add rows as :func:`aligned` lays them out."""
    aligned(lake, df, path).write.insertInto(lake.sql_name(path), overwrite=False)


def _beside(ident: Ident, suffix: str) -> Ident:
    return Ident(ident.database, ident.table + suffix)


def rename_table(lake: Lake, old: Ident, new: Ident) -> None:
    """Rename inside one database. A catalog may keep the old location of each
    partition, so partitions are matched with the moved folder afterwards."""
    spark = lake.spark
    spark.sql(f"ALTER TABLE {old.sql} RENAME TO {new.sql}")
    described = spark.sql(f"DESCRIBE TABLE {new.sql}").collect()
    if any(r["col_name"] == "# Partition Information" for r in described):
        spark.sql(f"MSCK REPAIR TABLE {new.sql} SYNC PARTITIONS")


def _rename(lake: Lake, old: Ident, new: Ident, kind: str) -> None:
    if kind == VIEW:
        lake.spark.sql(f"ALTER VIEW {old.sql} RENAME TO {new.sql}")
    else:
        rename_table(lake, old, new)


def recover(lake: Lake, path: str) -> None:
    """Finish a switch that stopped half-way: an ``__old`` without its entry goes back."""
    ident = lake.ident(path)
    old = _beside(ident, OLD)
    kind = lake.kind_of(old)
    if kind is not None:
        if lake.kind_of(ident) is not None:
            lake.spark.sql(f"DROP {kind} {old.sql}")
        else:
            _rename(lake, old, ident, kind)


def recover_below(lake: Lake, folder: str) -> None:
    """:func:`recover` for every entry below ``folder`` that was set aside."""
    for path in lake.set_aside(folder):
        recover(lake, path)


def stage(
    lake: Lake,
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    clustered: bool = False,
) -> None:
    """Write ``df`` beside ``path``; drops what it wrote when it fails.

    ``clustered`` says the rows already come partition by partition.
    """
    staging = _beside(lake.ident(path), STAGING)
    lake.ensure_folder(path.rpartition(".")[0])
    lake.spark.sql(f"DROP TABLE IF EXISTS {staging.sql}")
    try:
        _save(df, staging.sql, list(partition_by or []), sort_by, clustered)
    except Exception:
        lake.spark.sql(f"DROP TABLE IF EXISTS {staging.sql}")
        raise


def staged(lake: Lake, path: str) -> DataFrame:
    return lake.spark.table(_beside(lake.ident(path), STAGING).sql)


def drop_staged(lake: Lake, path: str) -> None:
    lake.spark.sql(f"DROP TABLE IF EXISTS {_beside(lake.ident(path), STAGING).sql}")


def switch_all(lake: Lake, paths: list[str]) -> dict[str, bool]:
    """Put every staged table in place, or none; per path, whether it replaced an entry.

    What was there is kept aside until all stand. If one fails, those before it
    are taken back in reverse, and nothing staged stays.
    """
    spark = lake.spark
    begun: list[tuple[Ident, Ident, str | None]] = []
    placed: set[Ident] = set()
    try:
        for path in paths:
            ident = lake.ident(path)
            staging, old = _beside(ident, STAGING), _beside(ident, OLD)
            kind = lake.kind(path)
            if kind is not None:
                _rename(lake, ident, old, kind)
            begun.append((ident, old, kind))
            rename_table(lake, staging, ident)
            placed.add(ident)
    except Exception:
        for ident, old, kind in reversed(begun):
            if ident in placed:
                spark.sql(f"DROP TABLE {ident.sql}")
            if kind is not None:
                _rename(lake, old, ident, kind)
        for path in paths:
            drop_staged(lake, path)
        raise
    for _, old, kind in begun:
        if kind is not None:
            spark.sql(f"DROP {kind} {old.sql}")
    return {path: kind is not None for path, (_, _, kind) in zip(paths, begun, strict=True)}


def switch(lake: Lake, path: str) -> bool:
    """Put the staged table in place of ``path``; True when it replaced one."""
    return switch_all(lake, [path])[path]


def rename_over(lake: Lake, source: str, target: str) -> None:
    """Rename a table inside its folder; what has the target's name goes only when that has worked."""
    ident, new = lake.ident(source), lake.ident(target)
    kind, old = lake.kind(target), _beside(new, OLD)
    if kind is not None:
        _rename(lake, new, old, kind)
    try:
        rename_table(lake, ident, new)
    except Exception:
        if kind is not None:
            _rename(lake, old, new, kind)
        raise
    if kind is not None:
        lake.spark.sql(f"DROP {kind} {old.sql}")


def replace_table(
    lake: Lake,
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Replace ``path``; ``df`` may read the very table it replaces."""
    recover(lake, path)
    stage(lake, df, path, partition_by, sort_by)
    switch(lake, path)
