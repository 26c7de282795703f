"""Rules over a listing of document files: filter, rename, clash checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions import filenames
from lakewright.functions.skew import sorted_join
from lakewright.functions.text import strip


def match_names(listing: DataFrame, wanted: str | Iterable[str] | None) -> DataFrame:
    """The rows whose ``name`` fits any of the patterns."""
    return listing.filter(filenames.matches_any(F.col("name"), wanted))


def invalid_file_names(listing: DataFrame, relative: bool = False) -> DataFrame:
    """The rows whose ``name`` is refused, with the reason."""
    rule = filenames.relative_name_problem if relative else filenames.file_name_problem
    return listing.withColumn("problem", rule(F.col("name"))).filter(F.col("problem").isNotNull())


def rename_plan(files: DataFrame, renames: DataFrame) -> DataFrame:
    """``files(name)`` with ``new_name`` by ``renames(name, new_name)``; a blank
    new name keeps the old one. ``name`` may repeat, ``renames`` names each once."""
    given = renames.select(strip(F.col("name")).alias("name"), strip(F.col("new_name")).alias("given"))
    joined = sorted_join(files, given, "name", "left")
    kept = F.col("given").isNull() | (F.col("given") == "")
    return joined.withColumn("new_name", F.when(kept, F.col("name")).otherwise(F.col("given"))).drop("given")


def unknown_renames(files: DataFrame, renames: DataFrame) -> DataFrame:
    """The renames whose ``name`` no file has."""
    given = renames.withColumn("name", strip(F.col("name")))
    return given.join(files.select("name"), "name", "left_anti")


def name_clashes(files: DataFrame, column: str = "new_name") -> DataFrame:
    """Names several files would end in, with how many."""
    return files.groupBy(column).agg(F.count(F.lit(1)).alias("files")).filter("files > 1")


def rename_files(files: DataFrame, renames: DataFrame) -> DataFrame:
    """:func:`rename_plan`, refused when a rename is unknown, a new name is not
    valid or two files end in one name."""
    unknown = unknown_renames(files, renames)
    if not unknown.isEmpty():
        raise LakeError("a rename names no file", [unknown.first()["name"]])
    planned = rename_plan(files, renames)
    bad = invalid_file_names(planned.select(F.col("new_name").alias("name")))
    if not bad.isEmpty():
        raise LakeError("not a valid file name", [bad.first()["name"]])
    clash = name_clashes(planned)
    if not clash.isEmpty():
        raise LakeError("several files would be named", [clash.first()["new_name"]])
    return planned


def already_there(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Every file whose ``path`` is taken in ``listing(path)``."""
    return files.join(listing.select("path"), "path", "left_semi")
