"""Unified schemas, schema checks and file checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.errors import LakeError
from lakewright.functions.sqltypes import normalised_type_col, widest
from lakewright.sources import files
from lakewright.sources.typing import CsvOptions, csv_column_types, json_column_types

# Our own row-count classes: (upper bound, name).
SIZE_CLASSES = ((100_000, "small"), (10_000_000, "medium"), (1_000_000_000, "large"))


def column_types(
    spark: SparkSession, root: str, fmt: str, csv: CsvOptions | None = None
) -> DataFrame:
    """``(path, ordinal, name, type)`` of every file of one format below ``root``."""
    if fmt == "parquet":
        footers = files.footer_schemas(files.file_inventory(spark, root, fmt))
        return footers.select("path", "ordinal", "name", "type")
    if fmt == "csv":
        return csv_column_types(spark, root, csv or CsvOptions())
    return json_column_types(spark, root)


def unified_schema(file_columns: DataFrame) -> DataFrame:
    """One row per column over all files: place in first-seen order, widest type.

    A file can hold a name once, so the set of types per name is small whatever
    the number of files; both aggregates combine before the shuffle.
    """
    merged = file_columns.groupBy("name").agg(
        F.min(F.struct("path", "ordinal")).alias("first"), F.collect_set("type").alias("kinds")
    )
    nested = F.filter(F.col("kinds"), lambda k: k.startswith(files.UNSUPPORTED))
    kind = F.when(F.size(nested) > 0, F.get(nested, F.lit(0))).otherwise(widest(F.col("kinds")))
    return merged.select(
        F.col("first.path").alias("first_path"),
        F.col("first.ordinal").alias("first_ordinal"),
        "name",
        kind.alias("type"),
    )


def schema_list(unified: DataFrame) -> list[tuple[str, str]]:
    """The unified columns on the driver (a schema, not data); nested ones are refused."""
    rows = unified.orderBy("first_path", "first_ordinal").collect()
    nested = [f"{r['name']}: {r['type']}" for r in rows if r["type"].startswith(files.UNSUPPORTED)]
    if any(r["name"] is None for r in rows):
        raise LakeError("not JSON lines: some lines hold no object")
    if nested:
        raise LakeError("nested columns are not supported", nested)
    return [(r["name"], r["type"]) for r in rows]


def schema_mismatches(given: DataFrame, actual: DataFrame) -> DataFrame:
    """``(position, name, problem)`` where ``given(position, name, type)`` disagrees
    with ``actual(position, name, type)``.

    Names are compared ignoring case, types after :func:`normalised_type`;
    columns only ``actual`` has are fine.
    """
    known = actual.groupBy(F.lower("name").alias("key")).agg(
        F.max_by("type", "position").alias("found")
    )
    same = normalised_type_col(F.col("type")) == normalised_type_col(F.col("found"))
    problem = F.when(
        F.col("found").isNull(), F.concat("name", F.lit(": not in the files"))
    ).when(
        ~same,
        F.concat("name", F.lit(": given "), "type", F.lit(", the files have "), "found"),
    )
    return (
        given.withColumn("key", F.lower("name")).join(known, "key", "left")
        .select("position", "name", problem.alias("problem"))
        .filter(F.col("problem").isNotNull())
    )


def check_columns(
    spark: SparkSession, given: list[tuple[str, str]], actual: list[tuple[str, str]]
) -> list[str]:
    """:func:`schema_mismatches` for two schemas held as arguments."""
    schema = "position int, name string, type string"
    left = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(given)], schema)
    right = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(actual)], schema)
    return [r["problem"] for r in schema_mismatches(left, right).orderBy("position").collect()]


def oversized_files(listing: DataFrame, cap: int) -> DataFrame:
    """The files larger than ``cap`` bytes."""
    return listing.filter(F.col("size") > cap)


def largest_file(listing: DataFrame) -> DataFrame:
    """One row: the largest file and its size."""
    return listing.agg(F.max_by("rel_path", "size").alias("rel_path"), F.max("size").alias("size"))


def row_estimate(listing: DataFrame, fmt: str = "parquet") -> DataFrame:
    """``(files, rows, size_class)`` from Parquet footers; other formats report 0 rows."""
    if fmt == "parquet":
        per_file = files.footer_schemas(listing).groupBy("path").agg(F.max("rows").alias("rows"))
    else:
        per_file = listing.select("path", F.lit(0).cast("long").alias("rows"))
    total = per_file.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    size = F.lit("huge")
    for bound, name in reversed(SIZE_CLASSES):
        size = F.when(F.col("rows") < bound, F.lit(name)).otherwise(size)
    return total.withColumn("size_class", size)


def preflight(listing: DataFrame, footers: DataFrame, expected: DataFrame) -> DataFrame:
    """``(dataset, files, bytes, rows, expected_rows, ok)`` per declared dataset.

    ``listing`` and ``footers`` carry a ``dataset`` column, ``expected`` is
    ``(dataset, expected_rows)``. A dataset without files is not ok.
    """
    sizes = listing.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )
    rows = (
        footers.select("dataset", "path", "rows").distinct()
        .groupBy("dataset").agg(F.sum("rows").alias("rows"))
    )
    joined = expected.join(sizes, "dataset", "left").join(rows, "dataset", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "dataset",
        F.coalesce("files", zero).alias("files"),
        F.coalesce("bytes", zero).alias("bytes"),
        F.coalesce("rows", zero).alias("rows"),
        "expected_rows",
        (F.coalesce("files", zero) > 0).alias("found"),
        (F.coalesce("rows", zero) == F.col("expected_rows")).alias("rows_agree"),
    )
