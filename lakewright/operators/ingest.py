"""Loading folders of files into tables."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.errors import LakeError
from lakewright.functions.sqltypes import spark_type, sql_type
from lakewright.lake import TABLE, VIEW, Lake, quote
from lakewright.operators import schema
from lakewright.operators.writes import append_table, create_table, replace_table
from lakewright.sources import files
from lakewright.sources.typing import NULL_SPELLINGS, CsvOptions, csv_headers, given_sql, literal, parse_as, parse_sql

REPORT_SCHEMA = "table string, action string, rows long, files long"
PLAN_SCHEMA = "name string, ok boolean, detail string"
SLICE_COLUMN = "sub_path"
INTENTS = ("read_only", "editable")
_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
CONFLICT_MODES = ("fail", "append", "replace")
_RAGGED, _RAGGED_ROW = "__ragged", "a row has more or fewer cells than the header: "


@dataclass(frozen=True)
class TableDefinition:
    """What the caller wants the table to be; every part is optional."""

    columns: list[tuple[str, str]] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    sort_by: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Source:
    """A folder's files of one format, with their schemas read once."""

    spark: SparkSession
    folder: str
    fmt: str
    csv: CsvOptions
    listing: DataFrame
    columns: list[tuple[str, str]]
    file_count: int
    # Per file and column; None when all Parquet files agree on every type.
    file_columns: DataFrame | None

    def close(self) -> None:
        if self.file_columns is not None:
            self.file_columns.unpersist()


def _agreed_columns(spark: SparkSession, folder: str) -> list[tuple[str, str]] | None:
    """The columns of Parquet files that all agree, from one distributed read of
    the footers; None when types differ or a type needs the footers' own name."""
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    try:
        merged = reader.option("pathGlobFilter", files.name_glob("parquet")).parquet(folder).schema
    except (AnalysisException, SparkRuntimeException, Py4JJavaError) as exc:
        # Types that differ, or that only the footers name; anything else is an error of its own.
        if not any(word in str(exc).upper() for word in ("MERGE", "MERGING", "PARQUET_TYPE", "ILLEGAL PARQUET")):
            raise LakeError(f"the files below {folder} cannot be read", [str(exc).splitlines()[0]]) from exc
        return None
    # An unsigned 64-bit column arrives as this decimal.
    if any(f.dataType.simpleString() == "decimal(20,0)" for f in merged.fields):
        return None
    nested = [f.name for f in merged.fields if isinstance(f.dataType, _NESTED)]
    if nested:
        raise LakeError("nested columns are not supported", nested)
    return [(f.name, sql_type(f.dataType, f.name)) for f in merged.fields]


def open_source(
    spark: SparkSession, folder: str, fmt: str, csv: CsvOptions | None = None, infer: bool = True
) -> Source:
    """List the folder and read every file's schema; no file is an error.

    Without ``infer`` CSV columns are text: only the headers are read.
    """
    files.check_format(fmt)
    csv = csv or CsvOptions()
    csv.check()
    listing = files.file_inventory(spark, folder, fmt)
    count = listing.count()
    if not count:
        raise LakeError(f"no {fmt} files found under {folder}")
    if fmt == "parquet":
        agreed = _agreed_columns(spark, folder)
        if agreed is not None:
            return Source(spark, folder, fmt, csv, listing, agreed, count, None)
    # One row per file and column; read once, used for schema and grouping.
    if fmt == "csv" and not infer:
        named = csv_headers(listing, csv).select("path", F.posexplode("names").alias("ordinal", "name"))
        file_columns = named.withColumn("type", F.lit("VARCHAR")).persist()
    else:
        file_columns = schema.column_types(spark, folder, fmt, csv)
        if not infer:
            flat = ~F.col("type").rlike("^(STRUCT|LIST|MAP)")
            file_columns = file_columns.withColumn("type", F.when(flat, "VARCHAR").otherwise(F.col("type")))
        file_columns = file_columns.persist()
    columns = schema.schema_list(schema.unified_schema(file_columns))
    return Source(spark, folder, fmt, csv, listing, columns, count, file_columns)


def _signatures(source: Source) -> list[tuple[list[tuple[str, str]], list[str]]]:
    """``(columns, file paths)`` per distinct file schema; empty when one fits all."""
    if source.file_columns is None:
        return []
    per_file = source.file_columns.groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "name", "type"))).alias("signature")
    )
    if per_file.select("signature").distinct().limit(2).count() == 1:
        return []
    grouped = per_file.groupBy("signature").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [([(c["name"], c["type"]) for c in r["signature"]], r["paths"]) for r in grouped.collect()]


def _reader(source: Source):
    return source.spark.read.option("recursiveFileLookup", "true").option(
        "pathGlobFilter", files.name_glob(source.fmt)
    )


def _given_types(source: Source, definition: TableDefinition | None) -> dict[str, str]:
    """The types that a definition gives, by lower-case name, for files that hold text."""
    return {n.lower(): t for n, t in definition.columns} if definition and source.fmt != "parquet" else {}


def _read_raw(source: Source, names: list[str], where: str | list[str], given: dict[str, str]) -> DataFrame:
    """Files of one schema as they are: text columns under their names, of JSON those that have ``given`` types and the times."""
    reader = _reader(source)
    if source.fmt == "parquet":
        reader = reader.option("mergeSchema", str(source.file_columns is None).lower())
        return reader.parquet(*([where] if isinstance(where, str) else where))
    if source.fmt == "csv":
        text = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{_RAGGED} string"])
        raw = reader.options(**source.csv.reader()).option("columnNameOfCorruptRecord", _RAGGED).schema(text).csv(where)
        # A row with more or fewer cells than the header stops the load; the first column carries the check.
        told = F.concat(F.lit(_RAGGED_ROW), files.source_path(), F.lit(": "), F.substring(_RAGGED, 1, 200))
        first = F.when(F.col(_RAGGED).isNotNull(), F.raise_error(told)).otherwise(F.col("c0"))
        return raw.select(*[(F.col(f"c{i}") if i else first).alias(n) for i, n in enumerate(names)])
    # Dates and times arrive as text and are converted by the rule that typed them.
    known = dict(source.columns)
    fields = [
        f"`{n.replace('`', '``')}` "
        + ("string" if known[n] in ("TIMESTAMP", "DATE") or n.lower() in given else spark_type(known[n]))
        for n in names
    ]
    return reader.schema(", ".join(fields)).json(where)


def _given(text: Column, kind: str) -> Column:
    """Text as the type a definition gives; text that is no such value is an error."""
    if spark_type(kind) == "string":
        return text
    cast = text.cast("timestamp").cast("timestamp_ntz") if kind == "TIMESTAMP" else text.cast(spark_type(kind))
    return F.when(~F.trim(text).isin(*NULL_SPELLINGS), cast)


def _typed(source: Source, raw: DataFrame, given: dict[str, str]) -> DataFrame:
    """``raw`` with the unified columns, in order; absent ones are null.

    A column with a ``given`` type is read from the text of its values, not from
    the type the files suggest.
    """
    have = {f.name: f.dataType for f in raw.schema.fields}
    out = []
    for name, kind in source.columns:
        column = F.col(f"`{name.replace('`', '``')}`")
        if name not in have:
            column = F.lit(None).cast(spark_type(kind))
        elif name.lower() in given:
            column = _given(column, given[name.lower()])
        elif source.fmt != "parquet" and have[name].typeName() == "string":
            column = parse_as(column, kind)
        elif sql_type(have[name], name) != kind:
            column = column.cast(spark_type(kind))
        out.append(column.alias(name))
    return raw.select(*out)


def read_source(source: Source, definition: TableDefinition | None = None) -> DataFrame:
    """All files as one frame with the unified schema.

    Files of one schema are read as a folder; only when schemas differ is each
    group of equal files read by its own and aligned.
    """
    groups, given = _signatures(source), _given_types(source, definition)
    if not groups:
        return _typed(source, _read_raw(source, [n for n, _ in source.columns], source.folder, given), given)
    frames = [_typed(source, _read_raw(source, [n for n, _ in columns], where, given), given) for columns, where in groups]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def apply_definition(df: DataFrame, definition: TableDefinition | None) -> DataFrame:
    """The defined columns, found ignoring case and cast; columns the definition
    does not name stay behind them."""
    if definition is None or not definition.columns:
        return df
    by_key = {c.lower(): c for c in df.columns}
    missing = [n for n, _ in definition.columns if n.lower() not in by_key]
    if missing:
        raise LakeError("the definition names columns the files do not have", missing)
    given = {n.lower() for n, _ in definition.columns}
    chosen = [
        F.col(f"`{by_key[n.lower()]}`").cast(spark_type(t)).alias(n) for n, t in definition.columns
    ]
    return df.select(*chosen, *[F.col(f"`{c}`") for c in df.columns if c.lower() not in given])


@contextmanager
def _ragged_rows_named():
    """A load that a ragged row stopped says which file and row."""
    try:
        yield
    except Exception as exc:
        found = re.search(re.escape(_RAGGED_ROW) + r"[^\n]*", str(exc))
        if not found:
            raise
        raise LakeError(found[0]) from exc


def _observed(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    # Rows are counted while they are written, not by a second pass.
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def slice_name(name: str) -> str:
    """A slice's folder name: lower case, everything else than letters and digits
    as single underscores."""
    clean = re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")
    if not clean:
        raise LakeError(f"{name!r} leaves no slice name")
    return clean


def _checks(
    lake: Lake,
    source: Source,
    table: str,
    intent: str,
    conflict_mode: str,
    definition: TableDefinition | None,
    max_bytes: int | None,
) -> list[tuple[str, bool | None, str]]:
    """Every check as ``(name, ok, detail)``; nothing is written."""
    spark, out = source.spark, []
    out.append(("files", True, f"{source.file_count} {source.fmt} file(s)"))
    if max_bytes is None:
        out.append(("file sizes", None, "skipped: no size limit given"))
    else:
        too_big = schema.oversized_files(source.listing, max_bytes).agg(F.count("*")).first()[0]
        biggest = schema.largest_file(source.listing).first()
        detail = f"{too_big} file(s) larger than {max_bytes:,} bytes" if too_big else "within the limit"
        out.append(
            ("file sizes", not too_big, f"{detail} (largest: {biggest['rel_path']}, {biggest['size']:,} bytes)")
        )
    if source.fmt == "csv":
        bad = files.first_non_utf8(spark, source.folder)
        out.append(("encoding", bad is None, "UTF-8" if bad is None else f"{bad!r} is not valid UTF-8"))
    if definition is not None and definition.columns:
        wrong = (
            schema.check_columns(spark, definition.columns, source.columns)
            if source.fmt == "parquet"
            else [
                f"{n}: not in the files"
                for n, _ in definition.columns
                if n.lower() not in {c.lower() for c, _ in source.columns}
            ]
        )
        out.append(("columns", not wrong, "; ".join(wrong) or "the definition fits the files"))
    action = planned_action(lake, table, conflict_mode)
    kind = "read-only table" if intent == "read_only" else "editable table"
    sentence = {
        "create": f"importing as a new {kind} at {table}",
        "append": f"appending to the existing {kind} at {table}",
        "replace": f"replacing the existing {kind} at {table}",
        "fail": f"{table} already exists",
    }[action]
    out.append(("target", action != "fail", sentence))
    return out


def planned_action(lake: Lake, table: str, conflict_mode: str) -> str:
    """create, append, replace or fail."""
    if conflict_mode not in CONFLICT_MODES:
        raise LakeError(f"conflict_mode must be one of {CONFLICT_MODES}, not {conflict_mode!r}")
    return "create" if lake.kind(table) is None else conflict_mode


def ingest_plan(
    lake: Lake,
    folder: str,
    table: str,
    fmt: str,
    *,
    intent: str = "editable",
    conflict_mode: str = "fail",
    definition: TableDefinition | None = None,
    csv: CsvOptions | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """What :func:`ingest` would check and do, one row per check; writes nothing."""
    try:
        source = open_source(lake.spark, folder, fmt, csv)
        rows = _checks(lake, source, table, intent, conflict_mode, definition, max_bytes)
        source.close()
    except LakeError as exc:
        rows = [("files", False, str(exc))]
    return lake.spark.createDataFrame(rows, PLAN_SCHEMA)


def ingest(
    lake: Lake,
    folder: str,
    table: str,
    fmt: str,
    *,
    intent: str = "editable",
    conflict_mode: str = "fail",
    definition: TableDefinition | None = None,
    csv: CsvOptions | None = None,
    infer_schema: bool = True,
    max_bytes: int | None = None,
) -> DataFrame:
    """Load the folder's files into ``table``; a report ``(table, action, rows, files)``.

    ``editable`` writes an owned table; ``read_only`` leaves the files where
    they are and points a view at them. All checks run, and all their findings
    are raised, before anything is written.
    """
    if intent not in INTENTS:
        raise LakeError(f"intent must be one of {INTENTS}, not {intent!r}")
    if fmt != "parquet" and not infer_schema and not (definition and definition.columns):
        raise LakeError(f"{fmt} files need a definition when infer_schema is off")
    source = open_source(lake.spark, folder, fmt, csv, infer_schema)
    checks = _checks(lake, source, table, intent, conflict_mode, definition, max_bytes)
    problems = [f"{name}: {detail}" for name, ok, detail in checks if ok is False]
    if problems:
        raise LakeError(f"nothing ingested into {table!r}", problems)
    action = planned_action(lake, table, conflict_mode)
    lake.ensure_folder(table.rpartition(".")[0])
    df = apply_definition(read_source(source, definition), definition)
    if intent == "read_only":
        rows = _register(lake, source, table, action, definition)
    else:
        counted, seen = _observed(df, "ingest")
        options = {
            "partition_by": definition.partition_by if definition else [],
            "sort_by": definition.sort_by if definition else [],
        }
        writer: Callable = {"create": create_table, "append": append_table, "replace": replace_table}[action]
        with _ragged_rows_named():
            writer(lake, counted, table, **({} if action == "append" else options))
        rows = seen.get["rows"]
    report = [(table, action, rows, source.file_count)]
    source.close()
    return lake.spark.createDataFrame(report, REPORT_SCHEMA)


#: Characters of file names that one external table may list; what a catalog keeps of a table is bounded.
LISTED = 3500


def _listed(paths: list[str]) -> str:
    """Some files as one path with braces."""
    plain = [re.sub(r"([\\{}*?\[\],])", r"\\\1", re.sub("^file:/+", "/", p)) for p in paths]
    top = os.path.commonpath(plain) if len(plain) > 1 else os.path.dirname(plain[0])
    return f"{top}/{{{','.join(p[len(top) + 1 :] for p in plain)}}}"


def _register(lake: Lake, source: Source, table: str, action: str, definition: TableDefinition | None) -> int | None:
    """Point a view at the files in place, through an external table per file schema.

    The view reads text by the rules of a load, so both give the same rows; of
    CSV a row with more or fewer cells than the header fails the query. Rows are
    counted where the files say their number.
    """
    if action == "append":
        raise LakeError("a read_only table grows with the files of its folder, not by append")
    if lake.kind(table) == TABLE:
        raise LakeError(f"{table!r} is an owned table: a view never replaces one")
    # JSON is read by name: one table fits all files.
    groups = [] if source.fmt == "json" else _signatures(source)
    spread = {c: _listed(paths) for c, (_, paths) in enumerate(groups)}
    if any(len(p) > LISTED for p in spread.values()):
        raise LakeError("the files have different schemas, and too many files to list: load them as editable")
    given = _given_types(source, definition)
    folder = table.rpartition(".")[0]
    prefix = f"{table}__files"
    if action == "replace":
        for path, kind in lake.entries(folder):
            if kind == TABLE and re.fullmatch(re.escape(prefix.lower()) + r"\d*", path):
                lake.spark.sql(f"DROP TABLE {lake.sql_name(path)}")
    selects = []
    for i, (columns, _) in enumerate(groups or [(source.columns, None)]):
        external = lake.sql_name(prefix + (str(i) if i else ""))
        raw = _raw_columns(source, columns, given)
        options = {"pathGlobFilter": files.name_glob(source.fmt), "recursiveFileLookup": "true", "path": spread.get(i, source.folder)}
        if source.fmt == "csv":
            options |= {**source.csv.reader(), "columnNameOfCorruptRecord": _RAGGED}
        said = ", ".join(f"{literal(k)} {literal(v)}" for k, v in options.items())
        fields = ", ".join(f"{quote(n)} {t}" for n, t in raw)
        lake.spark.sql(f"CREATE TABLE {external} ({fields}) USING {source.fmt} OPTIONS ({said})")
        selects.append(f"SELECT {_view_columns(source, columns, given, definition)} FROM {external}")
    lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.sql_name(table)} AS {' UNION ALL '.join(selects)}")
    return schema.row_estimate(source.listing).first()["rows"] if source.fmt == "parquet" else None


def _raw_columns(source: Source, columns: list[tuple[str, str]], given: dict[str, str]) -> list[tuple[str, str]]:
    """Names and Spark types of an external table over files with these columns."""
    if source.fmt == "csv":
        return [*((f"c{i}", "string") for i in range(len(columns))), (_RAGGED, "string")]
    if source.fmt == "json":
        return [(n, "string" if t in ("TIMESTAMP", "DATE") or n.lower() in given else spark_type(t)) for n, t in columns]
    return [(n, spark_type(t)) for n, t in columns]


def _view_columns(source: Source, columns: list[tuple[str, str]], given: dict[str, str], definition: TableDefinition | None) -> str:
    """The unified columns as SQL over one external table, defined ones first."""
    raw = dict(zip([n for n, _ in columns], _raw_columns(source, columns, given), strict=False))
    out = {}
    for name, kind in source.columns:
        if name not in raw:
            value = f"CAST(NULL AS {spark_type(kind)})"
        else:
            stored, held = raw[name]
            value = quote(stored)
            if name.lower() in given:
                value = given_sql(value, spark_type(given[name.lower()]))
            elif source.fmt != "parquet" and held == "string":
                value = parse_sql(value, kind)
            elif held != spark_type(kind):
                value = f"CAST({value} AS {spark_type(kind)})"
            if source.fmt == "csv" and stored == "c0":
                told = f"concat({literal(_RAGGED_ROW)}, substring({_RAGGED}, 1, 200))"
                value = f"CASE WHEN {_RAGGED} IS NOT NULL THEN raise_error({told}) ELSE {value} END"
        out[name] = value
    defined = {n.lower(): (n, t) for n, t in definition.columns} if definition else {}
    by_key = {n.lower(): n for n in out}
    missing = [n for k, (n, _) in defined.items() if k not in by_key]
    if missing:
        raise LakeError("the definition names columns the files do not have", missing)
    first = [f"CAST({out[by_key[k]]} AS {spark_type(t)}) AS {quote(n)}" for k, (n, t) in defined.items()]
    return ", ".join([*first, *(f"{v} AS {quote(n)}" for n, v in out.items() if n.lower() not in defined)])


def ingest_slice(
    lake: Lake,
    folder: str,
    table: str,
    fmt: str,
    sub_path: str,
    *,
    conflict_mode: str = "fail",
    csv: CsvOptions | None = None,
) -> DataFrame:
    """Load one named slice of an accumulating table.

    ``fail`` refuses a slice that is there; ``replace`` writes that slice's
    partition again and leaves all others standing.
    """
    name = slice_name(sub_path)
    if conflict_mode not in ("fail", "replace"):
        raise LakeError(f"a slice is replaced or refused, not {conflict_mode!r}")
    source = open_source(lake.spark, folder, fmt, csv)
    if SLICE_COLUMN in {c.lower() for c, _ in source.columns}:
        raise LakeError(f"the files already have a column {SLICE_COLUMN!r}")
    problems = [f"{name}: {detail}" for name, ok, detail in _checks(lake, source, table, "editable", "append", None, None) if ok is False]
    if problems:
        raise LakeError(f"nothing ingested into {table!r}", problems)
    df, seen = _observed(read_source(source).withColumn(SLICE_COLUMN, F.lit(name)), "slice")
    kind = lake.kind(table)
    if kind == VIEW:
        raise LakeError(f"{table!r} is a view")
    if kind is None:
        action = "create"
        lake.ensure_folder(table.rpartition(".")[0])
        # A single partition value needs no shuffle by partition.
        with _ragged_rows_named():
            df.write.format("parquet").partitionBy(SLICE_COLUMN).saveAsTable(lake.sql_name(table))
    else:
        target = lake.table(table)
        taken = not target.filter(F.col(SLICE_COLUMN) == name).limit(1).isEmpty()
        if taken and conflict_mode == "fail":
            raise LakeError(f"slice {name!r} of {table!r} already exists")
        action = "replace" if taken else "append"
        wrong = [c for c, _ in source.columns if c.lower() not in {t.lower() for t in target.columns}]
        if wrong:
            raise LakeError("the slice has columns the table does not", wrong)
        aligned = df.select(
            *[
                (F.col(f"`{c.name}`") if c.name.lower() in {d.lower() for d in df.columns} else F.lit(None))
                .cast(c.dataType).alias(c.name)
                for c in target.schema.fields
            ]
        )
        # A static partition value: only that slice is overwritten.
        with _ragged_rows_named():
            lake.spark.sql(
                f"INSERT OVERWRITE TABLE {lake.sql_name(table)} PARTITION ({SLICE_COLUMN} = '{name}') "
                "SELECT * FROM {aligned}",
                aligned=aligned.drop(SLICE_COLUMN),
            )
    report = [(table, action, seen.get["rows"], source.file_count)]
    source.close()
    return lake.spark.createDataFrame(report, REPORT_SCHEMA)


def ingest_batch(lake: Lake, jobs: list[dict]) -> DataFrame:
    """Run ingest jobs in order and stop at the first failure.

    The report has a row per job: what landed, the one that failed with its
    reason, and those not started.
    """
    rows, failed = [], False
    for job in jobs:
        if failed:
            rows.append((job["table"], "not started", None, None, None))
            continue
        try:
            done = ingest(lake, **job).first()
            rows.append((done["table"], done["action"], done["rows"], done["files"], None))
        except Exception as exc:  # noqa: BLE001 - the report carries the reason
            failed = True
            rows.append((job["table"], "failed", None, None, str(exc)))
    return lake.spark.createDataFrame(rows, REPORT_SCHEMA + ", note string")


def unloaded_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files not yet in the ledger ``(rel_path)``: each file is loaded once."""
    return listing.join(ledger.select("rel_path"), "rel_path", "left_anti")
