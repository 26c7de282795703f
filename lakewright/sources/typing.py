"""Column names and SQL types of CSV and JSON files, found by reading all of them.

Every column is read as text (CSV) or as a variant (JSON), and each candidate
type is tested by an aggregate per file and column, so no file is read by one
task and nothing is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.errors import LakeError
from lakewright.sources import files

# Spellings that stand for "no value" when a CSV column is typed.
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

_DATE = r"^\d{4}-\d{2}-\d{2}$"
_STAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"
_WHOLE = r"^[+-]?\d+$"
_REAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"
_TRUTH = r"^(?i:true|false|0|1)$"


@dataclass(frozen=True)
class CsvOptions:
    """How CSV files are written; ``encoding`` may only be a spelling of UTF-8."""

    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    encoding: str | None = None

    def check(self) -> None:
        if self.encoding and not files.is_utf8_name(self.encoding):
            raise LakeError(f"encoding {self.encoding!r} is not supported: save the files as UTF-8")

    def reader(self) -> dict[str, str]:
        return {
            "sep": self.delimiter,
            "quote": self.quote,
            "escape": self.quote,
            "header": str(self.header).lower(),
        }


def parse_as(value: Column, sql_type: str) -> Column:
    """Text as a value of ``sql_type``, null where it is none."""
    text = F.trim(value)
    absent = text.isin(*NULL_SPELLINGS)

    def guarded(pattern: str, spark_type: str) -> Column:
        return F.when(~absent & text.rlike(pattern), text.try_cast(spark_type))

    return {
        "BIGINT": lambda: guarded(_WHOLE, "bigint"),
        "BOOLEAN": lambda: guarded(_TRUTH, "boolean"),
        "DATE": lambda: guarded(_DATE, "date"),
        "TIMESTAMP": lambda: guarded(_STAMP + "|" + _DATE, "timestamp").cast("timestamp_ntz"),
        "DOUBLE": lambda: guarded(_REAL, "double"),
        "INT": lambda: guarded(_WHOLE, "int"),
        "FLOAT": lambda: guarded(_REAL, "float"),
    }.get(sql_type, lambda: value)()


def parse_sql(text: str, sql_type: str) -> str:
    """:func:`parse_as` of a column as SQL, for the text of a view."""
    patterns = {
        "BIGINT": (_WHOLE, "bigint"), "INT": (_WHOLE, "int"), "BOOLEAN": (_TRUTH, "boolean"), "DATE": (_DATE, "date"),
        "TIMESTAMP": (_STAMP + "|" + _DATE, "timestamp"), "DOUBLE": (_REAL, "double"), "FLOAT": (_REAL, "float"),
    }
    if sql_type not in patterns:
        return text
    pattern, kind = patterns[sql_type]
    found = f"CASE WHEN NOT trim({text}) IN ({_spellings()}) AND trim({text}) RLIKE {literal(pattern)} THEN try_cast(trim({text}) AS {kind}) END"
    return f"CAST({found} AS timestamp_ntz)" if kind == "timestamp" else found


def given_sql(text: str, spark_type: str) -> str:
    """Text as a given type in SQL: a null spelling is null, other text that is no such value an error."""
    if spark_type == "string":
        return text
    cast = f"CAST(CAST({text} AS timestamp) AS timestamp_ntz)" if spark_type == "timestamp_ntz" else f"CAST({text} AS {spark_type})"
    return f"CASE WHEN NOT trim({text}) IN ({_spellings()}) THEN {cast} END"


def literal(text: str) -> str:
    """A string in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spellings() -> str:
    return ", ".join(literal(s) for s in NULL_SPELLINGS)


# The order in which types are tried; VARCHAR is what remains.
CANDIDATES = ("BIGINT", "BOOLEAN", "DATE", "TIMESTAMP", "DOUBLE")


def csv_headers(listing: DataFrame, options: CsvOptions) -> DataFrame:
    """``(path, names)``: each file's column names (``f0, f1, …`` without a header)."""
    # Read once: the width and the names both come from it.
    line = files.first_lines(listing).persist()
    read = options.reader()
    # Whatever the number of names, one header is one row: split it with the
    # CSV rules by reading every name up to a width no line can exceed.
    width = F.size(F.split(F.col("line"), r"\Q" + options.delimiter + r"\E"))
    widest = line.agg(F.max(width)).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(widest))
    parsed = F.from_csv(F.col("line"), schema, {k: v for k, v in read.items() if k != "header"})
    cells = F.array(*[F.col(f"row.c{i}") for i in range(widest)])
    named = line.select("path", "line", parsed.alias("row")).select(
        "path", F.filter(cells, lambda c: c.isNotNull()).alias("names")
    )
    if options.header:
        return named
    return named.select(
        "path",
        F.transform(F.col("names"), lambda _, i: F.concat(F.lit("f"), i.cast("string"))).alias("names"),
    )


def csv_column_types(
    spark: SparkSession, root: str, options: CsvOptions, listing: DataFrame | None = None
) -> DataFrame:
    """``(path, ordinal, name, type)`` for every CSV file below ``root``."""
    options.check()
    listing = files.file_inventory(spark, root, "csv") if listing is None else listing
    headers = csv_headers(listing, options)
    widest = headers.agg(F.max(F.size("names"))).first()[0]
    if not widest:
        raise LakeError(f"no csv files found under {root}")
    columns = [f"c{i}" for i in range(widest)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files.name_glob("csv"))
        .options(**options.reader())
        .schema(schema)
        .csv(root)
        .select(files.source_path().alias("path"), *columns)
    )
    aggregates = []
    for c in columns:
        value = F.col(c)
        present = value.isNotNull() & ~F.trim(value).isin(*NULL_SPELLINGS)
        aggregates.append(F.max(present).alias(f"{c}_seen"))
        for kind in CANDIDATES:
            fits = ~present | parse_as(value, kind).isNotNull()
            aggregates.append(F.min(fits).alias(f"{c}_{kind}"))
    flags = rows.groupBy("path").agg(*aggregates)
    verdicts = []
    for i, c in enumerate(columns):
        kind = F.when(~F.col(f"{c}_seen"), F.lit("VARCHAR"))
        for name in CANDIDATES:
            kind = kind.when(F.col(f"{c}_{name}"), F.lit(name))
        verdicts.append(F.struct(F.lit(i).alias("ordinal"), kind.otherwise(F.lit("VARCHAR")).alias("type")))
    typed = flags.select("path", F.inline(F.array(*verdicts)))
    named = headers.select("path", F.posexplode("names").alias("ordinal", "name"))
    # A file of a header only has no rows, hence no verdict: VARCHAR.
    return named.join(typed, ["path", "ordinal"], "left").select(
        "path", "ordinal", "name", F.coalesce("type", F.lit("VARCHAR")).alias("type")
    )


def json_column_types(spark: SparkSession, root: str) -> DataFrame:
    """``(path, ordinal, name, type)`` for every file of JSON lines below ``root``.

    A key's ordinal is its first place in any record of the file. Objects and
    arrays are reported as unsupported; a line that is no object gives a column
    without a name, which :func:`lakewright.operators.schema.schema_list` refuses.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files.name_glob("json"))
        .text(root)
        .filter(F.trim("value") != "")
        .select(
            files.source_path().alias("path"),
            F.try_parse_json("value").alias("record"),
            # A variant keeps its keys sorted; the text has them as written.
            F.json_object_keys("value").alias("keys"),
        )
    )
    fields = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("record").outer())).select(
        "path",
        (F.array_position("keys", F.col("key")) - 1).cast("int").alias("pos"),
        F.col("key").alias("name"),
        F.schema_of_variant("value").alias("kind"),
        F.when(F.schema_of_variant("value") == "STRING", F.variant_get("value", "$", "string")).alias("text"),
    )
    is_text = F.col("kind") == "STRING"
    stamp = F.col("text").isNotNull() & parse_as(F.col("text"), "TIMESTAMP").isNotNull()
    number = F.col("kind").isin("DOUBLE", "FLOAT") | F.col("kind").startswith("DECIMAL")
    single = (
        F.when(F.col("kind") == "VOID", F.lit(None).cast("string"))
        .when(is_text & stamp, F.lit("TIMESTAMP"))
        .when(is_text, F.lit("VARCHAR"))
        .when(F.col("kind") == "BIGINT", F.lit("BIGINT"))
        .when(F.col("kind") == "BOOLEAN", F.lit("BOOLEAN"))
        .when(number, F.lit("DOUBLE"))
        .otherwise(F.lit(files.UNSUPPORTED))
    )
    per_file = fields.withColumn("single", single).groupBy("path", "name").agg(
        F.min("pos").alias("ordinal"), F.collect_set("single").alias("kinds")
    )
    kinds = F.col("kinds")
    mixed = (
        F.when(F.size(kinds) == 0, F.lit("VARCHAR"))
        .when(F.size(kinds) == 1, F.get(kinds, F.lit(0)))
        .when(F.array_contains(kinds, files.UNSUPPORTED), F.lit(files.UNSUPPORTED))
        .when(F.forall(kinds, lambda k: k.isin("BIGINT", "DOUBLE")), F.lit("DOUBLE"))
        .otherwise(F.lit("VARCHAR"))
    )
    return per_file.select("path", "ordinal", "name", mixed.alias("type"))
