"""Loading only the files a table has not seen, exactly once, into an ordinary table.

A stream of the folder's files hands batches to a load. A batch is first written whole
inside the table's location, in a folder that readers skip; then a list of its files is
put there, and the files are renamed into the table one by one under the names of that
list; then the batch's number enters the ledger. Each step can be repeated:

- without a list, the batch is written again from the files the stream remembers for it;
- with one, the renames that are missing are made up, and no row is written twice;
- a batch in the ledger is passed over.

Other jobs may append to the table meanwhile, before and after. If one replaces the table
while a batch is half-way, the list goes with the old rows, and the batch is written whole
into the new table. Readers see the files of a batch appear one by one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.errors import LakeError
from lakewright.lake import TABLE, Lake
from lakewright.operators import writes
from lakewright.sources import files
from lakewright.sources.store import Store


class Ledger:
    """What a stream has loaded, kept beside its checkpoint; one file per batch."""

    def __init__(self, lake: Lake, checkpoint: str):
        self.store, self.top = Store(lake.spark), f"{checkpoint.rstrip('/')}/loads"

    def stream(self, folder: str, table: str) -> str:
        """The stream's own id; a checkpoint stays with its folder and table."""
        mine = {"folder": folder.rstrip("/"), "table": Lake.canonical(table)}
        text = self.store.read(f"{self.top}/stream.json")
        if text is None:
            held = {"id": uuid.uuid4().hex, **mine}
            self.store.write(f"{self.top}/stream.json", json.dumps(held))
        else:
            held = json.loads(text)
            if {k: held[k] for k in mine} != mine:
                raise LakeError(f"the checkpoint belongs to the load of {held['folder']!r} into {held['table']!r}")
        return held["id"]

    def has(self, batch: int) -> bool:
        return self.store.exists(f"{self.top}/{batch}.json")

    def add(self, batch: int, names: list[str]) -> None:
        self.store.write(f"{self.top}/{batch}.json", json.dumps({"batch": batch, "files": names}))


def _location(lake: Lake, table: str) -> str:
    described = lake.spark.sql(f"DESCRIBE TABLE EXTENDED {lake.sql_name(table)}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location").rstrip("/")


def _load(lake: Lake, ledger: Ledger, stream: str, table: str, rows: DataFrame, batch: int) -> None:
    """Take one batch into the table, from wherever an earlier attempt stopped."""
    if ledger.has(batch):
        return
    store, where = ledger.store, _location(lake, table)
    mine = f"{where}/_loads-{stream}"
    held, listed = f"{mine}/{batch}", f"{mine}/{batch}.json"
    parts = lake.partition_columns(table)
    text = store.read(listed)
    if text is None:
        writer = writes.aligned(lake, rows, table).write.mode("overwrite")
        (writer.partitionBy(*parts) if parts else writer).parquet(held)
        text = json.dumps(store.files(held))
        store.write(listed, text)
    names = json.loads(text)
    for name in names:
        store.move(f"{held}/{name}", f"{where}/{name}")
    if parts:
        lake.spark.sql(f"MSCK REPAIR TABLE {lake.sql_name(table)}")
    ledger.add(batch, names)
    store.drop(mine)
    lake.spark.catalog.refreshTable(lake.sql_name(table))


def incremental_ingest(
    lake: Lake,
    folder: str,
    table: str,
    fmt: str,
    schema: T.StructType,
    checkpoint: str,
    *,
    options: dict[str, str] | None = None,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Append the folder's new files to ``table`` and stop; the table.

    The table may be there already, made by whatever job: columns are matched by
    name, its types win, and columns the files lack are null. Otherwise it is made
    with ``schema``. ``checkpoint`` must be in a folder all executors share, and
    belongs to this folder and table.
    """
    spark = lake.spark
    kind = lake.kind(table)
    if kind not in (None, TABLE):
        raise LakeError(f"{table!r} is a view: rows cannot be added to it")
    empty = spark.createDataFrame([], schema)
    if kind is None:
        writes.create_table(lake, empty, table)
    else:
        writes.aligned(lake, empty, table)  # columns the table lacks stop the load before it begins
    ledger = Ledger(lake, checkpoint)
    stream = ledger.stream(folder, table)
    reader = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files.name_glob(fmt))
        .options(**(options or {}))
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        reader.load(folder)
        .writeStream.foreachBatch(lambda rows, batch: _load(lake, ledger, stream, table, rows, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return lake.table(table)


def loaded_batches(lake: Lake, checkpoint: str) -> DataFrame:
    """The ledger of a stream: number of each batch and how many files it added to the table."""
    ledger = Ledger(lake, checkpoint)
    if not ledger.store.exists(ledger.top):
        return lake.spark.createDataFrame([], "batch long, files long")
    held = lake.spark.read.option("pathGlobFilter", "[0-9]*.json").schema("batch long, files array<string>").json(ledger.top)
    return held.select("batch", F.size("files").cast("long").alias("files"))
