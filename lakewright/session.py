"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; all can be changed at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakewright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", extra.pop("memory", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine; on a
    cluster a missing setting is an error, since executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="lakewright-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the scratch root."""
    return f"{scratch_root(spark)}/lakewright/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` once to the shared folder and reading it back.

    Survives the loss of executors, which a cached or locally checkpointed
    frame does not.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
