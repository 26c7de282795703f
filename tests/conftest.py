from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from lakewright.lake import Lake  # noqa: E402
from lakewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs: compiling a query, by Spark or by the JVM's second compiler,
    # costs more than running it.
    session = local_session(
        shuffle_partitions=2,
        **{
            "spark.sql.codegen.wholeStage": "false",
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:+UseSerialGC",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, prefix=f"t{uuid.uuid4().hex[:8]}__", location=str(tmp_path / "lake"))


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema as a frame."""

    def make(rows, schema):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return make
