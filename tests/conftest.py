from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from haulage import Endpoint  # noqa: E402
from haulage.operators.publish import create_table, insert  # noqa: E402
from haulage.scratch import fresh_schema  # noqa: E402
from tables import PEOPLE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[*,3]")  # tasks may fail twice
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="haulage-tests-"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake() -> Endpoint:
    return Endpoint()


@pytest.fixture
def schema(spark) -> str:
    return fresh_schema(spark, "test")[0]


@pytest.fixture
def folder(spark) -> str:
    return fresh_schema(spark, "files")[1] + "/stage"


@pytest.fixture
def make(spark, lake, schema):
    """Create a table from rows: ``make("name", rows)``."""

    def build(table: str, rows, columns: T.StructType = PEOPLE):
        create_table(spark, lake, schema, table, columns)
        name = lake.table_name(schema, table)
        if rows:
            insert(spark.createDataFrame(rows, spark.table(name).schema), name)
        return spark.table(name)

    return build
