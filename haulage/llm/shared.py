"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. It can only be set when the session is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("make the session with spark.checkpoint.dir set to a folder that all executors share")
    return folder.rstrip("/")


class Scratch:
    """Tables of one piece of work: ``with Scratch(spark) as tables: tables.write(df)``.

    A written table is computed once, and what follows starts from files that outlive any executor. They
    are deleted at the end of the work.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = uuid.uuid4().hex
        self.folder = f"{shared_folder(spark)}/llm/{self.name}"

    def write(self, df: DataFrame, *partitioned: str) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path, partitionBy=list(partitioned) or None)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.delete(self.spark)

    def delete(self, spark: SparkSession) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_owners: list[list[Scratch]] = []


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own, which stays: for results that are read after the work.

    Inside ``with owned() as tables:`` the list gets it, so that it can be deleted once the result is elsewhere.
    """
    tables = Scratch(df.sparkSession)
    if _owners:
        _owners[-1].append(tables)
    return tables.write(df)


@contextmanager
def owned() -> Iterator[list[Scratch]]:
    """Collects the tables that ``written`` makes inside."""
    _owners.append([])
    try:
        yield _owners[-1]
    finally:
        _owners.pop()


def delete_unread(tables: list[Scratch], df: DataFrame) -> None:
    """Deletes those of the tables that ``df`` does not read, and takes them off the list."""
    files = df.inputFiles()
    for table in list(tables):
        if not any(table.name in file for file in files):
            table.delete(df.sparkSession)
            tables.remove(table)


# Rows of one or two numbers that may be broadcast: at most some 50 MB on every executor.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a written table of numbers for broadcast if it has few rows; else joins shuffle."""
    return F.broadcast(df) if df.count() <= rows else df
