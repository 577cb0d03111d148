"""Parquet folders as catalog tables, so that files are loaded like any other table."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..functions.names import qualified, quoted, text_literal


def register_parquet(
    spark: SparkSession, schema: str, folder: str, tables: Iterable[str], location: str | None = None
) -> None:
    """Declare ``<folder>/<table>.parquet`` as external tables of a schema.

    The files are only referred to; column names and types come from their footers.
    """
    at = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(schema)}{at}")
    for table in tables:
        path = text_literal(f"{folder}/{table}.parquet")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qualified(schema, table)} USING parquet LOCATION {path}"
        )


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all in it, wherever Spark's file systems keep it."""
    path, files = _path(spark, folder)
    files.delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path, files = _path(spark, folder)
    return files.exists(path)


def rename_folder(spark: SparkSession, folder: str, new: str) -> bool:
    """Give a folder a name that none has yet; false if that was not possible, such as when it has gone meanwhile."""
    path, files = _path(spark, folder)
    try:
        return files.exists(path) and files.rename(path, _path(spark, new)[0])
    except Py4JJavaError:
        if files.exists(path):
            raise
        return False


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none when it is not there."""
    path, files = _path(spark, folder)
    return sorted(entry.getPath().getName() for entry in files.listStatus(path)) if files.exists(path) else []
