"""A fresh schema for tables that outlive no session, on storage every executor sees."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from .functions.names import quoted, text_literal


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may do without it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="haulage-")
    spark.conf.set("spark.checkpoint.dir", folder)  # one for the whole session
    return folder


def fresh_schema(spark: SparkSession, prefix: str) -> tuple[str, str]:
    """Create a schema of its own in the shared folder; returns its name and its folder."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(spark)}/haulage/{name}"
    spark.sql(f"CREATE DATABASE {quoted(name)} LOCATION {text_literal(folder)}")
    return name, folder
