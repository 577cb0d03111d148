"""Creating, filling, publishing and emptying tables.

Names are qualified, quoted table names as ``Endpoint.table_name`` gives them. The
statements are plain Spark SQL, so they act on a Spark catalog or on a database alike.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession, types as T
from pyspark.sql import functions as F

from ..functions.names import quoted, text_literal
from ..functions.types import ColumnInfo, declared_type, spark_schema
from ..functions.text import NULL_MARK
from ..sources.delimited import DELIMITER, read_delimited, rejected_lines
from ..sources.endpoint import Endpoint
from ..sources.files import delete_folder

# Name endings of a table being loaded and of one being retired.
STAGING = "_tmp"
RETIRED = "_delete"
# Table property of a staging table in a folder of its own: whether the folder may still be dropped with it.
GENERATION = "haulage.generation"
UNPUBLISHED, PUBLISHING = "unpublished", "publishing"
# Formats whose tables are a folder of files and nothing else.
FILE_FORMATS = {"parquet", "orc", "csv", "json", "text", "avro"}
# Name ending of the table that keeps the lines an import left out.
REJECTED = "_rejected"


def create_table(
    spark: SparkSession, target: Endpoint, schema: str, table: str, columns: T.StructType
) -> None:
    """Create an empty table, replacing one of the same name."""
    target.require_writable()
    target.use(spark)
    name = target.table_name(schema, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.schema_name(schema)}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if target.is_jdbc:
        target.create_table(spark, schema, table, columns)
    else:
        spark.sql(f"CREATE TABLE {name} ({_ddl(columns)}) USING {target.table_format}")


def create_staging(
    spark: SparkSession, target: Endpoint, schema: str, staging: str, columns: T.StructType
) -> None:
    """Create an empty staging table, to be published by ``swap_table`` or dropped by ``drop_staging``.

    In Spark's own catalog it gets a new folder beside the schema's tables, which the published table takes over: no file
    is moved. Databases and table formats have their own ways to rename.
    """
    if not target.in_session_catalog or target.table_format not in FILE_FORMATS:
        create_table(spark, target, schema, staging, columns)
        return
    target.require_writable()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.schema_name(schema)}")
    drop_staging(spark, target, schema, staging)
    base = spark.catalog.getDatabase(target.schema_name(schema)).locationUri.rstrip("/")
    folder = f"{base}/{staging.removesuffix(STAGING)}-{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {target.table_name(schema, staging)} ({_ddl(columns)}) USING {target.table_format}"
              f" LOCATION {text_literal(folder)} TBLPROPERTIES ('{GENERATION}' = '{UNPUBLISHED}')")


def drop_staging(spark: SparkSession, target: Endpoint, schema: str, staging: str) -> None:
    """Drop a staging table, if it is there, with its files, unless they are being published."""
    name, folder = target.table_name(schema, staging), None
    if target.in_session_catalog and spark.catalog.tableExists(name):
        if _properties(spark, name).get(GENERATION) == UNPUBLISHED:
            folder = _facts(spark, name)["Location"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if folder is not None:
        delete_folder(spark, folder)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    """Type, provider, location and the like of a table."""
    return {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def create_table_from_columns(
    spark: SparkSession, target: Endpoint, schema: str, table: str, columns: list[ColumnInfo]
) -> None:
    """The same from column descriptors."""
    create_table(spark, target, schema, table, spark_schema(columns))


def _ddl(columns: T.StructType) -> str:
    """Names and types only: keys, defaults and nullability are not carried over."""
    return T.StructType([T.StructField(f.name, declared_type(f)) for f in columns]).toDDL()


@dataclass(frozen=True)
class Written:
    """What a write reported: its rows, and the largest key as text when asked for."""

    rows: int
    largest: str | None = None


def insert(df: DataFrame, name: str, largest: Column | None = None) -> Written:
    """Append a frame to a table by position, counting rows in the same pass."""
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if largest is not None:
        measures.append(largest.alias("largest"))
    df.observe(seen, *measures).write.insertInto(name)
    return Written(seen.get["rows"], seen.get.get("largest"))


def aligned(df: DataFrame, columns: list[str]) -> DataFrame:
    """The frame in the target's column order; the names must agree, but for their case."""
    if sorted(name.lower() for name in df.columns) != sorted(name.lower() for name in columns):
        raise ValueError(f"columns differ: {df.columns} and {columns}")
    return df.select(*(quoted(name) for name in columns))


def append_and_drop(
    spark: SparkSession, target: Endpoint, schema: str, table: str, staging: str
) -> int:
    """Append a staging table to the target and drop it; returns the rows appended."""
    target.require_writable()
    columns = target.read_table(spark, schema, table).columns
    staged = aligned(target.read_table(spark, schema, staging), columns)
    rows = insert(staged, target.table_name(schema, table)).rows
    drop_staging(spark, target, schema, staging)
    return rows


def swap_table(
    spark: SparkSession, target: Endpoint, schema: str, table: str, staging: str
) -> None:
    """Publish a staging table under the target's name and drop what was there.

    A staging table with a folder of its own is published by pointing the target there, in one change of the
    catalog; no file moves. Others are renamed, and a failing second rename puts the old table back. Either way, a
    swap that was cut short is completed by the next one.
    """
    target.require_writable()
    target.use(spark)
    if target.in_session_catalog and GENERATION in _properties(spark, target.table_name(schema, staging)):
        _switch(spark, target, schema, table, staging)
        return
    name, new = target.table_name(schema, table), target.table_name(schema, staging)
    old = target.table_name(schema, table + RETIRED)
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {new} RENAME TO {target.new_name(schema, table)}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {target.new_name(schema, table + RETIRED)}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {target.new_name(schema, table)}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {target.new_name(schema, table)}")
        raise
    spark.sql(f"DROP TABLE {old}")


def _switch(spark: SparkSession, target: Endpoint, schema: str, table: str, staging: str) -> None:
    """Point the target at the folder of a staging table.

    The mark on the staging table comes first: whenever the driver is lost, files that the target may read are
    not dropped with it. A target with other columns, or of another layout, is made anew.
    """
    name, new = target.table_name(schema, table), target.table_name(schema, staging)
    staged = _facts(spark, new)
    folder, outdated = staged["Location"], None
    spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('{GENERATION}' = '{PUBLISHING}')")
    if spark.catalog.tableExists(name) and not _same_layout(spark, name, new):
        spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({_ddl(spark.table(new).schema)}) USING {staged['Provider']}")
    there = _facts(spark, name)
    if there["Location"] != folder:
        outdated = there["Location"] if there["Type"] == "MANAGED" else None
        spark.sql(f"ALTER TABLE {name} SET LOCATION {text_literal(folder)}")
    stale = [text_literal(key) for key in _properties(spark, name) if key.startswith("haulage.")]
    if stale:
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ({', '.join(stale)})")
    spark.sql(f"DROP TABLE {new}")
    spark.sql(f"DROP TABLE IF EXISTS {target.table_name(schema, table + RETIRED)}")
    if outdated is not None:
        delete_folder(spark, outdated)


def _same_layout(spark: SparkSession, name: str, new: str) -> bool:
    """Whether one table's files can be read as the other's: format and columns, no partitions or buckets."""
    a, b = _facts(spark, name), _facts(spark, new)
    plain = "# Partition Information" not in a and "Num Buckets" not in a
    return plain and a.get("Provider") == b.get("Provider") and (
        _ddl(spark.table(name).schema) == _ddl(spark.table(new).schema))


def truncate_table(spark: SparkSession, target: Endpoint, schema: str, table: str) -> None:
    """Empty a table and keep its columns."""
    target.require_writable()
    target.use(spark)
    name = target.table_name(schema, table)
    if target.is_jdbc:
        # Spark's JDBC tables are emptied by an overwrite only
        spark.sql(f"INSERT OVERWRITE {name} SELECT * FROM {name} WHERE false")
    else:
        spark.sql(f"TRUNCATE TABLE {name}")


@dataclass(frozen=True)
class Imported:
    """Rows a delimited import stored, and the lines it had to leave out."""

    rows: int
    rejected: int


def import_delimited(
    spark: SparkSession,
    path: str,
    target: Endpoint,
    schema: str,
    table: str,
    delimiter: str = DELIMITER,
    skip_bad_rows: bool = False,
    null_mark: str = NULL_MARK,
) -> Imported:
    """Load every staged file under a path into an existing table, in one job.

    Lines that ``skip_bad_rows`` leaves out are kept in a table beside it; only if there are any are
    the files read a second time.
    """
    target.require_writable()
    columns = target.read_table(spark, schema, table).schema
    counts = Observation()
    rows = read_delimited(spark, path, columns, delimiter, skip_bad_rows, counts, null_mark)
    rows.write.insertInto(target.table_name(schema, table))
    rejected = counts.get["rejected"]
    if skip_bad_rows and rejected:
        lines = rejected_lines(spark, path, columns, delimiter, null_mark)
        create_table(spark, target, schema, table + REJECTED, lines.schema)
        insert(lines, target.table_name(schema, table + REJECTED))
    return Imported(counts.get["rows"] - rejected, rejected)


@dataclass(frozen=True)
class Markers:
    """What a target remembers of its increments, as table properties.

    ``largest`` is the largest key of the last complete append: a hint of where to look
    for the maximum. ``pending`` is the maximum an append started from, as long as that
    append has not been confirmed.
    """

    largest: str | None = None
    pending: str | None = None


def get_markers(spark: SparkSession, target: Endpoint, schema: str, table: str, key: str) -> Markers:
    """The markers of a key; databases keep none."""
    if target.is_jdbc:
        return Markers()
    name = target.table_name(schema, table)
    found = _properties(spark, name)
    return Markers(*(found.get(f"haulage.{f.name}.{key}") or None for f in fields(Markers)))


def set_markers(
    spark: SparkSession, target: Endpoint, schema: str, table: str, key: str, markers: Markers
) -> None:
    """Replace the markers of a key; absent ones are stored as empty text."""
    if target.is_jdbc:
        return
    properties = ", ".join(
        f"{text_literal(f'haulage.{f.name}.{key}')} = {text_literal(getattr(markers, f.name) or '')}"
        for f in fields(Markers)
    )
    spark.sql(f"ALTER TABLE {target.table_name(schema, table)} SET TBLPROPERTIES ({properties})")
