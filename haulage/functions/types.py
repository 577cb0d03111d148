"""Column descriptors and the type maps between Spark and the database dialects.

Spark's own ``DataType`` is the pivot. The canonical names below are what
configuration, descriptors and generated DDL use.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from .names import quoted
from .text import strip_nul, two_digits


class UnsupportedType(ValueError):
    """A column type with no counterpart on the other side."""


class ColumnInfo(NamedTuple):
    """Descriptor of one column; ordinals start at 1, length -1 means unbounded."""

    ordinal: int
    name: str
    type: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None


# Type names that must equal the ones the databases expect.
TARGET_TYPES = {
    "postgres": {
        "str": "varchar",
        "unicode": "varchar",
        "bytes": "bytea",
        "bytearray": "bytea",
        "memoryview": "bytea",
        "buffer": "bytea",
        "bool": "bool",
        "datetime.date": "date",
        "datetime.time": "time",
        "datetime.datetime": "timestamp",
        "int": "int",
        "long": "int",
        "float": "real",
        "decimal.Decimal": "numeric",
        "UUID.uuid": "uuid",
        "timedelta": "interval",
    },
    "sqlserver": {
        "str": "nvarchar",
        "bytes": "binary",
        "bytearray": "binary",
        "memoryview": "binary",
        "buffer": "binary",
        "bool": "bit",
        "datetime.date": "date",
        "datetime.time": "time",
        "datetime.datetime": "datetime2",
        "int": "bigint",
        "long": "bigint",
        "float": "float",
        "decimal.Decimal": "numeric",
        "UUID.uuid": "UNIQUEIDENTIFIER",
        "timedelta": "time",
    },
    "snowflake": {
        "str": "VARCHAR",
        "bytes": "BINARY",
        "bytearray": "BINARY",
        "memoryview": "BINARY",
        "buffer": "BINARY",
        "bytea": "BINARY",
        "bool": "BOOLEAN",
        "datetime.date": "DATE",
        "datetime.time": "TIME",
        "datetime.datetime": "TIMESTAMP_NTZ",
        "int": "BIGINT",
        "long": "BIGINT",
        "float": "REAL",
        "decimal.Decimal": "NUMBER",
        "UUID.uuid": "TEXT",
        "timedelta": "TIME",
    },
    "spark": {
        "str": "VARCHAR",
        "unicode": "VARCHAR",
        "bytes": "BINARY",
        "bytearray": "BINARY",
        "memoryview": "BINARY",
        "buffer": "BINARY",
        "bool": "BOOLEAN",
        "datetime.date": "DATE",
        "datetime.time": "TIME(6)",
        "datetime.datetime": "TIMESTAMP_NTZ",
        "int": "BIGINT",
        "long": "BIGINT",
        "float": "DOUBLE",
        "decimal.Decimal": "DECIMAL",
        "UUID.uuid": "STRING",
        "timedelta": "INTERVAL DAY TO SECOND",
    },
}

# Canonical names of binary data, and the longest string that is loaded.
BINARY_TYPES = ("bytes", "bytearray", "memoryview", "buffer", "bytea")
MAX_STRING_LENGTH = 4000

# The largest string type of a dialect, and the declared lengths that need it.
_UNBOUNDED = {
    "postgres": ("text", lambda n: n == -1),
    "sqlserver": ("nvarchar(MAX)", lambda n: n <= 0 or n > MAX_STRING_LENGTH),
    "snowflake": ("VARCHAR", lambda n: n <= 0),
    "spark": ("STRING", lambda n: n <= 0),
}

# Where Spark keeps the declared type of a char or varchar column.
DECLARED_TYPE = "__CHAR_VARCHAR_TYPE_STRING"


def dialect_types(dialect: str) -> dict[str, str]:
    try:
        return TARGET_TYPES[dialect]
    except KeyError:
        raise UnsupportedType(f"no target type map for dialect {dialect!r}") from None


def target_type(canonical: str, dialect: str) -> str:
    """Type name of a canonical type in a dialect; unknown names pass through unchanged."""
    return dialect_types(dialect).get(canonical, canonical)


def canonical_type(dtype: T.DataType) -> str:
    """Canonical name of a Spark type."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "str"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime.datetime"
    if isinstance(dtype, T.DecimalType):
        return "decimal.Decimal"
    if isinstance(dtype, T.DayTimeIntervalType):
        return "timedelta"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.BinaryType):
        return "bytes"
    if isinstance(dtype, T.DateType):
        return "datetime.date"
    if isinstance(dtype, T.TimeType):
        return "datetime.time"
    return dtype.simpleString()


def declared_type(field: T.StructField) -> T.DataType:
    """The type a column was declared with; Spark reads char and varchar as plain strings."""
    match = re.fullmatch(r"(var)?char\((\d+)\)", field.metadata.get(DECLARED_TYPE, ""))
    if not match:
        return field.dataType
    return (T.VarcharType if match.group(1) else T.CharType)(int(match.group(2)))


def declared_length(field: T.StructField) -> int:
    """Declared length of a string column, -1 when it has none."""
    return getattr(declared_type(field), "length", -1)


def describe(schema: T.StructType) -> list[ColumnInfo]:
    """Descriptors from a schema alone: exact, needs no rows and reads none."""
    columns = []
    for ordinal, field in enumerate(schema, start=1):
        name = canonical_type(field.dataType)
        length = declared_length(field) if name == "str" else None
        precision = scale = None
        if name == "decimal.Decimal":
            precision, scale = field.dataType.precision, field.dataType.scale
        columns.append(ColumnInfo(ordinal, field.name, name, length, precision, scale))
    return columns


def column_ddl(column: ColumnInfo, dialect: str) -> str:
    """Type of one column in generated DDL, with its length or precision."""
    name = target_type(column.type, dialect)
    if column.type in ("str", "unicode"):
        unbounded, applies = _UNBOUNDED[dialect]
        length = -1 if column.length is None else column.length
        return unbounded if applies(length) else f"{name}({length})"
    if column.type == "decimal.Decimal":
        return f"{name}({column.precision},{column.scale})"
    return name


def create_table_ddl(schema: str, table: str, columns: list[ColumnInfo], dialect: str) -> str:
    """``CREATE TABLE`` text for a database: names and types only."""
    create = {"snowflake": "CREATE TRANSIENT TABLE"}.get(dialect, "CREATE TABLE")
    name_format = {"sqlserver": "[{}]", "snowflake": '"{}"', "spark": "`{}`"}.get(dialect, "{}")
    body = ", \n".join(
        f"{name_format.format(column.name)} {column_ddl(column, dialect)}" for column in columns
    )
    return f"{create} {schema}.{table}(\n{body})"


def database_table_ddl(schema: str, table: str, columns: T.StructType, dialect: str) -> str:
    """``CREATE TABLE`` text for rows of a Spark schema, as ``cast_for_target`` makes them.

    64-bit integers and doubles stay whole on Postgres, as there.
    """
    wide = {T.LongType: "bigint", T.DoubleType: "double precision"} if dialect == "postgres" else {}
    infos = [
        info._replace(type=wide.get(type(field.dataType), info.type))
        for info, field in zip(describe(columns), columns)
    ]
    return create_table_ddl(schema, table, infos, dialect)


def spark_schema(columns: list[ColumnInfo]) -> T.StructType:
    """Descriptors as a Spark schema; names that Spark does not know raise ``UnsupportedType``."""
    schema = T.StructType()
    for column in columns:
        ddl = column_ddl(column, "spark")
        try:
            dtype = T.DataType.fromDDL(ddl)
        except Exception as error:
            raise UnsupportedType(f"column {column.name}: {column.type!r}") from error
        schema.add(column.name, dtype)
    return schema


def _clock_text(interval: Column) -> Column:
    """A day-time interval as hours, minutes and seconds: the text time columns accept."""
    hours = F.extract(F.lit("DAY"), interval) * 24 + F.extract(F.lit("HOUR"), interval)
    minutes = F.extract(F.lit("MINUTE"), interval)
    seconds = F.abs(F.extract(F.lit("SECOND"), interval)).cast("string")
    sign = F.when(interval < F.expr("INTERVAL '0' SECOND"), "-").otherwise("")
    return F.concat(
        sign,
        two_digits(F.abs(hours).cast("string")),
        F.lit(":"),
        two_digits(F.abs(minutes).cast("string")),
        F.lit(":"),
        F.lpad(seconds, 9, "0"),
    )


def _narrowed(value: Column) -> Column:
    """A whole number in 32 bits; one that does not fit fails, whatever the session's mode."""
    narrow = value.try_cast("int")
    message = F.concat(F.lit("out of range for type int: "), value.cast("string"))
    return F.when(value.isNull() | narrow.isNotNull(), narrow).otherwise(
        F.raise_error(message).cast("int")
    )


def cast_for_target(df: DataFrame, dialect: str, widen: bool = True) -> DataFrame:
    """Project every column to the representation the target database stores.

    ``widen`` keeps 64-bit integers and doubles whole on Postgres, where the plain
    type map would narrow them to ``int`` and ``real``.
    """
    known = dialect_types(dialect)
    projected = []
    for field in df.schema:
        value = F.col(quoted(field.name))
        name = canonical_type(field.dataType)
        if name not in known:
            raise UnsupportedType(f"column {field.name}: {name} on {dialect}")
        if dialect != "spark":
            if name == "bool" and known[name] == "bit":
                value = value.cast("int")
            elif name == "int" and known[name].lower() == "bigint":
                value = value.cast("bigint")
            elif name == "int" and not widen:
                value = _narrowed(value)
            elif name == "float":
                value = value.cast("float" if known[name] == "real" and not widen else "double")
            elif name == "datetime.datetime":
                value = value.cast("timestamp_ntz")
            elif name == "timedelta":
                value = _clock_text(value)
            elif name == "datetime.time":
                value = value.cast("string")  # Spark writes no time type to a database
        projected.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*projected)


def cast_from_oracle(df: DataFrame) -> DataFrame:
    """Whole numbers that fit 64 bits become integers, and text loses its NUL characters."""
    projected = []
    for field in df.schema:
        value = F.col(quoted(field.name))
        dtype = field.dataType
        if isinstance(dtype, T.DecimalType) and dtype.scale == 0 and dtype.precision <= 18:
            value = value.cast("bigint")
        elif isinstance(dtype, T.StringType):
            value = strip_nul(value)
        projected.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*projected)
