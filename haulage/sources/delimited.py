"""Delimited text staging: one record per line, no header, no quoting.

Line ends, the delimiter, NUL and backslashes inside text are escaped, so a record
never spans lines. Files therefore stay splittable, however large they are, and
NULL, empty strings and separators come back as they went in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, types as T
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..functions.text import NULL_MARK, stage_decode, stage_encode, stage_split

# Fixed value: the delimiter of staged files unless another is chosen.
DELIMITER = "|"


def export_delimited(
    df: DataFrame,
    path: str,
    delimiter: str = DELIMITER,
    max_records_per_file: int = 0,
    compression: str | None = None,
    mode: str = "errorifexists",
) -> int:
    """Write a frame as delimited text and return the number of rows written."""
    fields = [
        stage_encode(F.col(quoted(field.name)), field.dataType, delimiter) for field in df.schema
    ]
    lines = df.select(F.concat_ws(delimiter, *fields).alias("value"))
    written = Observation()
    writer = lines.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return written.get["rows"]


def _parsed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str,
    counts: Observation | None,
    null_mark: str = NULL_MARK,
) -> DataFrame:
    """Every line as ``__staged_line``, whether it is ``__staged_unusable``, and its typed values.

    Splitting, converting and judging a line are steps of their own, and counting the
    lines comes last: a filter on top then cannot be pushed below and redo them all.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("__staged_line"),
        stage_split(F.col("value"), delimiter).alias("__staged_parts"),
    )
    fields = {f.name: F.get("__staged_parts", F.lit(i)) for i, f in enumerate(schema)}
    typed = lines.select("*", *(
        stage_decode(fields[f.name], f.dataType, delimiter, null_mark).alias(f.name) for f in schema
    ))
    unusable = F.size("__staged_parts") != len(schema)
    for f in schema:
        if not isinstance(f.dataType, T.StringType):
            unusable |= (fields[f.name] != null_mark) & F.col(quoted(f.name)).isNull()
    judged = typed.select(
        "__staged_line", unusable.alias("__staged_unusable"), *(quoted(f.name) for f in schema)
    )
    return judged.observe(
        counts or "staged_lines",
        F.count(F.lit(1)).alias("rows"),
        F.count_if("__staged_unusable").alias("rejected"),
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = DELIMITER,
    skip_bad_rows: bool = False,
    counts: Observation | None = None,
    null_mark: str = NULL_MARK,
) -> DataFrame:
    """Staged lines as typed rows. Lines of other tools may have another mark for NULL, such as nothing.

    A line with the wrong number of fields, or with a field that does not fit its type,
    fails the read, or is left out with ``skip_bad_rows``. ``counts`` then receives
    ``rows`` (all lines) and ``rejected`` in the same pass.
    """
    judged = _parsed(spark, path, schema, delimiter, counts, null_mark)
    usable = ~F.col("__staged_unusable")
    if not skip_bad_rows:
        message = F.concat(F.lit("unusable staged line: "), F.col("__staged_line"))
        usable = usable | F.raise_error(message).cast("boolean")
    return judged.where(usable).select(*(quoted(f.name) for f in schema))


def rejected_lines(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = DELIMITER,
    null_mark: str = NULL_MARK,
) -> DataFrame:
    """The staged lines that ``skip_bad_rows`` leaves out, as text."""
    judged = _parsed(spark, path, schema, delimiter, None, null_mark)
    return judged.where("__staged_unusable").select(F.col("__staged_line").alias("line"))
