"""Rows as plain lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..functions.text import WHITESPACE, on_one_line, plain_text
from ..sources.delimited import DELIMITER


def normalise_text_rows(df: DataFrame, delimiter: str = DELIMITER) -> DataFrame:
    """Every row as one line: NULL is empty, booleans are 1 and 0, values are trimmed, and
    line ends become spaces. Nothing is quoted, so the line cannot always be read back."""
    values = [
        F.coalesce(F.btrim(plain_text(F.col(quoted(f.name)), f.dataType), F.lit(WHITESPACE)), F.lit(""))
        for f in df.schema
    ]
    return df.select(on_one_line(F.concat_ws(delimiter, *values)).alias("line"))
