"""Tables and helpers that the tests share."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

# The three-row source table and its two later rows.
PEOPLE = T.StructType([
    T.StructField("id_col", T.LongType()),
    T.StructField("name_col", T.VarcharType(64)),
    T.StructField("datetime_col", T.TimestampNTZType()),
])
ROWS = [
    (1, "First", datetime(2019, 10, 1, 11)),
    (2, "Second", datetime(2019, 10, 2, 12)),
    (3, "Third", datetime(2019, 10, 3, 13)),
    (4, "Forth", datetime(2019, 10, 4, 12)),
    (5, "Fifth", datetime(2019, 10, 5, 13)),
]


def values(df, *columns) -> list:
    """Sorted rows as tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
