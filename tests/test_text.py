from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from haulage.functions.text import WHITESPACE, float_text, spool_text, stage_escapes, strip_nul
from haulage.operators.rows import normalise_text_rows

FLOATS = [
    0.0, -0.0, 1.0, 6.55, 100.0, 12345678.9, 1e15, 123456789012345.6, 1e16, 1.5e16, 1e22, 1e100,
    1e-3, 1.5e-4, 1e-4, 1e-5, 1.5e-5, 1e-300, -2.5e-7, -98765432.125, 3.141592653589793,
    float("inf"), float("-inf"), float("nan"),
]


def test_floats_are_printed_as_python_prints_them(spark):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(FLOATS)], "i int, f double")
    found = dict(df.select("i", float_text(F.col("f"))).collect())
    assert [found[i] for i in range(len(FLOATS))] == [str(f) for f in FLOATS]


def python_line(row) -> str:
    """The rule in plain Python, as a check."""
    texts = []
    for value in row:
        if value is None:
            value = ""
        if isinstance(value, bool):
            value = int(value)
        texts.append(str(value).strip())
    return "|".join(texts).replace("\n", " ").replace("\r", " ")


def test_rows_as_lines(spark):
    schema = T.StructType([
        T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType()),
        T.StructField("f", T.DoubleType()), T.StructField("d", T.DecimalType(10, 3)),
        T.StructField("day", T.DateType()), T.StructField("at", T.TimestampNTZType()),
    ])
    rows = [
        (WHITESPACE + "a\r\nb | c" + WHITESPACE, True, 1e7, Decimal("1.500"), date(2020, 1, 2),
         datetime(2020, 1, 2, 3, 4, 5)),
        (None, None, None, None, None, None),
        ("\u200bx\u200b", False, 1e-5, Decimal("0.000"), date(1969, 12, 31),
         datetime(1969, 12, 31, 23, 59, 59, 120)),
        ("", True, -1.25, Decimal("-7.125"), date(9999, 12, 31), datetime(2024, 3, 10, 2, 30, 0, 500000)),
    ]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        found = [r.line for r in normalise_text_rows(spark.createDataFrame(rows, schema).coalesce(1)).collect()]
        assert found == [python_line(row) for row in rows]
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_spans_and_clock_times_are_printed_as_python_prints_them(spark):
    spans = [timedelta(), timedelta(days=1), timedelta(days=-1), timedelta(seconds=-1),
             timedelta(days=40, hours=2, minutes=3, seconds=4, microseconds=50),
             timedelta(microseconds=-1), timedelta(days=2, hours=23, minutes=59, seconds=59.999999)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(spans)], "i int, s interval day to second")
    assert [r.line for r in normalise_text_rows(df.coalesce(1)).collect()] == [
        f"{i}|{s}" for i, s in enumerate(spans)]
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        times = spark.sql("SELECT time'01:02:03.5' AS a, time'01:02:03' AS b")
        assert normalise_text_rows(times).first().line == "01:02:03.500000|01:02:03"
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_nul_bytes_go_and_nothing_else(spark):
    df = spark.createDataFrame([("\x00a\x00\x00b \x01\x00",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_nul(F.col("s"))).collect()] == ["ab \x01", None]


def test_spool_formats(spark):
    df = spark.sql("""SELECT timestamp_ntz '2024-03-10 02:30:00.5' AS at, date '2020-02-29' AS day,
                      0.5D AS f, cast(1.50 AS decimal(5,2)) AS d, 7L AS n, concat('a', char(0)) AS s""")
    row = df.select(*(spool_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema)).first()
    assert tuple(row) == ("2024-03-10 02:30:00.500000", "2020-02-29 00:00:00", "0.5", "1.50", "7", "a")


@pytest.mark.parametrize("delimiter", ["", "||", "\\", "\n", "a", "7", "é"])
def test_delimiters_that_would_be_ambiguous_are_refused(delimiter):
    with pytest.raises(ValueError):
        stage_escapes(delimiter)
