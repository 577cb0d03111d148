"""Text renderings: database spool values, normalised rows, and the staging codec."""

from __future__ import annotations

import re

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# The characters Python's str.strip() removes; all of them lie below U+3001.
WHITESPACE = "".join(char for char in map(chr, range(0x3001)) if char.isspace())

# NULL and control characters in a staged text line.
NULL_MARK = "\\N"
ESCAPES = [("\\", "\\x5C"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\x00")]
# Further escapes that other writers of such lines use.
FOREIGN_ESCAPES = [("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"), ("\v", "\\v")]


def strip_nul(value: Column) -> Column:
    """Remove NUL characters, which most databases refuse in text."""
    return F.replace(value, F.lit("\x00"), F.lit(""))


def on_one_line(value: Column) -> Column:
    """Carriage returns and line feeds as spaces."""
    for line_end in "\r\n":
        value = F.replace(value, F.lit(line_end), F.lit(" "))
    return value


def _timestamp_parts(value: Column) -> tuple[Column, Column]:
    """Seconds text and six-digit fraction. A plain cast is used because
    ``date_format`` would move zone-less timestamps through the session zone."""
    text = value.cast("string")
    return F.substring(text, 1, 19), F.rpad(F.substring(text, 21, 6), 6, "0")


def spool_text(value: Column, dtype: T.DataType) -> Column:
    """A value as text with ``.`` decimals and ``YYYY-MM-DD HH24:MI:SS[.FF]`` times."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        seconds, fraction = _timestamp_parts(value)
        return F.concat(seconds, F.lit("."), fraction)
    if isinstance(dtype, T.DateType):
        return F.concat(value.cast("string"), F.lit(" 00:00:00"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float_text(value)
    if isinstance(dtype, T.StringType):
        return strip_nul(value)
    return value.cast("string")


def two_digits(text: Column) -> Column:
    """A number's text with a leading zero when it has one digit."""
    return F.when(F.length(text) < 2, F.concat(F.lit("0"), text)).otherwise(text)


def float_text(value: Column) -> Column:
    """A floating number as Python prints it: plain digits from 1e-4 up to 1e16."""
    text = value.cast("string")
    size = F.abs(value)
    plain = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1)
    sign = F.when(exponent.startswith("-"), "e-").otherwise("e+")
    digits = two_digits(F.replace(exponent, F.lit("-"), F.lit("")))
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, sign, digits))
    )


def _span_text(interval: Column) -> Column:
    """A day-time interval as Python prints it: whole days first, then the rest of a day."""
    second = F.lit(1_000_000).cast("bigint")
    micros = (
        ((F.extract(F.lit("DAY"), interval).cast("bigint") * 24
          + F.extract(F.lit("HOUR"), interval)) * 60
         + F.extract(F.lit("MINUTE"), interval)) * 60 * second
        + (F.extract(F.lit("SECOND"), interval) * second).cast("bigint")
    )
    rest = F.pmod(micros, F.lit(86_400) * second)
    days = F.call_function("div", micros - rest, F.lit(86_400) * second)

    def whole(number: Column, unit: int) -> Column:
        return F.call_function("div", number, F.lit(unit) * second)

    fraction = F.pmod(rest, second)
    return F.concat(
        F.when(days == 0, "").otherwise(
            F.concat(days.cast("string"), F.when(F.abs(days) == 1, " day, ").otherwise(" days, "))
        ),
        whole(rest, 3600).cast("string"),
        F.lit(":"),
        two_digits((whole(rest, 60) % 60).cast("string")),
        F.lit(":"),
        two_digits((whole(rest, 1) % 60).cast("string")),
        F.when(fraction == 0, "").otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
        ),
    )


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """A value as Python's ``str`` prints it, with 1/0 for booleans; NULL stays NULL."""
    if isinstance(dtype, T.BooleanType):
        return value.cast("int").cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float_text(value)
    if isinstance(dtype, T.DayTimeIntervalType):
        return _span_text(value)
    if isinstance(dtype, T.TimeType):
        text = value.cast("string")
        return F.when(F.length(text) > 8, F.rpad(text, 15, "0")).otherwise(text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        seconds, fraction = _timestamp_parts(value)
        return F.when(fraction == "000000", seconds).otherwise(
            F.concat(seconds, F.lit("."), fraction)
        )
    return value.cast("string")


def stage_escapes(delimiter: str) -> list[tuple[str, str]]:
    """Replacements that keep a record on one line and the delimiter unambiguous.

    The backslash comes first: after it, every backslash in the text starts an escape.
    The lines are valid input for Postgres ``COPY`` in text format.
    """
    if len(delimiter) != 1 or not delimiter.isascii() or delimiter.isalnum() or delimiter in "\\\n\r\x00":
        raise ValueError("the delimiter must be one ASCII character other than a letter, digit, "
                         "backslash, line end or NUL")
    return [*ESCAPES, (delimiter, f"\\x{ord(delimiter):02X}")]


def _needs_no_escapes(dtype: T.DataType, delimiter: str) -> bool:
    """Whether no text of the type can hold the delimiter, a backslash, a line end or NUL."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return delimiter not in "+-."
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return delimiter not in "+-.: "
    return False


def stage_encode(value: Column, dtype: T.DataType, delimiter: str) -> Column:
    """A value as one field of a staged line. Text is escaped unless its type rules out all that needs it: numbers
    and times hold characters that may be the delimiter."""
    if isinstance(dtype, T.TimestampType):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    elif isinstance(dtype, T.BinaryType):
        text = F.concat(F.lit("\\x"), F.hex(value))
    else:
        text = value.cast("string")
    escapes = stage_escapes(delimiter)
    for raw, escaped in [] if _needs_no_escapes(dtype, delimiter) else escapes:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.coalesce(text, F.lit(NULL_MARK))


def stage_split(line: Column, delimiter: str) -> Column:
    """Fields of a line. Backslashes and delimiters that another writer put after a backslash are first
    written as this one does, so that every delimiter left parts fields."""
    own = F.replace(line, F.lit("\\\\"), F.lit("\\x5C"))
    own = F.replace(own, F.lit("\\" + delimiter), F.lit(f"\\x{ord(delimiter):02X}"))
    return F.split(F.when(line.contains("\\"), own).otherwise(line), re.escape(delimiter), -1)


def stage_decode(field: Column, dtype: T.DataType, delimiter: str, null_mark: str = NULL_MARK) -> Column:
    """The value of a staged field; text that does not fit the type gives NULL."""
    given = F.nullif(field, F.lit(null_mark))
    if _needs_no_escapes(dtype, delimiter):
        return given.try_cast(dtype)
    decoded = given
    for raw, escaped in [*FOREIGN_ESCAPES, *reversed(stage_escapes(delimiter))]:
        decoded = F.replace(decoded, F.lit(escaped), F.lit(raw))
    text = F.when(given.contains("\\"), decoded).otherwise(given)
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.BinaryType):
        return F.unhex(F.when(text.startswith("\\x"), F.substr(text, F.lit(3))).otherwise(text))
    return text.try_cast(dtype)
