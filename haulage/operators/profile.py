"""Key and column profiles. Each is one aggregation with map-side partial results."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..functions.types import describe
from .extract import HighWater, KeyRanges, RowRanges, marker_text


# Accuracy of quantiles at most: what a task keeps of a key grows with it.
FINEST = 1_000_000
# The largest width a range can have.
WIDEST = 2**63 - 1


def _key_type(df: DataFrame, key: str) -> T.DataType:
    """Type of a key column; fails when there is none of that name."""
    return df.select(quoted(key)).schema[0].dataType


def key_max(df: DataFrame, key: str) -> DataFrame:
    """Largest key as text; NULL for an empty table."""
    return df.agg(F.max(quoted(key)).cast("string").alias("max_value"))


def key_min_max(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key."""
    return df.agg(F.min(quoted(key)).alias("min_value"), F.max(quoted(key)).alias("max_value"))


def key_min_max_batch(df: DataFrame, key: str, batch_rows: int) -> DataFrame:
    """Smallest and largest key, and the key width that holds about ``batch_rows`` rows:
    ``ceil((max - min) / (rows / batch_rows))``, and never less than 1."""
    dtype = _key_type(df, key)
    bounds = df.agg(
        F.min(quoted(key)).alias("min_value"),
        F.max(quoted(key)).alias("max_value"),
        F.count(F.lit(1)).alias("rows"),
    )
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # whole numbers stay whole: the ceiling of an exact quotient
        spread = "(cast(max_value as decimal(20,0)) - cast(min_value as decimal(20,0)))"
        dividend = f"({spread} * {batch_rows} + rows - 1)"
        width = F.expr(f"CASE WHEN {dividend} < rows * {WIDEST}BD THEN {dividend} div rows"
                       f" ELSE {WIDEST} END")
    elif isinstance(dtype, (T.DecimalType, T.FloatType, T.DoubleType)):
        spread = "(cast(max_value as double) - cast(min_value as double))"
        width = F.expr(f"cast(least(ceil({spread} / (rows / {float(batch_rows)}D)), {WIDEST})"
                       " as bigint)")
    else:
        raise TypeError(f"key {key!r} is not numeric: {dtype.simpleString()}")
    size = F.when(F.col("min_value").isNotNull(), F.greatest(width, F.lit(1)).cast("bigint"))
    return bounds.select("min_value", "max_value", size.alias("batch_size"))


def key_ranges(df: DataFrame, key: str, batch_rows: int) -> KeyRanges:
    """The ranges of equal width that split a table on a numeric key. NaN keys are no bounds; they
    count as above the last one."""
    if isinstance(_key_type(df, key), (T.FloatType, T.DoubleType)):
        df = df.withColumn(key, F.nanvl(quoted(key), F.lit(None)))
    bounds = key_min_max_batch(df, key, batch_rows).first()
    return KeyRanges(key, bounds.min_value, bounds.max_value, bounds.batch_size or 1)


def _after(start, dtype: T.DataType):
    """The next key that the type can hold."""
    if isinstance(start, float):
        return math.nextafter(start, math.inf)
    return start + (Decimal(1).scaleb(-dtype.scale) if isinstance(dtype, T.DecimalType) else 1)


def row_ranges(df: DataFrame, key: str, batch_rows: int) -> RowRanges:
    """Ranges of about ``batch_rows`` rows each, whatever the spread of the keys.

    The starts are approximate quantiles, off by at most a tenth of a batch (or a ``FINEST``-th of all rows, if that
    is more), from one aggregation of the key.
    A key that fills several ranges gets one of its own: keys after it begin another.
    """
    dtype = _key_type(df, key)
    if not isinstance(dtype, (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType)):
        raise TypeError(f"key {key!r} is not numeric: {dtype.simpleString()}")
    value = F.col(quoted(key))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        value, dtype = F.nanvl(value.cast("double"), F.lit(None)), T.DoubleType()
    rows, least = df.agg(F.count(value), F.min(value)).first()
    if not rows:
        return RowRanges(key, (), dtype)
    parts = -(-rows // batch_rows)
    starts = [least]
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = df.agg(F.percentile_approx(value, shares, min(max(10_000, 10 * parts), FINEST))).first()[0]
        for at, cut in enumerate(cuts):
            if cut > starts[-1]:
                starts.append(cut)
            elif at and cut == cuts[at - 1] and starts[-1] == cut:
                starts.append(_after(cut, dtype))
    return RowRanges(key, tuple(starts), dtype)


# Parts into which a range that is too full is split at a time, ranges that one query counts,
# and branches of one CASE, whose nesting databases limit.
PARTS, COUNTED, BRANCHES = 64, 4096, 16


def _place(value: Column, starts: list, first: int = 0) -> Column:
    """Number of the range that holds a value: a tree of CASE expressions, which databases can evaluate."""
    step = 1
    while -(-len(starts) // step) > BRANCHES:
        step *= BRANCHES
    if len(starts) == 1:
        return F.lit(first)
    groups = [starts[at:at + step] for at in range(0, len(starts), step)]
    places = [_place(value, group, first + i * step) for i, group in enumerate(groups)]
    case = F.when(value < F.lit(groups[1][0]), places[0])
    for place, after in zip(places[1:], groups[2:]):
        case = case.when(value < F.lit(after[0]), place)
    return case.otherwise(places[-1])


def _histogram(df: DataFrame, value: Column, ranges: list[tuple]) -> list[int]:
    """Rows of sorted, separate ranges, by one grouped query. The last one may have no end."""
    edges = sorted({edge for pair in ranges for edge in pair if edge is not None})
    within = value >= F.lit(edges[0])
    if ranges[-1][1] is not None:
        within &= value < F.lit(ranges[-1][1])
    found = dict(df.where(within).groupBy(_place(value, edges).alias("place")).agg(F.count(F.lit(1)).alias("rows")).collect())
    place = {edge: i for i, edge in enumerate(edges)}
    return [found.get(place[low], 0) for low, _ in ranges]


def counted_ranges(df: DataFrame, key: str, batch_rows: int) -> RowRanges:
    """The same from counts alone, which a database answers itself: no key leaves it.

    All ranges that hold over twice ``batch_rows`` rows, and several keys, are split into ``PARTS`` of equal width at a
    time, and one grouped query counts up to ``COUNTED`` of these; so the number of queries follows the
    spread of the keys, not the number of ranges. Neighbours that together fit in a batch are joined. Behind
    a connection's own filter, Spark reads the key column to count it.
    """
    dtype, value = _key_type(df, key), F.col(quoted(key))
    if not isinstance(dtype, (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType)):
        raise TypeError(f"key {key!r} is not numeric: {dtype.simpleString()}")
    least, most, rows = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if not rows:
        return RowRanges(key, (), dtype)

    def parts(low, high) -> list[tuple]:
        """The range from ``low`` to before ``high`` (None: to the end) in parts, itself if it cannot be split."""
        end = most if high is None else high
        if isinstance(low, int):
            between = {low + (end - low) * i // PARTS for i in range(1, PARTS)} | {low + 1}
        elif isinstance(low, Decimal):
            between = {(low + (end - low) * i / PARTS).quantize(low) for i in range(1, PARTS)} | {_after(low, dtype)}
        else:
            between = {low + (end - low) * i / PARTS for i in range(1, PARTS)}
        edges = [low, *sorted(cut for cut in between if low < cut and (cut <= end if high is None else cut < end)), high]
        return list(zip(edges, edges[1:]))

    settled, open_ranges = [], [(least, None, rows)]
    while open_ranges:
        finer = []
        for low, high, n in open_ranges:
            split = parts(low, high) if n > 2 * batch_rows else []
            if len(split) > 1:
                finer += split
            else:
                settled.append((low, n))
        open_ranges = []
        for at in range(0, len(finer), COUNTED):
            some = finer[at:at + COUNTED]
            open_ranges += [(low, high, n) for (low, high), n in zip(some, _histogram(df, value, some))]

    starts, held = [], batch_rows
    for start, n in sorted(settled):
        if starts and held + n <= batch_rows:
            held += n
        else:
            starts.append(start)
            held = n
    return RowRanges(key, tuple(starts), dtype)


def batch_row_counts(df: DataFrame, ranges: KeyRanges | RowRanges) -> DataFrame:
    """Rows in every non-empty range."""
    return df.groupBy(ranges.batch_id.alias("batch_id")).agg(F.count(F.lit(1)).alias("row_count"))


def high_water(df: DataFrame, key: str, hint: str | None = None) -> HighWater | None:
    """Largest key of a table, None when it has none.

    ``hint`` is a key that was the largest at some earlier time. Rows from it upwards
    are looked at first, so the scan can skip all older data on file statistics; when
    there are none (rows were removed since), all rows decide. Either way the answer
    is the true maximum.
    """
    dtype = _key_type(df, key)
    largest = marker_text(F.max(quoted(key)), dtype).alias("text")
    text = None
    if hint is not None:
        recent = df.where(F.col(quoted(key)) >= F.lit(hint).try_cast(dtype))
        text = recent.agg(largest).first().text
    if text is None:
        text = df.agg(largest).first().text
    return None if text is None else HighWater(key, text, dtype)


def _digits(number: Column) -> Column:
    """Digits of a number's whole part."""
    text = F.replace(number.cast("string"), F.lit("-"), F.lit(""))
    return F.length(F.substring_index(text, ".", 1))


def _measures(name: str, kind: str, dtype: T.DataType, length: int | None) -> dict[str, Column]:
    """Aggregates that measure one column; none when its type says it all."""
    column = F.col(quoted(name))
    if kind == "str" and length == -1:
        return {"length": F.max(F.length(column))}
    if kind == "int":
        return {"precision": F.greatest(_digits(F.min(column)), _digits(F.max(column)))}
    if kind == "decimal.Decimal":
        fraction = F.when(
            column.cast("string").contains("."), F.substring_index(column.cast("string"), ".", -1)
        )
        used = F.coalesce(F.max(F.length(F.rtrim(fraction, F.lit("0")))), F.lit(0))
        whole = F.greatest(_digits(F.min(column)), _digits(F.max(column)))
        return {"precision": whole + used, "scale": used}
    return {}


def table_columns(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, canonical type, and measured length, precision, scale.

    Declared lengths are taken as they are. Everything else is measured over all rows in
    a single aggregation, one row wide, that is then turned on its side.
    """
    columns = describe(df.schema)
    aggregates = {}
    for column in columns:
        dtype = df.schema[column.ordinal - 1].dataType
        for measure, value in _measures(column.name, column.type, dtype, column.length).items():
            aggregates[f"{measure}_{column.ordinal}"] = value.cast("int")
    measured = df.agg(F.count(F.lit(1)), *(v.alias(k) for k, v in aggregates.items()))

    def fact(column, measure: str, otherwise: int | None) -> Column:
        label = f"{measure}_{column.ordinal}"
        value = F.col(label) if label in aggregates else F.lit(otherwise).cast("int")
        return value.alias(
            {"length": "character_maximum_length"}.get(measure, f"numeric_{measure}")
        )

    rows = [
        F.struct(
            F.lit(column.ordinal).alias("ordinal_position"),
            F.lit(column.name).alias("column_name"),
            F.lit(column.type).alias("data_type"),
            fact(column, "length", column.length),
            fact(column, "precision", column.precision),
            fact(column, "scale", 0 if column.type == "int" else column.scale),
        )
        for column in columns
    ]
    return measured.select(F.inline(F.array(*rows)))


def query_columns(spark: SparkSession, query: str) -> DataFrame:
    """The same for the result of a query."""
    return table_columns(spark.sql(query))
