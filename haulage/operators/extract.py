"""Extraction frames: column list, predicates, limit, and key-range batches.

Everything here is a narrow transformation. Filters and column lists reach the
source through Catalyst; nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..functions.types import BINARY_TYPES, MAX_STRING_LENGTH, describe


@dataclass(frozen=True)
class HighWater:
    """Largest key already loaded, kept as text together with its type."""

    key: str
    text: str
    dtype: T.DataType

    @property
    def literal(self) -> Column:
        """A constant of the key's own type, so that the comparison needs no cast of the key
        and stays eligible for pushdown."""
        return F.lit(self.text).cast(self.dtype)

    @property
    def newer(self) -> Column:
        """Strictly greater: rows with an equal or a NULL key are never taken again."""
        return F.col(quoted(self.key)) > self.literal


def marker_text(key: Column, dtype: T.DataType) -> Column:
    """Text of a key from which exactly the same key can be cast back."""
    if isinstance(dtype, T.TimestampType):
        return F.date_format(key, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return key.cast("string")


def extract(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    high_water: HighWater | None = None,
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Named columns of the rows that pass every given predicate, at most ``limit`` of them.

    Predicates may use columns that are not kept. Which rows a limit keeps is unspecified.
    """
    if high_water is not None:
        df = df.where(high_water.newer)
    if where:
        df = df.where(where)
    df = df.select(*(quoted(name) for name in (df.columns if columns is None else columns)))
    return df.limit(limit) if limit else df


def supported_columns(
    df: DataFrame, dialect: str = "postgres", measure: bool = False, keep_binary: bool = False
) -> list[str]:
    """Columns that table loads keep: no binary data (unless asked to), no strings over 4000 characters.

    The declared length decides and needs no scan. Strings without one are unbounded
    text, kept everywhere but for Oracle sources; ``measure`` decides on their longest
    value instead, in one aggregation over those columns.
    """
    columns = describe(df.schema)
    lengths = {c.name: c.length for c in columns if c.type == "str"}
    if measure:
        unbounded = [name for name, length in lengths.items() if length == -1]
        if unbounded:
            longest = df.agg(*(F.max(F.length(quoted(name))).alias(name) for name in unbounded))
            lengths.update((name, size or 0) for name, size in longest.first().asDict().items())
    return [
        c.name
        for c in columns
        if (keep_binary or c.type not in BINARY_TYPES)
        and lengths.get(c.name, 0) <= MAX_STRING_LENGTH
        and not (dialect == "oracle" and lengths.get(c.name) == -1)
    ]


def drop_unsupported_columns(
    df: DataFrame, dialect: str = "postgres", measure: bool = False
) -> DataFrame:
    """Keep the supported columns only, in their order."""
    return df.select(*(quoted(name) for name in supported_columns(df, dialect, measure)))


@dataclass(frozen=True)
class KeyRanges:
    """Equal-width half-open ranges of a numeric key that together hold every row.

    Rows without a key are in the first range; keys outside the bounds are in the
    nearest one.
    """

    key: str
    minimum: int | Decimal | float | None
    maximum: int | Decimal | float | None
    size: int

    @property
    def count(self) -> int:
        """Number of ranges; none for an empty table."""
        if self.minimum is None:
            return 0
        return int((self.maximum - self.minimum) // self.size) + 1

    @property
    def batch_id(self) -> Column:
        """Number of the range a row is in, from 0."""
        if self.minimum is None:
            return F.lit(0).cast("bigint")
        key = quoted(self.key)
        if isinstance(self.minimum, float):
            low, high = (f"cast('{bound!r}' as double)" for bound in (self.minimum, self.maximum))
            return F.expr(f"cast(floor((least(greatest({key}, {low}), {high}) - {low}) / {self.size})"
                          " as bigint)")
        if isinstance(self.minimum, int):
            # the spread itself may need more than 64 bits
            dtype = "bigint" if self.maximum - self.minimum < 2**63 else "decimal(20,0)"
            key = f"cast({key} as {dtype})"
            low, high = (f"cast({bound} as {dtype})" for bound in (self.minimum, self.maximum))
        else:
            low, high = f"{self.minimum:f}BD", f"{self.maximum:f}BD"
        # greatest() and least() skip NULL, which puts rows without a key in the first range
        return F.expr(f"(least(greatest({key}, {low}), {high}) - {low}) div {self.size}L")

    def predicates(self, column: str | None = None) -> list[str]:
        """One SQL predicate per range, for partitioned reads from a database."""
        name = column or self.key
        if self.minimum is None:
            return []
        starts = [self.minimum + i * self.size for i in range(self.count)]
        if len(starts) == 1:
            return ["1 = 1"]
        first, last = f"({name} < {starts[1]} OR {name} IS NULL)", f"{name} >= {starts[-1]}"
        inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(starts[1:], starts[2:])]
        return [first, *inner, last]


@dataclass(frozen=True)
class RowRanges:
    """Half-open ranges of a key that hold about as many rows each, given by their starts.

    Rows without a key or below the first start are in the first range, NaN keys in the last.
    """

    key: str
    starts: tuple
    dtype: T.DataType

    @property
    def count(self) -> int:
        return len(self.starts)

    @property
    def batch_id(self) -> Column:
        """Number of the range a row is in, from 0: a binary search among the starts, which are one constant of
        the plan, however many there are."""
        if not self.starts:
            return F.lit(0).cast("bigint")
        key, n = F.col(quoted(self.key)), len(self.starts)
        starts = F.split(F.lit(",".join(map(str, self.starts))), ",").cast(T.ArrayType(self.dtype))
        steps = F.split(F.lit(",".join(str(1 << k) for k in reversed(range(n.bit_length())))), ",").cast("array<int>")

        def halved(below: Column, step: Column) -> Column:
            # ``below`` starts are known not to exceed the key; beyond the last start there is none.
            return F.when(F.get(starts, below + step - 1) <= key, below + step).otherwise(below)

        below = F.aggregate(steps, F.lit(0), halved)
        return F.greatest(below - 1, F.lit(0)).cast("bigint")

    def predicates(self, column: str | None = None) -> list[str]:
        """One SQL predicate per range, for partitioned reads from a database."""
        name, starts = column or self.key, self.starts
        if not starts:
            return []
        if len(starts) == 1:
            return ["1 = 1"]
        first, last = f"({name} < {starts[1]} OR {name} IS NULL)", f"{name} >= {starts[-1]}"
        inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(starts[1:], starts[2:])]
        return [first, *inner, last]


def in_ranges(df: DataFrame, ranges: KeyRanges | RowRanges, name: str = "batch_id") -> DataFrame:
    """Number every row with its key range, in the pass that reads it anyway."""
    return df.withColumn(name, ranges.batch_id)
