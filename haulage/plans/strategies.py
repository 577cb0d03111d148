"""Load strategies: full table, full query, and append by high-water mark.

A load is one lazy frame from the source to the write. Nothing is staged on the way;
the only intermediate is the new table itself, published when complete.
Any failure fails the load and leaves the target as it was.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..functions.types import cast_for_target, cast_from_oracle
from ..operators.extract import (
    HighWater,
    RowRanges,
    extract,
    marker_text,
    supported_columns,
)
from ..operators.profile import batch_row_counts, counted_ranges, high_water, row_ranges
from ..operators.publish import (
    STAGING,
    Markers,
    Written,
    aligned,
    append_and_drop,
    create_staging,
    get_markers,
    import_delimited,
    insert,
    set_markers,
    swap_table,
)
from ..sources.delimited import DELIMITER
from ..sources.endpoint import Endpoint
from ..status import DONE, ERROR, WARN

logger = logging.getLogger(__name__)

@dataclass(frozen=True)
class LoadResult:
    """Outcome of one load. ``WARN`` means that rows read and rows stored differ in number."""

    status: str
    exported_rows: int = 0
    imported_rows: int = 0
    message: str = ""
    batch_rows: tuple[int, ...] = ()  # rows stored of each key range, where a key splits the load


def _finished(exported: int, imported: int) -> LoadResult:
    if exported == imported:
        return LoadResult(DONE, exported, imported)
    return LoadResult(WARN, exported, imported, "exported and imported rows differ")


def _reported(strategy: Callable[..., LoadResult]) -> Callable[..., LoadResult]:
    """Turn a failure into an ERROR result, so that other loads go on."""

    @functools.wraps(strategy)
    def run(*args, **kwargs) -> LoadResult:
        try:
            return strategy(*args, **kwargs)
        except Exception as error:
            logger.exception("load failed")
            return LoadResult(ERROR, message=f"{type(error).__name__}: {error}")

    return run


def _source_rows(
    spark: SparkSession,
    source: Endpoint,
    schema: str,
    table: str,
    columns: list[str],
    mark: HighWater | None,
    parallelization_key: str | None,
) -> tuple[DataFrame, RowRanges | None]:
    """The rows to load, and the key ranges they split into when a key is given.

    Spark splits a catalog table by its files, so ranges change nothing about how it is
    read. A database is read with one query per range.
    """
    rows, ranges = source.read_rows(spark, schema, table), None
    if parallelization_key:
        keys = extract(rows, [parallelization_key], mark)
        split = counted_ranges if source.is_jdbc else row_ranges
        ranges = split(keys, parallelization_key, source.batch_rows)
        if source.is_jdbc and ranges.count:
            rows = source.read_rows(spark, schema, table, ranges.predicates())
    return extract(rows, columns, mark, limit=source.limit_rows), ranges


def _for_target(df: DataFrame, source: Endpoint, target: Endpoint) -> DataFrame:
    """Value rules of the two ends: Oracle numbers and NULs, and the target's types."""
    if source.kind == "oracle":
        df = cast_from_oracle(df)
    if target.is_jdbc:
        # Each write task holds a database connection; the shuffle keeps what comes before it parallel.
        df = cast_for_target(df, target.dialect).repartition(target.parallel_loads)
    return df


def _largest(df: DataFrame, target: Endpoint, key: str | None) -> Column | None:
    """Measure of the largest key written, where the target can remember it."""
    if key is None or target.is_jdbc:
        return None
    return marker_text(F.max(quoted(key)), df.select(quoted(key)).schema[0].dataType)


def _stage(
    spark: SparkSession,
    df: DataFrame,
    target: Endpoint,
    schema: str,
    table: str,
    ranges: RowRanges | None = None,
    key: str | None = None,
) -> tuple[Written, tuple[int, ...]]:
    """Fill a new staging table and make sure that it holds the rows read, no more, no less."""
    create_staging(spark, target, schema, table + STAGING, df.schema)
    name = target.table_name(schema, table + STAGING)
    written = insert(df, name, _largest(df, target, key))
    staged = target.read_table(spark, schema, table + STAGING)
    batches = {}
    if ranges is not None and not target.is_jdbc:
        batches = dict(batch_row_counts(staged, ranges).collect())  # one row per range
    stored = sum(batches.values()) if batches else staged.count()
    if stored != written.rows:
        raise RuntimeError(f"{name} holds {stored} rows of {written.rows} read")
    return written, tuple(batches.get(i, 0) for i in range(ranges.count)) if batches else ()


def _full(
    spark: SparkSession,
    df: DataFrame,
    target: Endpoint,
    schema: str,
    table: str,
    ranges: RowRanges | None = None,
    key: str | None = None,
) -> LoadResult:
    """Stage, publish, and remember the largest key for later increments."""
    written, batches = _stage(spark, df, target, schema, table, ranges, key)
    swap_table(spark, target, schema, table, table + STAGING)
    if written.largest is not None:
        set_markers(spark, target, schema, table, key, Markers(written.largest))
    return replace(_finished(written.rows, written.rows), batch_rows=batches)


def _loaded_columns(
    table: DataFrame, source: Endpoint, target: Endpoint, measure: bool
) -> tuple[list[str], str]:
    """Columns to load, and a note of those left out. Between Spark catalogs binary data can stay."""
    keep_binary = not measure and not source.is_jdbc and not target.is_jdbc
    columns = supported_columns(table, source.dialect, measure, keep_binary)
    left_out = [name for name in table.columns if name not in columns]
    return columns, f"left out: {', '.join(left_out)}" if left_out else ""


def _noted(result: LoadResult, note: str) -> LoadResult:
    return replace(result, message="; ".join(filter(None, (result.message, note))))


@_reported
def load_full_table(
    spark: SparkSession,
    source: Endpoint,
    source_schema: str,
    source_table: str,
    target: Endpoint,
    target_schema: str,
    target_table: str,
    parallelization_key: str | None = None,
    measure_columns: bool = False,
) -> LoadResult:
    """Replace the target with the source table."""
    target.require_writable()
    table = source.read_table(spark, source_schema, source_table)
    columns, note = _loaded_columns(table, source, target, measure_columns)
    return _noted(_full_table(spark, source, source_schema, source_table, columns, target,
                              target_schema, target_table, parallelization_key), note)


def _full_table(
    spark, source, source_schema, source_table, columns, target, target_schema, target_table,
    parallelization_key=None, replication_key=None,
) -> LoadResult:
    rows, ranges = _source_rows(
        spark, source, source_schema, source_table, columns, None, parallelization_key
    )
    rows = _for_target(rows, source, target)
    if parallelization_key not in columns:
        ranges = None  # the key splits the extract but is not stored, so it cannot be recounted
    return _full(spark, rows, target, target_schema, target_table, ranges, replication_key)


@_reported
def load_full_query(
    spark: SparkSession,
    source: Endpoint,
    query: str,
    target: Endpoint,
    target_schema: str,
    target_table: str,
) -> LoadResult:
    """Replace the target with a query result: no filter, limit or column removal is added."""
    target.require_writable()
    rows = _for_target(source.read_query(spark, query), source, target)
    return _full(spark, rows, target, target_schema, target_table)


@_reported
def load_delimited(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    target: Endpoint,
    target_schema: str,
    target_table: str,
    delimiter: str = DELIMITER,
    skip_bad_rows: bool = False,
) -> LoadResult:
    """Replace the target with staged text. Lines that were left out make it a ``WARN``."""
    target.require_writable()
    staging = target_table + STAGING
    create_staging(spark, target, target_schema, staging, columns)
    imported = import_delimited(
        spark, path, target, target_schema, staging, delimiter, skip_bad_rows
    )
    swap_table(spark, target, target_schema, target_table, staging)
    return _finished(imported.rows + imported.rejected, imported.rows)


@_reported
def load_incremental(
    spark: SparkSession,
    source: Endpoint,
    source_schema: str,
    source_table: str,
    target: Endpoint,
    target_schema: str,
    target_table: str,
    replication_key: str | None = None,
    parallelization_key: str | None = None,
    measure_columns: bool = False,
) -> LoadResult:
    """Append the rows whose key exceeds the largest one in the target.

    A target that is absent, empty or without any key is loaded in full. Rows that
    arrive later with an equal, smaller or NULL key are not picked up, and changes to
    rows already loaded are not seen.
    """
    target.require_writable()
    if not replication_key:
        return LoadResult(ERROR, message="no replication key is given")
    table = source.read_table(spark, source_schema, source_table)
    mark, markers = None, Markers()
    if target.table_exists(spark, target_schema, target_table):
        markers = get_markers(spark, target, target_schema, target_table, replication_key)
        there = target.read_table(spark, target_schema, target_table)
        if replication_key.lower() not in map(str.lower, there.columns):
            return LoadResult(ERROR, message="the replication key is not a loaded column")
        mark = high_water(there, replication_key, markers.largest)
    if mark is None:
        columns, note = _loaded_columns(table, source, target, measure_columns)
        if replication_key not in columns:
            return LoadResult(ERROR, message="the replication key is not a loaded column")
        logger.info("%s.%s holds no key to go on from, loading in full", target_schema, target_table)
        return _noted(_full_table(spark, source, source_schema, source_table, columns, target, target_schema,
                                  target_table, parallelization_key, replication_key), note)
    # The columns of a target that is there decide, whatever a new measurement would say.
    known = {name.lower() for name in there.columns}
    columns = [name for name in table.columns if name.lower() in known]
    left_out = [name for name in table.columns if name.lower() not in known]
    note = f"not in the target: {', '.join(left_out)}" if left_out else ""
    unconfirmed = markers.pending and mark.text != markers.pending
    since = replace(mark, text=markers.pending) if unconfirmed else mark
    rows, _ = _source_rows(
        spark, source, source_schema, source_table, columns, since, parallelization_key
    )
    rows = _for_target(rows, source, target)
    if target.is_jdbc:
        return _noted(_append_staged(spark, rows, target, target_schema, target_table, mark), note)
    if unconfirmed:
        rows = _missing(rows, there.where(since.newer))
    return _noted(_append(spark, rows, target, target_schema, target_table, since, mark.text), note)


def _missing(rows: DataFrame, there: DataFrame) -> DataFrame:
    """The rows that an append which was cut short did not bring.

    Its files may have been published in part, and other writers may have moved the largest key. So all
    rows since the append began are read again and those that are there are taken off, as often as they
    are there. Nothing is deleted, whoever wrote it, and no row comes in twice.
    """
    logger.warning("an earlier append was cut short, adding what it missed")
    return aligned(rows, there.columns).exceptAll(there)


def _append(
    spark: SparkSession, df: DataFrame, target: Endpoint, schema: str, table: str, mark: HighWater,
    largest_there: str,
) -> LoadResult:
    """Append in one write. Until it is confirmed, the target remembers the key it started from.

    An increment is a few rows out of each of many source splits. Rebalancing it gives
    files of a useful size whatever the number of splits and however its keys are spread.
    """
    columns = target.read_table(spark, schema, table).columns
    rows = aligned(df, columns).hint("rebalance")
    set_markers(spark, target, schema, table, mark.key, Markers(largest_there, pending=mark.text))
    largest = _largest(rows, target, mark.key)
    written = insert(rows, target.table_name(schema, table), largest)
    set_markers(spark, target, schema, table, mark.key, Markers(written.largest or largest_there))
    return _finished(written.rows, written.rows)


def _append_staged(
    spark: SparkSession, df: DataFrame, target: Endpoint, schema: str, table: str, mark: HighWater
) -> LoadResult:
    """Append by way of a staging table: the tasks of a database write commit one by one,
    so rows are counted before they reach the target, and again when they are there."""
    written, _ = _stage(spark, df, target, schema, table)
    append_and_drop(spark, target, schema, table, table + STAGING)
    added = target.read_table(spark, schema, table).where(mark.newer)
    return _finished(written.rows, added.count())
