from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tables import ROWS, values
from haulage.operators import extract as extraction
from haulage.operators.extract import (
    HighWater,
    KeyRanges,
    drop_unsupported_columns,
    extract,
    in_ranges,
    supported_columns,
)
from haulage.operators.profile import batch_row_counts, high_water, key_ranges


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_keep_the_order_given(make):
    assert extract(make("t", ROWS), ["name_col", "id_col"]).columns == ["name_col", "id_col"]


def test_predicates_are_combined_and_may_use_dropped_columns(make):
    table = make("t", ROWS)
    mark = HighWater("id_col", "2", table.schema["id_col"].dataType)
    rows = extract(table, ["name_col"], mark, "datetime_col < timestamp_ntz '2019-10-05'")
    assert values(rows) == [("Forth",), ("Third",)]


def test_high_water_is_strict_and_skips_null_keys(make):
    table = make("t", [*ROWS, (None, "No key", None)])
    mark = high_water(table, "id_col")
    assert mark.text == "5"
    assert extract(table, high_water=mark).count() == 0
    assert extract(table, high_water=HighWater("id_col", "4", mark.dtype)).count() == 1


def test_limit_holds_over_the_whole_extract(spark):
    assert extract(spark.range(1000).repartition(8), limit=10).count() == 10
    assert extract(spark.range(5), limit=10).count() == 5


def test_filters_and_columns_reach_the_scan(make):
    table = make("t", ROWS)
    mark = HighWater("id_col", "2", table.schema["id_col"].dataType)
    text = plan(extract(table, ["id_col"], mark))
    assert "GreaterThan(id_col,2)" in text and "name_col" not in text.split("ReadSchema")[1]
    assert "Exchange" not in text


def scanned(df) -> tuple[int, int]:
    """Rows of a frame, and rows its scan read."""
    execution = df._jdf.queryExecution()
    count = execution.toRdd().count()
    node = execution.executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().apply(0)
    return count, node.metrics().apply("numOutputRows").value()


def clocked(spark, schema):
    """A thousand rows in ten files, a second apart."""
    rows = spark.range(0, 1000, 1, 10).selectExpr(
        "id", "timestamp_ntz '2020-01-01' + make_dt_interval(0, 0, 0, id) AS at")
    rows.write.saveAsTable(f"{schema}.clocked")
    return spark.table(f"{schema}.clocked")


def test_an_increment_by_time_behaves_alike_for_any_number_of_files(spark, schema):
    table = clocked(spark, schema)
    mark = high_water(table.where("id <= 850"), "at")
    assert values(extract(table, ["id"], mark)) == [(i,) for i in range(851, 1000)]
    assert values(extract(table.coalesce(1), ["id"], mark)) == values(extract(table, ["id"], mark))


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("expression", [
    "timestamp_ntz '2024-03-10 02:30:00.123456'",
    "timestamp '2024-11-03 05:30:00.5 UTC'",
    "date '2024-02-29'",
    "cast(12.340 as decimal(10,3))",
    "cast(0.1 as double) + cast(0.2 as double)",
    "'O''Brien \\\\ x'",
    "9223372036854775807L",
])
def test_marker_casts_back_to_the_same_key(spark, expression, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        table = spark.sql(f"SELECT {expression} AS k")
        mark = high_water(table, "k")
        assert table.where(F.col("k") == mark.literal).count() == 1
        assert extract(table, high_water=mark).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_long_and_binary_columns_are_dropped(spark):
    df = spark.sql("SELECT 1 AS id, repeat('x', 4001) AS long, repeat('x', 4000) AS short,"
                   " cast('a' AS binary) AS raw, array(1) AS list")
    assert drop_unsupported_columns(df, measure=True).columns == ["id", "short", "list"]
    # without a declared length text is unbounded: kept, but for Oracle sources
    assert supported_columns(df) == ["id", "long", "short", "list"]
    assert supported_columns(df, "oracle") == ["id", "list"]


def test_declared_lengths_need_no_measuring(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.d (a VARCHAR(4000), b VARCHAR(4001), c CHAR(3)) USING parquet")
    assert supported_columns(spark.table(f"{schema}.d"), "oracle") == ["a", "c"]


def test_measuring_an_empty_table_keeps_its_text(spark):
    assert supported_columns(spark.sql("SELECT 'x' AS a WHERE false"), measure=True) == ["a"]


KEYS = [
    [0, 1, 2, 9, 10, 11, None, 19],
    [5, 5, 5],
    [-7, -7, 0, 3, None],
    [-(2**63), 0, 2**63 - 1],
    [None, None],
    [],
]


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("batch_rows", [1, 2, 1000])
def test_ranges_hold_every_row_once(spark, keys, batch_rows):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    ranges = key_ranges(df, "k", batch_rows)
    assert ranges.size >= 1
    counts = batch_row_counts(df, ranges)
    assert sum(r.row_count for r in counts.collect()) == len(keys)
    if ranges.count:
        numbers = {r.batch_id for r in counts.collect()}
        assert numbers <= set(range(ranges.count))
        if ranges.count < 100:
            per_predicate = [df.where(p).count() for p in ranges.predicates()]
            assert len(per_predicate) == ranges.count and sum(per_predicate) == len(keys)
            found = dict(counts.collect())
            assert per_predicate == [found.get(i, 0) for i in range(ranges.count)]


def test_ranges_match_a_plain_computation(spark):
    keys = [k * k % 997 for k in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    ranges = key_ranges(df, "k", 60)
    low, high = min(keys), max(keys)
    size = -(-(high - low) * 60 // len(keys))
    assert (ranges.minimum, ranges.maximum, ranges.size) == (low, high, size)
    for k, number in in_ranges(df, ranges).collect():
        assert number == (k - low) // size


def test_fractional_keys_fall_in_no_gap(spark):
    for dtype in ("double", "decimal(10,2)"):
        df = spark.range(100).selectExpr(f"cast(id / 4 as {dtype}) AS k")
        ranges = key_ranges(df, "k", 10)
        assert ranges.count > 1
        found = dict(batch_row_counts(df, ranges).collect())
        assert [df.where(p).count() for p in ranges.predicates()] == [
            found.get(i, 0) for i in range(ranges.count)]


def test_rows_outside_the_bounds_join_the_nearest_range(spark):
    ranges = KeyRanges("k", 10, 29, 10)
    df = spark.createDataFrame([(-5,), (10,), (25,), (99,), (None,)], "k bigint")
    assert values(in_ranges(df, ranges)) == [(-5, 0), (10, 0), (25, 1), (99, 1), (None, 0)]
    assert [df.where(p).count() for p in ranges.predicates()] == [3, 2]
    assert KeyRanges("k", Decimal("1.50"), Decimal("9.5"), 4).predicates("[k]")[1].startswith("[k] >=")


def test_one_hot_key_still_gives_one_row_per_range(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    ranges = key_ranges(df, "k", 100)
    counts = batch_row_counts(df, ranges)
    assert counts.groupBy("batch_id").count().where("count > 1").count() == 0
    assert counts.agg(F.sum("row_count")).first()[0] == 3000
    assert "partial_count" in plan(counts)


def test_keys_must_be_numeric(make):
    with pytest.raises(TypeError):
        key_ranges(make("t", ROWS), "name_col", 10)
    with pytest.raises(AnalysisException):
        key_ranges(make("t", ROWS), "missing", 10)
