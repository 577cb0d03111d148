import math
import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tables import ROWS, values
from haulage.operators import profile
from haulage.operators.extract import RowRanges
from haulage.operators.profile import (
    batch_row_counts,
    counted_ranges,
    high_water,
    key_max,
    key_min_max,
    key_min_max_batch,
    key_ranges,
    query_columns,
    row_ranges,
    table_columns,
)


def test_max_is_text(make):
    table = make("t", ROWS[:3])
    assert values(key_max(table, "id_col")) == [("3",)]
    assert values(key_max(table, "datetime_col")) == [("2019-10-03 13:00:00",)]


def test_min_and_max(make):
    assert values(key_min_max(make("t", ROWS[:3]), "id_col")) == [(1, 3)]


def test_an_empty_table_has_no_keys(make):
    table = make("t", [])
    assert values(key_max(table, "id_col")) == [(None,)]
    assert values(key_min_max(table, "id_col")) == [(None, None)]
    assert values(key_min_max_batch(table, "id_col", 500)) == [(None, None, None)]
    assert high_water(table, "id_col") is None


def test_batch_size(make):
    # ceil((3 - 1) / (3 / 500)) = ceil(333.3)
    assert values(key_min_max_batch(make("t", ROWS[:3]), "id_col", 500)) == [(1, 3, 334)]
    assert values(key_min_max_batch(make("u", ROWS[:3]), "id_col", 1)) == [(1, 3, 1)]


def test_batch_size_is_the_ceiling_of_an_exact_quotient(spark):
    # 49 * 1000 / 7 is a whole number; a quotient of doubles may come out just above it
    df = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 4, 5, 49)], "k bigint")
    assert key_min_max_batch(df, "k", 1000).first().batch_size == 7000
    df = spark.createDataFrame([(Decimal("1.5"),), (Decimal("4.0"),)], "k decimal(5,1)")
    assert key_min_max_batch(df, "k", 1).first().batch_size == 2


def test_equal_keys_give_size_one(spark):
    assert key_min_max_batch(spark.sql("SELECT 5L AS k"), "k", 10).first().batch_size == 1


def test_a_hint_never_changes_the_maximum(make):
    table = make("t", ROWS)
    for hint in (None, "1", "5", "6", "not a number"):
        assert high_water(table, "id_col", hint).text == "5"


def test_columns_of_a_table(make):
    found = values(table_columns(make("t", ROWS[:3])))
    assert found == [
        (1, "id_col", "int", None, 1, 0),
        (2, "name_col", "str", 64, None, None),
        (3, "datetime_col", "datetime.datetime", None, None, None),
    ]


def test_columns_of_a_query_are_measured_over_all_rows(spark):
    found = values(query_columns(spark, """
        SELECT * FROM VALUES
            ('a', 12, 1.250, true, 1.5D, date '2020-01-01', interval '1' day),
            (NULL, -12345, -100.500, NULL, NULL, NULL, NULL),
            ('abc', NULL, NULL, false, 2D, NULL, NULL)
        AS t(s, i, d, b, f, day, span)"""))
    assert found == [
        (1, "s", "str", 3, None, None),
        (2, "i", "int", None, 5, 0),
        (3, "d", "decimal.Decimal", None, 5, 2),
        (4, "b", "bool", None, None, None),
        (5, "f", "float", None, None, None),
        (6, "day", "datetime.date", None, None, None),
        (7, "span", "timedelta", None, None, None),
    ]


def test_columns_of_an_empty_table(make):
    assert [row[:3] for row in values(table_columns(make("t", [])))] == [
        (1, "id_col", "int"), (2, "name_col", "str"), (3, "datetime_col", "datetime.datetime")]


def test_maximum_of_timestamps_keeps_microseconds(make):
    table = make("t", [(1, "x", datetime(2020, 1, 1, 0, 0, 0, 123456))])
    assert high_water(table, "datetime_col").text == "2020-01-01 00:00:00.123456"


@pytest.mark.parametrize("dtype", ["bigint", "decimal(20,3)", "double"])
@pytest.mark.parametrize("keys", [
    [*range(1000), 10**12], [7] * 400 + list(range(800)), [5] * 10, [1], [*range(0, 5000, 3), None, None]])
@pytest.mark.parametrize("split", [row_ranges, counted_ranges])
def test_ranges_hold_about_as_many_rows(spark, keys, dtype, split):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").selectExpr(f"cast(k AS {dtype}) AS k")
    ranges = split(df, "k", 100)
    counts = dict(batch_row_counts(df, ranges).collect())
    assert sum(counts.values()) == len(keys) and all(0 <= i < ranges.count for i in counts)
    hot = max((keys.count(k) for k in set(keys)), default=0)
    large = [n for n in counts.values() if n > 200]
    assert all(n <= hot + 100 for n in large) and len(large) <= 1
    found = [df.where(p).count() for p in ranges.predicates()]
    assert found == [counts.get(i, 0) for i in range(ranges.count)]


def test_ranges_without_keys(spark):
    none = spark.createDataFrame([(None,), (None,)], "k double")
    assert row_ranges(none, "k", 1).count == counted_ranges(none, "k", 1).count == 0 and dict(batch_row_counts(none, row_ranges(none, "k", 1)).collect()) == {0: 2}
    some = spark.sql("SELECT * FROM VALUES (1D), (2D), (double('NaN')), (NULL) AS t(k)")
    assert key_ranges(some, "k", 1).maximum == 2.0 and key_ranges(some, "k", 1).count >= 1
    assert sum(dict(batch_row_counts(some, row_ranges(some, "k", 1)).collect()).values()) == 4
    with pytest.raises(TypeError):
        row_ranges(spark.sql("SELECT 'a' AS k"), "k", 1)


def test_many_starts_are_one_constant(spark):
    starts = tuple(range(0, 1_000_000, 10))
    ranges = RowRanges("id", starts, T.LongType())
    df = spark.range(-5, 1_000_005, 1, 8).withColumn("id", F.when(F.col("id") != 77, F.col("id")))
    started = time.perf_counter()
    numbered = df.withColumn("batch_id", ranges.batch_id)
    numbered._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - started < 5
    wrong = numbered.where("batch_id <> greatest(0, least(99999, floor(coalesce(id, 0) / 10)))")
    assert wrong.isEmpty()


@pytest.mark.parametrize("dtype, starts", [("double", (-1.5, 0.1, 1e300)), ("decimal(12,2)", ("-1.50", "0.10", "7.00")),
                                           ("int", (-2, 0, 5)), ("bigint", (7,))])
def test_ranges_of_every_key_type(spark, dtype, starts):
    kind = spark.sql(f"SELECT CAST(NULL AS {dtype}) AS k").schema[0].dataType
    starts = tuple(map(Decimal, starts)) if dtype.startswith("decimal") else starts
    ranges = RowRanges("k", starts, kind)
    keys = [None, *(float(s) + d for s in starts for d in (-0.5, 0, 0.5))] + ([float("nan")] if dtype == "double" else [])
    df = spark.createDataFrame([(k,) for k in keys], "k double").withColumn("k", F.col("k").cast(dtype))
    for row in df.withColumn("batch_id", ranges.batch_id).collect():
        nan = isinstance(row.k, float) and math.isnan(row.k)
        expected = 0 if row.k is None else len(starts) - 1 if nan else max(0, sum(s <= row.k for s in starts) - 1)
        assert row.batch_id == expected


@pytest.mark.parametrize("spread", ["even", "crowded", "gaps"])
def test_a_thousand_ranges_are_counted_in_few_queries(spark, monkeypatch, spread):
    key = {"even": "id", "crowded": "CAST(pow(id, 4) / 1e4 AS BIGINT)", "gaps": "id + id DIV 10000 * 1000000000000"}[spread]
    rows = spark.range(100_000).selectExpr(f"{key} AS k").cache()
    asked, ask = [], profile._histogram
    monkeypatch.setattr(profile, "_histogram", lambda *a: asked.append(a) or ask(*a))
    ranges = profile.counted_ranges(rows, "k", 100)
    held = dict(profile.batch_row_counts(rows, ranges).collect())
    assert len(asked) < 10 and sum(held.values()) == 100_000
    assert 500 <= ranges.count <= 2000
    largest = rows.groupBy("k").count().agg({"count": "max"}).first()[0]
    assert max(held.values()) <= max(200, largest)
    rows.unpersist()


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 300])
def test_a_place_is_found_among_any_number_of_starts(spark, n):
    starts = [3 * i for i in range(n)]
    found = spark.range(3 * n + 5).select(F.col("id"), profile._place(F.col("id"), starts)).collect()
    assert all(place == min(id // 3, n - 1) for id, place in found)
