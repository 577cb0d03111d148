from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from tables import ROWS, values
from haulage import Endpoint, load_delimited, load_full_query, load_full_table, load_incremental
from haulage.functions.names import qualified
from haulage.functions.types import database_table_ddl
from haulage.operators.publish import Markers, get_markers, set_markers
from haulage.plans import strategies
from haulage.sources import jdbc
from haulage.sources.delimited import export_delimited


def full(spark, lake, schema, **options):
    return load_full_table(spark, lake, schema, "src", lake, schema, "tgt", **options)


def increment(spark, lake, schema, key="id_col", **options):
    return load_incremental(spark, lake, schema, "src", lake, schema, "tgt",
                            replication_key=key, **options)


def outcome(result):
    return result.status, result.exported_rows, result.imported_rows


@pytest.mark.parametrize("key", [None, "id_col"])
def test_full_load(spark, lake, schema, make, key):
    make("src", ROWS[:3])
    make("tgt", ROWS)
    assert outcome(full(spark, lake, schema, parallelization_key=key)) == ("DONE", 3, 3)
    assert values(spark.table(f"{schema}.tgt")) == ROWS[:3]
    assert {t.name for t in spark.catalog.listTables(schema) if not t.isTemporary} == {"src", "tgt"}


def test_full_load_of_an_empty_table(spark, lake, schema, make):
    make("src", [])
    for key in (None, "id_col"):
        assert outcome(full(spark, lake, schema, parallelization_key=key)) == ("DONE", 0, 0)
    assert spark.table(f"{schema}.tgt").columns == ["id_col", "name_col", "datetime_col"]


def test_many_batches_hold_every_row(spark, schema, make):
    make("src", [*ROWS, (None, "No key", None), (400, "Far away", None)])
    source = Endpoint(batch_rows=1)
    result = full(spark, source, schema, parallelization_key="id_col")
    assert outcome(result) == ("DONE", 7, 7)


def test_equal_keys_do_not_loop(spark, lake, schema, make):
    make("src", [(7, str(i), None) for i in range(20)])
    assert outcome(full(spark, lake, schema, parallelization_key="id_col")) == ("DONE", 20, 20)


def test_filter_and_limit_of_the_connection(spark, schema, make):
    make("src", ROWS)
    source = Endpoint(table_where_clause="id_col <> 2 OR id_col IS NULL", limit_rows=2)
    assert outcome(full(spark, source, schema)) == ("DONE", 2, 2)
    source = Endpoint(table_where_clause="id_col > 3 OR id_col = 1")
    assert outcome(full(spark, source, schema)) == ("DONE", 3, 3)
    # the increment keeps both predicates whole: OR does not escape the AND
    make("tgt", ROWS[:3])
    assert outcome(increment(spark, source, schema)) == ("DONE", 2, 2)


def test_a_missing_source_is_an_error(spark, lake, schema):
    result = full(spark, lake, schema)
    assert outcome(result) == ("ERROR", 0, 0) and result.message


def test_a_failing_extract_leaves_the_target(spark, schema, make):
    make("src", ROWS)
    make("tgt", ROWS[:1])
    source = Endpoint(table_where_clause="raise_error('broken') IS NULL")
    assert full(spark, source, schema).status == "ERROR"
    assert increment(spark, source, schema).status == "ERROR"
    assert values(spark.table(f"{schema}.tgt")) == ROWS[:1]


def test_a_key_that_is_not_numeric_is_an_error(spark, lake, schema, make):
    make("src", ROWS)
    assert full(spark, lake, schema, parallelization_key="name_col").status == "ERROR"


def test_unsupported_columns_are_left_out(spark, lake, schema):
    spark.sql(f"CREATE TABLE {schema}.src (id BIGINT, b BINARY, v VARCHAR(4001), w VARCHAR(10))"
              " USING parquet")
    spark.sql(f"INSERT INTO {schema}.src VALUES (1, cast('x' AS binary), 'x', 'x')")
    assert outcome(full(spark, lake, schema)) == ("DONE", 1, 1)
    assert spark.table(f"{schema}.tgt").columns == ["id", "b", "w"]
    result = load_incremental(spark, lake, schema, "src", lake, schema, "tgt", replication_key="v")
    assert result.status == "ERROR" and "not a loaded column" in result.message


def test_a_split_key_that_is_not_stored(spark, lake, schema):
    spark.sql(f"CREATE TABLE {schema}.src AS SELECT id, cast('x' AS binary) AS b FROM range(10)")
    assert outcome(full(spark, lake, schema, parallelization_key="id")) == ("DONE", 10, 10)


def test_query_load(spark, lake, schema, make):
    make("src", ROWS)
    source = Endpoint(limit_rows=1, table_where_clause="false")  # neither applies to a query
    query = f"SELECT id_col, cast(name_col AS binary) AS raw FROM {schema}.src WHERE id_col > 1"
    assert outcome(load_full_query(spark, source, query, lake, schema, "tgt")) == ("DONE", 4, 4)
    assert spark.table(f"{schema}.tgt").columns == ["id_col", "raw"]
    assert load_full_query(spark, lake, "SELEC", lake, schema, "tgt").status == "ERROR"
    assert spark.table(f"{schema}.tgt").count() == 4


@pytest.mark.parametrize("key", ["id_col", "datetime_col"])
@pytest.mark.parametrize("parallel", [None, "id_col"])
def test_increment(spark, lake, schema, make, key, parallel):
    make("src", ROWS)
    make("tgt", ROWS[:3])
    first = increment(spark, lake, schema, key, parallelization_key=parallel)
    assert outcome(first) == ("DONE", 2, 2)
    assert values(spark.table(f"{schema}.tgt")) == ROWS
    assert outcome(increment(spark, lake, schema, key)) == ("DONE", 0, 0)
    assert spark.table(f"{schema}.tgt").count() == 5


def test_increment_from_a_view(spark, lake, schema, make):
    make("rows", ROWS)
    spark.sql(f"CREATE VIEW {schema}.src AS SELECT * FROM {schema}.rows")
    make("tgt", ROWS[:3])
    assert outcome(increment(spark, lake, schema, "datetime_col")) == ("DONE", 2, 2)
    assert values(spark.table(f"{schema}.tgt")) == ROWS


def test_increment_without_a_key(spark, lake, schema, make):
    make("src", ROWS)
    assert outcome(increment(spark, lake, schema, None)) == ("ERROR", 0, 0)
    assert outcome(increment(spark, lake, schema, "missing")) == ("ERROR", 0, 0)
    assert not spark.catalog.tableExists(f"{schema}.tgt")


def test_first_increment_loads_everything(spark, lake, schema, make):
    make("src", [*ROWS, (None, "No key", None)])
    assert outcome(increment(spark, lake, schema)) == ("DONE", 6, 6)
    assert get_markers(spark, lake, schema, "tgt", "id_col") == Markers("5")


@pytest.mark.parametrize("rows", [[], [(None, "No key", None)]])
def test_a_target_without_keys_is_loaded_in_full(spark, lake, schema, make, rows):
    make("src", ROWS)
    make("tgt", rows)
    assert outcome(increment(spark, lake, schema)) == ("DONE", 5, 5)
    assert values(spark.table(f"{schema}.tgt")) == ROWS


def test_late_and_changed_rows_are_not_seen(spark, lake, schema, make):
    make("tgt", ROWS[:3])
    make("src", [(1, "Changed", None), (2, "Late", None), (3, "Third again", None),
                 (None, "No key", None), ROWS[3]])
    assert outcome(increment(spark, lake, schema)) == ("DONE", 1, 1)
    assert values(spark.table(f"{schema}.tgt")) == ROWS[:4]


def test_an_append_that_was_cut_short_is_made_good(spark, lake, schema, make):
    make("src", ROWS)
    make("tgt", ROWS[:2])
    # the driver was lost while publishing: a later row is there, an earlier one is not
    set_markers(spark, lake, schema, "tgt", "id_col", Markers("2", pending="2"))
    spark.sql(f"INSERT INTO {schema}.tgt SELECT * FROM {schema}.src WHERE id_col = 4")
    assert outcome(increment(spark, lake, schema)) == ("DONE", 2, 2)
    assert values(spark.table(f"{schema}.tgt")) == ROWS
    assert get_markers(spark, lake, schema, "tgt", "id_col") == Markers("5")
    assert outcome(increment(spark, lake, schema)) == ("DONE", 0, 0)


@pytest.mark.parametrize("stranger", [None, (9, "Another writer", None), (4, "Another writer", None)])
def test_history_outlives_its_source(spark, lake, schema, make, stranger):
    old = [(i, f"Old {i}", None) for i in range(50)]
    make("tgt", old)
    new = [(i, f"New {i}", None) for i in range(40, 60)]  # the source keeps less than the target
    make("src", new)
    set_markers(spark, lake, schema, "tgt", "id_col", Markers("49", pending="49"))
    late = [] if stranger is None else [(stranger[0] + 60, *stranger[1:])]
    for id, name, _ in late + new[10:13]:
        spark.sql(f"INSERT INTO {schema}.tgt VALUES ({id}, '{name}', NULL)")
    assert increment(spark, lake, schema).status == "DONE"
    assert values(spark.table(f"{schema}.tgt")) == sorted([*old, *new[10:], *late], key=repr)


def test_left_out_columns_are_named(spark, lake, schema):
    spark.sql(f"CREATE TABLE {schema}.src AS SELECT 1 AS id, cast('x' AS binary) AS raw, repeat('x', 4001) AS t")
    assert full(spark, lake, schema).message == ""  # Spark catalogs keep what databases cannot
    result = full(spark, lake, schema, measure_columns=True)
    assert result.message == "left out: raw, t" and spark.table(f"{schema}.tgt").columns == ["id"]


def test_a_later_measurement_does_not_change_a_target(spark, lake, schema):
    spark.sql(f"CREATE TABLE {schema}.src AS SELECT 1L AS id, 'short' AS t")
    assert outcome(increment(spark, lake, schema, "id", measure_columns=True)) == ("DONE", 1, 1)
    spark.sql(f"INSERT INTO {schema}.src SELECT 2L, repeat('x', 5000)")
    assert outcome(increment(spark, lake, schema, "id", measure_columns=True)) == ("DONE", 1, 1)
    assert values(spark.table(f"{schema}.tgt").selectExpr("id", "length(t)")) == [(1, 5), (2, 5000)]


def test_rows_of_each_range_are_reported(spark, schema, make):
    make("src", [(i, "x", None) for i in range(100)] + [(10**12, "far", None), (None, "no key", None)])
    result = full(spark, Endpoint(batch_rows=10), schema, parallelization_key="id_col")
    assert sum(result.batch_rows) == 102 and len(result.batch_rows) > 9 and max(result.batch_rows) <= 20


def test_an_append_that_published_nothing_is_simply_repeated(spark, schema, make):
    make("src", ROWS)
    make("tgt", ROWS[:3])
    broken = Endpoint(table_where_clause="id_col < 5 OR raise_error('broken') IS NULL")
    assert increment(spark, broken, schema).status == "ERROR"
    assert get_markers(spark, broken, schema, "tgt", "id_col") == Markers("3", pending="3")
    assert outcome(increment(spark, Endpoint(), schema)) == ("DONE", 2, 2)
    assert values(spark.table(f"{schema}.tgt")) == ROWS


def test_a_staging_table_with_other_rows_is_not_published(spark, lake, schema, make, monkeypatch):
    make("src", ROWS)
    make("tgt", ROWS[:1])
    monkeypatch.setattr(strategies, "insert", lambda df, name, largest=None: strategies.Written(5))
    result = full(spark, lake, schema)
    assert result.status == "ERROR" and "holds 0 rows of 5" in result.message
    assert values(spark.table(f"{schema}.tgt")) == ROWS[:1]


def test_counts_hold_when_tasks_are_repeated(spark, lake, schema, folder):
    def lost_at_first(value):
        from pyspark import TaskContext

        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0 and value % 100 == 90:
            raise RuntimeError("executor lost")
        return value

    spark.udf.register("lost_at_first", lost_at_first, "long")
    spark.range(0, 4000, 1, 8).write.saveAsTable(f"{schema}.src")
    flaky = Endpoint(table_where_clause="lost_at_first(id) >= 0")
    query = f"SELECT lost_at_first(id) AS id FROM {schema}.src WHERE id < 1000"
    assert outcome(load_full_query(spark, flaky, query, lake, schema, "tgt")) == ("DONE", 1000, 1000)
    assert outcome(increment(spark, flaky, schema, "id")) == ("DONE", 3000, 3000)
    assert spark.table(f"{schema}.tgt").select("id").distinct().count() == 4000
    assert spark.table(f"{schema}.tgt").count() == 4000
    assert export_delimited(spark.table(f"{schema}.src").where("lost_at_first(id) >= 0"), folder) == 4000


def test_rows_removed_from_the_target_are_loaded_again(spark, lake, schema, make):
    make("src", ROWS)
    increment(spark, lake, schema)
    spark.sql(f"INSERT OVERWRITE {schema}.tgt SELECT * FROM {schema}.src WHERE id_col < 3")
    assert outcome(increment(spark, lake, schema)) == ("DONE", 3, 3)
    assert values(spark.table(f"{schema}.tgt")) == ROWS


def test_increment_matches_columns_by_name(spark, lake, schema, make):
    make("src", ROWS)
    spark.sql(f"CREATE TABLE {schema}.tgt USING parquet AS SELECT datetime_col, name_col, id_col"
              f" FROM {schema}.src WHERE id_col < 4")
    assert outcome(increment(spark, lake, schema)) == ("DONE", 2, 2)
    assert values(spark.table(f"{schema}.tgt"), "id_col", "name_col", "datetime_col") == ROWS
    spark.sql(f"ALTER TABLE {schema}.tgt ADD COLUMNS (extra INT)")
    make("src", [*ROWS, (6, "Sixth", datetime(2019, 10, 6))])
    assert increment(spark, lake, schema).status == "ERROR"
    assert spark.table(f"{schema}.tgt").count() == 5


def test_differing_counts_are_a_warning():
    assert strategies._finished(5, 4).status == "WARN"


def test_an_increment_is_written_in_few_files(spark, lake, schema, make):
    make("tgt", ROWS[:3])
    spark.range(4, 2004).selectExpr(
        "id AS id_col", "cast(id AS string) AS name_col", "cast(NULL AS timestamp_ntz) AS datetime_col"
    ).repartition(40).write.saveAsTable(f"{schema}.src")
    before = len(spark.table(f"{schema}.tgt").inputFiles())
    assert outcome(increment(spark, lake, schema)) == ("DONE", 2000, 2000)
    assert len(spark.table(f"{schema}.tgt").inputFiles()) - before < 5
    assert spark.table(f"{schema}.tgt").agg(F.max("id_col")).first()[0] == 2003


def test_oracle_values_lose_their_nul_bytes(spark, lake):
    df = spark.sql("SELECT concat('a', char(0), 'b') AS s, cast(3 AS decimal(10,0)) AS n")
    moved = strategies._for_target(df, Endpoint(name="ora", kind="oracle"), lake)
    assert values(moved) == [("ab", 3)] and dict(moved.dtypes)["n"] == "bigint"


class Database(Endpoint):
    """Takes the ways of a database target, with its tables in the session catalog."""

    def use(self, spark):
        pass

    def schema_name(self, schema):
        return qualified(schema)

    def table_name(self, schema, table):
        return qualified(schema, table)

    def create_table(self, spark, schema, table, columns):
        spark.sql(database_table_ddl(schema, table, columns, self.kind))


def test_a_database_target_is_staged_then_appended(spark, lake, schema, make):
    make("src", ROWS)
    database = Database(name="pg", kind="postgres", parallel_loads=2)
    ends = (spark, lake, schema, "src", database, schema, "tgt")
    assert outcome(load_full_table(*ends)) == ("DONE", 5, 5)
    make("src", [*ROWS, (6, "Sixth", None), (7, "Seventh", None)])
    assert outcome(load_incremental(*ends, replication_key="id_col")) == ("DONE", 2, 2)
    assert outcome(load_incremental(*ends, replication_key="id_col")) == ("DONE", 0, 0)
    assert spark.table(f"{schema}.tgt").count() == 7
    assert not spark.catalog.tableExists(f"{schema}.tgt_tmp")


def test_a_database_source_is_read_range_by_range(spark, lake, schema, make, monkeypatch):
    rows = [*ROWS, (None, "No key", None), (40, "Far", None), (41, "Deleted", None)]
    make("src", rows)
    asked = []

    def answer(spark, kind, credentials, table, where=None, predicates=None):
        asked.append((table, where, predicates))
        found = spark.table(table).where(where or "true")
        parts = [found.where(p) for p in predicates or ["true"]]
        return reduce(DataFrame.unionAll, parts)

    monkeypatch.setattr(jdbc, "read_table", answer)
    source = Database(name="pg", kind="postgres", parallel_loads=3, batch_rows=2,
                      table_where_clause="name_col <> 'Deleted'")
    ends = (spark, source, schema, "src", lake, schema, "tgt")
    assert outcome(load_full_table(*ends, parallelization_key="id_col")) == ("DONE", 7, 7)
    assert values(spark.table(f"{schema}.tgt")) == sorted(rows[:-1], key=repr)
    assert [(table, where) for table, where, _ in asked] == [
        (f"{schema}.src", "name_col <> 'Deleted'")] * 2
    assert asked[0][2] is None and len(asked[1][2]) >= 3
    read = source.read_rows(spark, schema, "src", [f"id_col = {i}" for i in range(5)])
    assert read.rdd.getNumPartitions() == 3  # never more queries at a time than allowed
    source.read_rows(spark, schema, "src", [f"{i} = {i}" for i in (1, 2, 3, 4)])
    assert asked[-1][2] == ["1 = 1", "4 = 4", "2 = 2", "3 = 3"]  # spread over the three tasks
    # an increment splits the newer rows only
    make("tgt", ROWS[:3])
    del asked[:]
    found = load_incremental(*ends, replication_key="id_col", parallelization_key="id_col")
    assert outcome(found) == ("DONE", 3, 3)
    assert asked[1][2] == ["1 = 1"]  # three rows are no more than twice a batch


def test_staged_text_can_be_loaded(spark, lake, schema, make, folder):
    people = make("people", ROWS)
    make("tgt", ROWS[:1])
    export_delimited(people, folder + "/good")
    found = load_delimited(spark, folder + "/good", people.schema, lake, schema, "tgt")
    assert outcome(found) == ("DONE", 5, 5) and values(spark.table(f"{schema}.tgt")) == ROWS
    rows = people.selectExpr("if(id_col = 2, 'two', cast(id_col AS string)) AS id_col", "name_col", "datetime_col")
    export_delimited(rows, folder + "/bad")
    assert load_delimited(spark, folder + "/bad", people.schema, lake, schema, "tgt").status == "ERROR"
    assert values(spark.table(f"{schema}.tgt")) == ROWS
    found = load_delimited(spark, folder + "/bad", people.schema, lake, schema, "tgt", skip_bad_rows=True)
    assert outcome(found) == ("WARN", 5, 4)
    assert values(spark.table(f"{schema}.tgt"), "id_col") == [(1,), (3,), (4,), (5,)]


def test_names_may_differ_in_case(spark, lake, schema, make):
    make("src", ROWS)
    spark.sql(f"CREATE TABLE {schema}.tgt USING parquet AS SELECT id_col AS ID_COL, name_col AS NAME_COL,"
              f" datetime_col AS DATETIME_COL FROM {schema}.src WHERE id_col < 4")
    assert outcome(increment(spark, lake, schema)) == ("DONE", 2, 2)
    assert values(spark.table(f"{schema}.tgt")) == ROWS
