import json

import pytest
from tables import ROWS, values
from haulage import Endpoint, LoadSpec, Project, RunLog, run_load, run_project
from haulage.__main__ import main
from haulage.plans.runlog import ProjectLog


def project(schema, **overrides):
    config = {
        "source": "lake", "target": "lake", "logdb": "lake", "logschema": schema, "parallel_loads": 3,
        "schemas": [
            {"source_schema": schema, "target_schema": schema, "table_prefix": "pre_", "table_suffix": "_suf",
             "tables": [{"table_name": "src", "parallelization_key": "id_col"},
                        {"table_name": "inc", "replication_method": "INCREMENTAL",
                         "replication_key": "id_col"}]},
            {"source_schema": schema, "target_schema": schema, "table_prefix": "bad_",
             "tables": [{"table_name": "src", "replication_method": "SOMETIMES"},
                        {"table_name": "absent"},
                        {"table_name": "inc", "replication_method": "INCREMENTAL"}]},
        ],
        "queries": [
            {"target_schema": schema, "queries": [
                {"query_name": "one", "table_name": "q1", "query": f"SELECT * FROM {schema}.src"}]},
            {"target_schema": schema, "queries": [
                {"query_name": "two", "table_name": "q2", "query": f"SELECT * FROM {schema}.src",
                 "replication_method": "INCREMENTAL"},
                {"query_name": "three", "table_name": "q3", "query": "SELECT 1 AS x"}]},
        ],
        **overrides,
    }
    connections = {"lake": {"type": "spark", "target": "dev",
                            "outputs": {"dev": {}, "small": {"limit_rows": 1}}}}
    return config, connections


EXPECTED = [
    ("src", "pre_src_suf", "DONE", 5, 5),
    ("inc", "pre_inc_suf", "DONE", 2, 2),
    ("src", "bad_src", "ERROR", 0, 0),
    ("absent", "bad_absent", "ERROR", 0, 0),
    ("inc", "bad_inc", "ERROR", 0, 0),
    ("query", "q1", "DONE", 5, 5),
    ("query", "q2", "ERROR", 0, 0),
    ("query", "q3", "DONE", 1, 1),
]


def prepare(make):
    make("src", ROWS)
    make("inc", ROWS)
    make("pre_inc_suf", ROWS[:3])


def test_loads_are_expanded_in_order(schema):
    plan = Project.from_config("MyProject", *project(schema))
    assert plan.name == "myproject" and plan.parallel_loads == 3
    assert [load.target_table for load in plan.loads] == [row[1] for row in EXPECTED]
    assert plan.loads[5].title == "one" and plan.loads[0].title == f"{schema}.src"


def test_sections_are_optional():
    connections = {"a": {"type": "spark", "target": "dev", "outputs": {"dev": {}}}}
    plan = Project.from_config("p", {"source": "a", "target": "a"}, connections)
    assert plan.loads == [] and plan.log_endpoint is None and plan.parallel_loads == 1


def test_the_profile_can_be_overridden(schema):
    config, connections = project(schema)
    assert Project.from_config("p", config, connections).source.limit_rows is None
    assert Project.from_config("p", config, connections, "small").source.limit_rows == 1


def test_connection_options():
    options = {"host": "h", "database": "d", "limit_rows": 100, "table_where_clause": "x > 1",
               "table_parallel_loads": 3, "table_parallel_batch_size": 500}
    endpoint = Endpoint.from_config("pg", {"type": "postgres", "read_only": True, "target": "dev",
                                           "outputs": {"dev": options}})
    assert (endpoint.kind, endpoint.read_only, endpoint.limit_rows, endpoint.table_where_clause,
            endpoint.parallel_loads, endpoint.batch_rows) == ("postgres", True, 100, "x > 1", 3, 500)
    assert endpoint.table_name("public", "t") == "`pg`.`public`.`t`"
    assert endpoint.table_name("Public", "T") == "`pg`.`public`.`t`"
    assert endpoint.new_name("Public", "T") == "`public`.`t`"
    snowflake = Endpoint(name="sf", kind="snowflake")
    assert snowflake.table_name("dw", "orders") == "`sf`.`DW`.`ORDERS`"
    assert Endpoint(kind="oracle", name="o").table_name("Dw", "t") == "`o`.`Dw`.`t`"
    assert Endpoint(catalog="ice").table_name("Dw", "t") == "`ice`.`Dw`.`t`"
    assert Endpoint().batch_rows == 1_000_000 and Endpoint().parallel_loads == 10
    with pytest.raises(ValueError):
        Endpoint.from_config("x", {"type": "abacus", "target": "dev", "outputs": {"dev": {}}})


def test_every_load_runs_and_is_logged(spark, lake, schema, make):
    prepare(make)
    result = run_project(spark, Project.from_config("p", *project(schema)))
    assert [(r.status, r.exported_rows, r.imported_rows) for r in result.results] == [
        row[2:] for row in EXPECTED]
    assert result.outcome == "Completed with errors" and result.count("ERROR") == 4
    log = RunLog(spark, lake, schema).read()
    loads = log.where("source_table IS NOT NULL").selectExpr(
        f"replace(source_table, '{schema}.')", f"replace(target_table, '{schema}.')",
        "status", "exported_rows", "imported_rows")
    assert values(loads) == sorted(EXPECTED, key=repr)
    assert values(log.where("source_table IS NULL"), "status") == [("END",), ("START",)]
    assert log.select("project", "project_started_at").distinct().count() == 1
    summary = spark.table(f"{schema}.run_log_summary").first()
    assert (summary.status, summary.completed_loads, summary.imported_rows) == ("Finished", 4, 13)
    assert values(spark.table(f"{schema}.pre_inc_suf")) == ROWS


def test_a_log_that_cannot_be_written_does_not_stop_the_loads(spark, schema, make):
    prepare(make)
    config, connections = project(schema, logdb="locked")
    connections["locked"] = {"type": "spark", "read_only": True, "target": "dev", "outputs": {"dev": {}}}
    result = run_project(spark, Project.from_config("p", config, connections))
    assert result.count("DONE") == 4


def test_a_log_that_breaks_on_the_way_takes_no_result_with_it(spark, lake, schema, make, monkeypatch):
    prepare(make)
    records = []

    def broken(self, some):
        if any(record["status"] != "START" for record in some):
            raise OSError("log is gone")
        records.extend(some)

    monkeypatch.setattr(RunLog, "log_all", broken)
    result = run_project(spark, Project.from_config("p", *project(schema)))
    assert [r["status"] for r in records] == ["START"] and result.count("DONE") == 4
    assert all("not logged" in r.message for r in result.results)


def test_many_loads_leave_few_log_files(spark, lake, schema, make):
    make("src", ROWS)
    log = RunLog(spark, lake, schema)
    log.create()
    records = ProjectLog(log)
    load = LoadSpec(schema, "copy", schema, "src", replication_method="NONE")
    for n in range(1, 13):
        run_load(spark, load, lake, lake, records, "p")
        assert log.read().count() == n  # nothing waits in the driver
    before = values(log.read())
    records.finish()
    assert values(log.read()) == before and len(log.read().inputFiles()) == 1


def test_a_record_that_fails_once_is_logged_in_the_end(spark, lake, schema, monkeypatch):
    log = RunLog(spark, lake, schema)
    log.create()
    records, write = ProjectLog(log), RunLog.log_all
    monkeypatch.setattr(RunLog, "log_all", lambda *_: 1 / 0)
    records.log(project="p", status="DONE")
    monkeypatch.setattr(RunLog, "log_all", write)
    records.finish()
    assert values(log.read(), "project", "status") == [("p", "DONE")] and not records.records


def test_options_without_effect_are_refused():
    with pytest.raises(ValueError, match="as_columnstore"):
        Endpoint.from_config("db", {"type": "sqlserver", "target": "p", "outputs": {"p": {"as_columnstore": True}}})


def test_one_load(spark, lake, schema, make):
    make("src", ROWS)
    load = LoadSpec(schema, "copy", schema, "src")
    result = run_load(spark, load, lake, lake)
    assert (result.status, result.imported_rows) == ("DONE", 5)


def test_measuring_can_be_asked_for_per_table(spark, lake, schema):
    spark.sql(f"CREATE TABLE {schema}.src AS SELECT 1 AS id, repeat('x', 4001) AS t")
    config, connections = project(schema)
    config["schemas"] = [{"source_schema": schema, "target_schema": schema, "table_suffix": "_new",
                          "tables": [{"table_name": "src", "measure_columns": True}]}]
    plan = Project.from_config("p", {**config, "queries": [], "logdb": None}, connections)
    assert run_project(spark, plan).outcome == "Completed successfully"
    assert spark.table(f"{schema}.src_new").columns == ["id"]


def test_an_empty_project_ends_well(spark, lake):
    assert run_project(spark, Project("p", lake, lake)).outcome == "Completed successfully"


def test_project_files_from_the_command_line(spark, schema, make, tmp_path, monkeypatch):
    prepare(make)
    monkeypatch.setattr(spark, "stop", lambda: None)
    config, connections = project(schema)
    (tmp_path / "Daily.yml").write_text(json.dumps(config))  # JSON is YAML
    (tmp_path / "connections.yml").write_text(json.dumps(connections))
    arguments = [str(tmp_path / "Daily"), "--connections", str(tmp_path / "connections.yml")]
    assert main(arguments) == 1
    assert spark.table(f"{schema}.pre_src_suf").count() == 5
    assert spark.table(f"{schema}.run_log").where("project = 'daily'").count() > 0
    assert main([*arguments, "--target", "small"]) == 1
    assert spark.table(f"{schema}.pre_src_suf").count() == 1
