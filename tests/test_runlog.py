import threading
from dataclasses import replace
from datetime import datetime
from pathlib import Path
from urllib.parse import urlparse

import pytest

from tables import values
from haulage import RunLog
from haulage.plans import runlog

START = datetime(2024, 3, 9, 23, 0, 0)


def at(hour, minute=0, second=0, micro=0, day=10):
    return datetime(2024, 3, day, hour, minute, second, micro)


def record(source, started, ended, status, exported=None, imported=None, project="p"):
    return (datetime(2024, 3, 10), project, START, source, source and "t." + source, started, ended,
            status, exported, imported)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), runlog.LOG_SCHEMA)


def test_append_gives_one_row(spark, lake, schema):
    log = RunLog(spark, lake, schema)
    log.create()
    log.create()  # keeps what is there
    log.log(project="p", status="START", started_at=START)
    row = log.read().first()
    assert (row.project, row.status, row.started_at, row.source_table) == ("p", "START", START, None)
    assert row.log_time is not None and log.read().count() == 1
    log.append(log.read().select("status", "project"))
    assert log.read().where("log_time IS NULL AND status = 'START'").count() == 1


def test_concurrent_records_are_all_kept(spark, lake, schema):
    log = RunLog(spark, lake, schema)
    log.create()
    threads = [threading.Thread(target=lambda i=i: log.log(project=f"p{i}", status="DONE")) for i in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert log.read().select("project").distinct().count() == 8


def place(spark, log) -> Path:
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {log.name}").collect()}
    return Path(urlparse(facts["Location"]).path)


def test_a_run_that_is_killed_leaves_its_records_and_stops_no_other(spark, lake, schema):
    killed, other = (RunLog(spark, lake, schema, run=f"run-{i}") for i in "ab")
    killed.create()
    for i in range(3):
        killed.log(project="a", status=f"S{i}")
    half = place(spark, killed) / "run-a" / "half" / "_temporary" / "0"  # an append that never commits
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half a file")
    other.log(project="b", status="DONE")
    other.create()
    assert values(other.read(), "project", "status") == [("a", "S0"), ("a", "S1"), ("a", "S2"), ("b", "DONE")]
    assert half.exists()


def test_two_runs_write_and_merge_side_by_side(spark, lake, schema):
    RunLog(spark, lake, schema).create()
    logs = [RunLog(spark, lake, schema, run=f"run-{i}") for i in range(2)]

    def work(log):
        for i in range(10):
            log.log(project=log.run, status=str(i))
        log.merge()

    failed = []

    def watched(log):
        try:
            work(log)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=watched, args=(log,)) for log in logs]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    expected = sorted((log.run, str(i)) for log in logs for i in range(10))
    assert values(logs[0].read(), "project", "status") == expected
    assert len(logs[0].read().inputFiles()) == 2


@pytest.mark.parametrize("step", ["before", "between", "after"])
def test_a_merge_cut_short_is_completed(spark, lake, schema, monkeypatch, step):
    """The driver is lost before, between or after the two renames."""
    log = RunLog(spark, lake, schema, run="run-a")
    log.create()
    for i in range(10):
        log.log(project="a", status=str(i))
    before, folder = values(log.read()), place(spark, log)
    with monkeypatch.context() as lost:
        if step == "before":
            lost.setattr(runlog, "rename_folder", lambda *_: False)
        elif step == "between":
            lost.setattr(RunLog, "_complete_merges", lambda _: None)
        else:
            lost.setattr(runlog, "delete_folder", lambda *_: None)
        log.merge()
    if step == "between":
        assert not (folder / "run-a").exists()
    replace(log, run="run-b").create()
    assert values(log.read()) == before
    assert not (folder / "_replaced-run-a").exists()


def test_a_log_without_folders_goes_on(spark, lake, schema):
    log = RunLog(spark, lake, schema, run="run-a")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runlog.LOG_SCHEMA)
    spark.sql(f"CREATE TABLE {log.name} ({columns}) USING parquet")
    log.create()
    log.log(project="a", status="DONE")
    log.merge()
    assert values(log.read(), "project", "status") == [("a", "DONE")]


def test_summary(spark):
    log = frame(
        spark,
        record(None, START, None, "START"),
        record("a", at(0), at(1), "DONE", 10, 9),
        record("b", at(0), at(1, 30), "ERROR", 5, 0),
        record("c", at(0), at(2), "WARN", 7, 6),
        record(None, None, at(2, 0, 1, 999999), "End"),
        record("a", at(0), at(1), "DONE", 3, 3, project="q"),
    )
    found = {r.project: r for r in runlog.summary(log).collect()}
    p, q = found["p"], found["q"]
    assert (p.project_started_date, p.status, p.completed_loads) == ("2024-03-09", "Finished", 1)
    assert (p.duration, p.ended_at) == ("03:00:01", at(2, 0, 1, 999999))
    assert (p.exported_rows, p.imported_rows, p.loaded_rows_per_sec) == (22, 15, 0)
    assert (q.status, q.ended_at, q.duration) == ("Running or failed", None, "02:00:00")


def test_durations_wrap_after_a_day_and_rates_count_boundaries(spark):
    log = frame(
        spark,
        record("a", at(0, 0, 0, 999999), at(0, 0, 1, 0), "DONE", 8, 8),
        record("b", at(0, 0, 1, 0), at(0, 0, 1, 999999), "DONE", 8, 8),
        record("c", at(0, day=10), at(1, 2, 3, day=11), "DONE", 8, 90123 * 7 + 1),
        record("d", at(0), None, "RUN", 8, 8),
    )
    found = {r.source_table: r for r in runlog.details(log).collect()}
    assert (found["a"].duration, found["a"].loaded_rows_per_sec) == ("00:00:00", 8)
    assert (found["b"].duration, found["b"].loaded_rows_per_sec) == ("00:00:00", None)
    assert (found["c"].duration, found["c"].loaded_rows_per_sec) == ("01:02:03", 7)
    assert (found["d"].ended_at, found["d"].loaded_rows_per_sec) == (None, None)
    assert found["a"].started_at == "2024-03-10 00:00:00" and found["c"].ended_at == "2024-03-11 01:02:03"


def test_the_session_zone_does_not_shift_times(spark):
    log = frame(spark, record("a", at(1, 30), at(3, 30), "DONE", 8, 7200))  # across a clock change
    before = values(runlog.details(log))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(runlog.details(log)) == before
        assert runlog.details(log).first().duration == "02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_throughput_uses_exact_time(spark):
    log = frame(
        spark,
        record("a", at(0), at(0, 0, 0, 500000), "DONE", 8, 7),
        record("b", at(0), at(0), "DONE", 8, 7),
        record("c", at(0), at(0, 0, 3), "DONE", 8, 8),
    )
    found = {r.source_table: r.rows_per_sec for r in runlog.load_throughput(log).collect()}
    assert found == {"a": 14, "b": None, "c": 2}


def test_outcomes(spark):
    def outcome(*statuses):
        rows = [record("a", at(0), at(1), s, 1, 1) for s in statuses]
        return tuple(runlog.outcomes(frame(spark, *rows)).first())

    assert outcome("DONE", "START") == (1, 0, 0, "Completed successfully")
    assert outcome("DONE", "WARN") == (1, 1, 0, "Completed with warnings")
    assert outcome("DONE", "WARN", "ERROR", "ERROR") == (1, 1, 2, "Completed with errors")
    assert outcome() == (0, 0, 0, "Completed successfully")


def test_views_give_the_same_rows(spark, lake, schema):
    log = RunLog(spark, lake, schema)
    log.create()
    log.append(frame(spark, record("a", at(0), at(1), "DONE", 10, 9), record(None, None, at(2), "END")))
    assert values(spark.table(f"{schema}.run_log_summary")) == values(runlog.summary(log.read()))
    assert values(spark.table(f"{schema}.run_log_details")) == values(runlog.details(log.read()))
