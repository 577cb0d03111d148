"""Running one load, and all loads of a project side by side in one session."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from ..config import FULL_TABLE, INCREMENTAL, LoadSpec, Project
from ..sources.endpoint import Endpoint
from ..status import END, ERROR, START, WARN, WITH_ERRORS, WITH_WARNINGS, WITHOUT_FAULT
from .runlog import ProjectLog, RunLog
from .strategies import LoadResult, load_full_query, load_full_table, load_incremental

logger = logging.getLogger(__name__)


def _load(spark: SparkSession, load: LoadSpec, source: Endpoint, target: Endpoint) -> LoadResult:
    """Pick the strategy and run it."""
    if load.replication_method not in (FULL_TABLE, INCREMENTAL):
        return LoadResult(ERROR, message="unknown replication method")
    if load.query:
        if load.replication_method == INCREMENTAL:
            return LoadResult(ERROR, message="a query cannot be loaded incrementally")
        return load_full_query(
            spark, source, load.query, target, load.target_schema, load.target_table
        )
    if not source.table_exists(spark, load.source_schema, load.source_table):
        return LoadResult(ERROR, message="the source has no such table")
    ends = (source, load.source_schema, load.source_table,
            target, load.target_schema, load.target_table)
    options = dict(parallelization_key=load.parallelization_key,
                   measure_columns=load.measure_columns)
    if load.replication_method == FULL_TABLE:
        return load_full_table(spark, *ends, **options)
    return load_incremental(spark, *ends, replication_key=load.replication_key, **options)


def _logged(log: RunLog | ProjectLog, result: LoadResult, **record) -> LoadResult:
    """Append a record. A log that fails never takes a result with it; the result says so."""
    try:
        log.log(**record)
    except Exception as error:
        logger.exception("a record could not be logged")
        message = "; ".join(filter(None, (result.message, f"not logged: {type(error).__name__}")))
        return replace(result, message=message)
    return result


def run_load(
    spark: SparkSession,
    load: LoadSpec,
    source: Endpoint,
    target: Endpoint,
    log: RunLog | ProjectLog | None = None,
    project: str | None = None,
    project_started_at: datetime | None = None,
) -> LoadResult:
    """Run one load and log it, whatever its outcome."""
    started_at = datetime.now()
    spark.sparkContext.setJobDescription(load.title)
    # with the FAIR scheduler every load gets its share of the cluster
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", load.logged_target)
    try:
        result = _load(spark, load, source, target)
    except Exception as error:
        logger.exception("load %s failed", load.title)
        result = LoadResult(ERROR, message=f"{type(error).__name__}: {error}")
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        spark.sparkContext.setJobDescription(None)
    ended_at = datetime.now()
    seconds = (ended_at - started_at).total_seconds()
    rate = int(result.imported_rows / seconds) if seconds else 0
    logger.info("%s %s: %d rows in %.2fs at %d rows/sec %s", result.status, load.title,
                result.imported_rows, seconds, rate, result.message)
    if log is not None:
        result = _logged(
            log, result,
            project=project,
            project_started_at=project_started_at,
            source_table=load.logged_source,
            target_table=load.logged_target,
            started_at=started_at,
            ended_at=ended_at,
            status=result.status,
            exported_rows=result.exported_rows,
            imported_rows=result.imported_rows,
        )
    return result


@dataclass(frozen=True)
class ProjectResult:
    """Results of a project's loads, in their order."""

    results: list[LoadResult]

    def count(self, status: str) -> int:
        return sum(result.status == status for result in self.results)

    @property
    def outcome(self) -> str:
        if self.count(ERROR):
            return WITH_ERRORS
        return WITH_WARNINGS if self.count(WARN) else WITHOUT_FAULT


def _started_log(spark: SparkSession, project: Project, started_at: datetime) -> ProjectLog | None:
    """The project's log with its START record; a log that cannot be written is done without."""
    if project.log_endpoint is None:
        return None
    log = RunLog(spark, project.log_endpoint, project.log_schema, project.log_table)
    try:
        log.create()
        records = ProjectLog(log)
        records.target.log(project=project.name, project_started_at=started_at, started_at=started_at,
                           status=START)
    except Exception:
        logger.exception("project %s runs without its log", project.name)
        return None
    return records


def run_project(spark: SparkSession, project: Project) -> ProjectResult:
    """Run every load, ``parallel_loads`` at a time; a failing one does not stop the others.

    The threads only submit Spark jobs; all of them share the session's executors.
    """
    started_at = datetime.now()
    log = _started_log(spark, project, started_at)

    @inheritable_thread_target(spark)
    def run(load: LoadSpec) -> LoadResult:
        return run_load(spark, load, project.source, project.target, log, project.name, started_at)

    workers = max(1, min(project.parallel_loads, len(project.loads)))
    with ThreadPoolExecutor(workers) as pool:
        results = list(pool.map(run, project.loads))
    if log is not None:
        log.log(project=project.name, project_started_at=started_at, ended_at=datetime.now(), status=END)
        log.finish()
        lost = {record.get("target_table") for record in log.records}
        results = [
            replace(r, message="; ".join(filter(None, (r.message, "not logged")))) if l.logged_target in lost else r
            for r, l in zip(results, project.loads)
        ]
    result = ProjectResult(results)
    logger.info("%s: %s", project.name, result.outcome)
    return result
