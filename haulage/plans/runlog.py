"""The run log: one row per load and two per project run, with summary and detail views."""

from __future__ import annotations

import logging
import threading
import uuid
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from ..functions.timing import duration_text, second_boundaries, throughput
from ..sources.endpoint import Endpoint
from ..sources.files import delete_folder, folder_exists, listed, rename_folder
from ..status import DONE, ERROR, WARN, WITH_ERRORS, WITH_WARNINGS, WITHOUT_FAULT

logger = logging.getLogger(__name__)

# Names, order and types of the log columns.
LOG_SCHEMA = T.StructType([
    T.StructField("log_time", T.TimestampNTZType()),
    T.StructField("project", T.StringType()),
    T.StructField("project_started_at", T.TimestampNTZType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("exported_rows", T.LongType()),
    T.StructField("imported_rows", T.LongType()),
])

_DAY = "cast(cast(project_started_at as date) as string)"
_ENDED = "max(CASE WHEN upper(status) = 'END' THEN 1 ELSE 0 END) = 1"

# Expressions of the two views, by column name. The summary groups by its first three.
SUMMARY = {
    "project_started_date": _DAY,
    "project_started_at": "project_started_at",
    "project": "project",
    "status": f"CASE WHEN {_ENDED} THEN 'Finished' ELSE 'Running or failed' END",
    "completed_loads": "count_if(source_table IS NOT NULL AND status = 'DONE')",
    "ended_at": f"CASE WHEN {_ENDED} THEN max(ended_at) END",
    "duration": duration_text("min(project_started_at)", "max(ended_at)"),
    "exported_rows": "sum(exported_rows)",
    "imported_rows": "sum(imported_rows)",
    "loaded_rows_per_sec": "sum(imported_rows) div nullif("
    + second_boundaries("min(project_started_at)", "max(ended_at)")
    + ", 0L)",
}
DETAILS = {
    "project_started_date": _DAY,
    "project_started_at": "project_started_at",
    "project": "project",
    "source_table": "source_table",
    "target_table": "target_table",
    "started_at": "substring(cast(started_at as string), 1, 19)",
    "ended_at": "substring(cast(ended_at as string), 1, 19)",
    "duration": duration_text("started_at", "ended_at"),
    "status": "status",
    "exported_rows": "exported_rows",
    "imported_rows": "imported_rows",
    "loaded_rows_per_sec": "imported_rows div nullif("
    + second_boundaries("started_at", "ended_at")
    + ", 0L)",
}
_GROUP = list(SUMMARY)[:3]


def summary(log: DataFrame) -> DataFrame:
    """One row per project run: outcome, loads completed, duration, rows and rows per second."""
    measures = [F.expr(e).alias(n) for n, e in SUMMARY.items() if n not in _GROUP]
    return log.groupBy(*(F.expr(SUMMARY[n]).alias(n) for n in _GROUP)).agg(*measures)


def details(log: DataFrame) -> DataFrame:
    """One row per load, with times as text."""
    loads = log.where("source_table IS NOT NULL")
    return loads.select(*(F.expr(e).alias(n) for n, e in DETAILS.items()))


def outcomes(log: DataFrame) -> DataFrame:
    """Loads by status, and the outcome of the whole: errors outweigh warnings."""
    counts = log.agg(
        F.count_if(F.col("status") == DONE).alias("successes"),
        F.count_if(F.col("status") == WARN).alias("warnings"),
        F.count_if(F.col("status") == ERROR).alias("errors"),
    )
    overall = (
        F.when(F.col("errors") > 0, WITH_ERRORS)
        .when(F.col("warnings") > 0, WITH_WARNINGS)
        .otherwise(WITHOUT_FAULT)
    )
    return counts.withColumn("outcome", overall)


def load_throughput(log: DataFrame) -> DataFrame:
    """Imported rows per second of every load, from its exact elapsed time."""
    rate = F.expr(throughput("imported_rows", "started_at", "ended_at")).alias("rows_per_sec")
    return log.where("source_table IS NOT NULL").select(
        "project", "source_table", "started_at", "imported_rows", rate
    )


# Two inserts into one table of files must not commit at the same time.
_appending: dict[str, threading.Lock] = {}
# Formats whose logs have a folder for every append, and what makes Spark read those.
FOLDERED = {"parquet", "orc"}
RECURSIVE = "recursiveFileLookup"
# Names of a run's records as one file, and of those it replaces. Readers pass over names with an underscore.
MERGED, REPLACED = "_merged-", "_replaced-"
# Appends of a run beyond which its records are put together at its end.
FEW = 8


@dataclass(frozen=True)
class RunLog:
    """The log table of an endpoint.

    In Spark's own catalog every append writes a folder of its own below that of its ``run``, so writers of any number
    of drivers commit without each other, and what a lost one had appended stays. Databases and table formats have
    commits of their own. A log that was made without such folders takes one append at a time.
    """

    spark: SparkSession
    endpoint: Endpoint
    schema: str = "haulage"
    table: str = "run_log"
    run: str | None = None

    @property
    def name(self) -> str:
        return self.endpoint.table_name(self.schema, self.table)

    def create(self) -> None:
        """Create the table when absent, and its two views."""
        self.endpoint.require_writable()
        self.endpoint.use(self.spark)
        using = "" if self.endpoint.is_jdbc else f" USING {self.endpoint.table_format}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOG_SCHEMA)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.endpoint.schema_name(self.schema)}")
        foldered = self.endpoint.in_session_catalog and self.endpoint.table_format in FOLDERED
        options = f" OPTIONS ({RECURSIVE} 'true')" if foldered else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}){using}{options}")
        self._complete_merges()
        if self.endpoint.in_session_catalog:
            try:
                self._create_views()
            except AnalysisException:  # the default catalog may be one that holds no views
                logger.warning("no views were made for %s", self.name)

    def _create_views(self) -> None:
        def listed(expressions: dict[str, str]) -> str:
            return ", ".join(f"{e} AS {n}" for n, e in expressions.items())

        groups = ", ".join(SUMMARY[n] for n in _GROUP)
        views = {
            "_summary": f"SELECT {listed(SUMMARY)} FROM {self.name} GROUP BY {groups}",
            "_details": f"SELECT {listed(DETAILS)} FROM {self.name} WHERE source_table IS NOT NULL",
        }
        for ending, query in views.items():
            view = self.endpoint.table_name(self.schema, self.table + ending)
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")

    def append(self, records: DataFrame) -> None:
        """Append records; columns are matched by name and absent ones are NULL."""
        self.endpoint.require_writable()
        given = set(records.columns)
        ordered = records.select(*(
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LOG_SCHEMA
        ))
        folder, written_as = self._folder()
        if folder is None:
            with _appending.setdefault(self.name, threading.Lock()):
                ordered.write.insertInto(self.name)
            return
        run = self.run or f"run-{uuid.uuid4().hex}"
        ordered.write.format(written_as).save(f"{folder}/{run}/{uuid.uuid4().hex}")
        self.spark.catalog.refreshTable(self.name)

    def _folder(self) -> tuple[str | None, str]:
        """Folder of a table that is read with all the folders in it, and its format."""
        if not self.endpoint.in_session_catalog:
            return None, ""
        facts = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()}
        foldered = f"{RECURSIVE}=true" in facts.get("Storage Properties", "")
        return facts["Location"] if foldered else None, facts.get("Provider", "")

    def merge(self) -> None:
        """Put the records of the run into one file, if it has more than a few.

        The file is written under a name that readers pass over; then two folders are renamed. A driver lost
        in between leaves the rest to the next ``create``.
        """
        folder, written_as = self._folder()
        if folder is None or self.run is None:
            return
        if len(listed(self.spark, f"{folder}/{self.run}")) <= FEW:
            return
        records = self.spark.read.schema(LOG_SCHEMA).format(written_as).option(RECURSIVE, "true")
        records.load(f"{folder}/{self.run}").coalesce(1).write.format(written_as).save(f"{folder}/{MERGED}{self.run}")
        if rename_folder(self.spark, f"{folder}/{self.run}", f"{folder}/{REPLACED}{self.run}"):
            self._complete_merges()

    def _complete_merges(self) -> None:
        """Bring merged records to their run's name, and delete what they replace.

        Whichever driver does a step, none undoes one: a name is only given to what has been written whole, and
        records are only deleted when the merged ones have their name.
        """
        folder, _ = self._folder()
        if folder is None:
            return
        for name in listed(self.spark, folder):
            if name.startswith(REPLACED):
                run = name.removeprefix(REPLACED)
                if not folder_exists(self.spark, f"{folder}/{run}"):
                    rename_folder(self.spark, f"{folder}/{MERGED}{run}", f"{folder}/{run}")
                if folder_exists(self.spark, f"{folder}/{run}"):
                    delete_folder(self.spark, f"{folder}/{name}")
        self.spark.catalog.refreshTable(self.name)

    def log(self, **fields) -> None:
        """Append one record, stamped with the current time."""
        self.log_all([{"log_time": datetime.now(), **fields}])

    def log_all(self, records: list[dict]) -> None:
        """Append some records in one write, so that they share a file."""
        # constants only: no Python worker is started, and times stay as they are given
        rows = [F.struct(*(
            F.lit(None if record.get(f.name) is None else str(record[f.name])).cast(f.dataType).alias(f.name)
            for f in LOG_SCHEMA
        )) for record in records]
        self.append(self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows))))

    def read(self) -> DataFrame:
        self.endpoint.use(self.spark)
        if self.endpoint.in_session_catalog:
            self.spark.catalog.refreshTable(self.name)  # other drivers append too
        return self.spark.table(self.name)


class ProjectLog:
    """Records of one run, each appended as it comes.

    One that cannot be written is kept and tried again at the end of the run.
    """

    def __init__(self, log: RunLog):
        self.target = replace(log, run=f"run-{uuid.uuid4().hex}")
        self.records: list[dict] = []

    def log(self, **fields) -> None:
        record = {"log_time": datetime.now(), **fields}
        try:
            self.target.log_all([record])
        except Exception:
            logger.exception("a record could not be logged")
            self.records.append(record)

    def finish(self) -> None:
        """Try again what could not be written, and put the run's records together."""
        try:
            if self.records:
                self.target.log_all(self.records)
                self.records = []
            self.target.merge()
        except Exception:
            logger.exception("%d records could not be logged", len(self.records))
