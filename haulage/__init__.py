"""Extract-load jobs on Spark: move tables and query results between catalogs and databases."""

from .config import LoadSpec, Project
from .plans.project import ProjectResult, run_load, run_project
from .plans.runlog import RunLog
from .plans.strategies import (
    LoadResult,
    load_delimited,
    load_full_query,
    load_full_table,
    load_incremental,
)
from .sources.endpoint import Endpoint, ReadOnlyEndpoint

__all__ = [
    "Endpoint",
    "LoadResult",
    "LoadSpec",
    "Project",
    "ProjectResult",
    "ReadOnlyEndpoint",
    "RunLog",
    "load_delimited",
    "load_full_query",
    "load_full_table",
    "load_incremental",
    "run_load",
    "run_project",
]
