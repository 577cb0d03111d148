"""Projects: which tables and queries to load from where to where.

Built from plain dictionaries, or from the YAML files that hold the same structure.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from .sources.endpoint import Endpoint

# The two replication methods, and the log table used unless named.
FULL_TABLE, INCREMENTAL = "FULL_TABLE", "INCREMENTAL"
LOG_SCHEMA_NAME, LOG_TABLE_NAME = "haulage", "run_log"


@dataclass(frozen=True)
class LoadSpec:
    """One load: either a source table or a query."""

    target_schema: str
    target_table: str
    source_schema: str | None = None
    source_table: str | None = None
    query_name: str | None = None
    query: str | None = None
    replication_method: str = FULL_TABLE
    replication_key: str | None = None
    parallelization_key: str | None = None
    measure_columns: bool = False

    @property
    def title(self) -> str:
        """How the load is called in messages."""
        return self.query_name or f"{self.source_schema}.{self.source_table}"

    @property
    def logged_source(self) -> str:
        return "query" if self.query else f"{self.source_schema}.{self.source_table}"

    @property
    def logged_target(self) -> str:
        return f"{self.target_schema}.{self.target_table}"


def _table_loads(config: Mapping) -> list[LoadSpec]:
    return [
        LoadSpec(
            source_schema=schema["source_schema"],
            source_table=table["table_name"],
            target_schema=schema["target_schema"],
            target_table=schema.get("table_prefix", "")
            + table["table_name"]
            + schema.get("table_suffix", ""),
            replication_method=table.get("replication_method") or FULL_TABLE,
            replication_key=table.get("replication_key"),
            parallelization_key=table.get("parallelization_key"),
            measure_columns=bool(table.get("measure_columns")),
        )
        for schema in config.get("schemas") or []
        for table in schema["tables"]
    ]


def _query_loads(config: Mapping) -> list[LoadSpec]:
    return [
        LoadSpec(
            query_name=query["query_name"],
            query=query["query"],
            target_schema=group["target_schema"],
            target_table=query["table_name"],
            replication_method=query.get("replication_method") or FULL_TABLE,
        )
        for group in config.get("queries") or []
        for query in group["queries"]
    ]


@dataclass(frozen=True)
class Project:
    """All loads of a project, tables first, then queries, in the order given."""

    name: str
    source: Endpoint
    target: Endpoint
    loads: list[LoadSpec] = field(default_factory=list)
    log_endpoint: Endpoint | None = None
    log_schema: str = LOG_SCHEMA_NAME
    log_table: str = LOG_TABLE_NAME
    parallel_loads: int = 1

    @classmethod
    def from_config(
        cls, name: str, config: Mapping, connections: Mapping, output: str | None = None
    ) -> Project:
        """Expand a project; ``output`` overrides the profile of every connection."""

        def endpoint(connection: str) -> Endpoint:
            return Endpoint.from_config(connection, connections[connection], output)

        return cls(
            name=name.lower(),
            source=endpoint(config["source"]),
            target=endpoint(config["target"]),
            loads=_table_loads(config) + _query_loads(config),
            log_endpoint=endpoint(config["logdb"]) if config.get("logdb") else None,
            log_schema=config.get("logschema", LOG_SCHEMA_NAME),
            log_table=config.get("logtable", LOG_TABLE_NAME),
            parallel_loads=config.get("parallel_loads", 1),
        )

    @classmethod
    def from_yaml(cls, project_path: str, connections_path: str, output: str | None = None) -> Project:
        """The same from files; the project is named after its file."""
        import yaml

        path = Path(project_path)
        path = path if path.suffix.lower() == ".yml" else path.with_name(path.name + ".yml")
        config = yaml.safe_load(path.read_text(encoding="utf-8"))
        connections = yaml.safe_load(Path(connections_path).read_text(encoding="utf-8"))
        return cls.from_config(path.stem, config, connections, output)
