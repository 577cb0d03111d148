"""One side of a load: a Spark catalog, or a database reached over JDBC.

Both are addressed through Spark's catalogs, so creating, renaming, appending and
reading tables is the same Spark SQL on either.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.names import qualified
from ..functions.types import database_table_ddl
from . import jdbc


class ReadOnlyEndpoint(PermissionError):
    """A write was asked of an endpoint that only allows reading."""


# Defaults of the connection options.
PARALLEL_LOADS = 10
BATCH_ROWS = 1_000_000


@dataclass(frozen=True)
class Endpoint:
    """Connection settings.

    ``kind`` is ``spark`` for a Spark catalog (``catalog`` names it; the session catalog
    when empty), or ``postgres``, ``sqlserver``, ``oracle`` or ``snowflake`` for JDBC.
    """

    name: str = "spark"
    kind: str = "spark"
    catalog: str | None = None
    read_only: bool = False
    limit_rows: int | None = None
    table_where_clause: str | None = None
    parallel_loads: int = PARALLEL_LOADS
    batch_rows: int = BATCH_ROWS
    table_format: str = "parquet"
    credentials: Mapping[str, object] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.kind != "spark" and self.kind not in jdbc.DRIVERS:
            raise ValueError(f"unknown connection type {self.kind!r}")

    @classmethod
    def from_config(cls, name: str, config: Mapping, output: str | None = None) -> Endpoint:
        """Build from a connection entry; ``output`` overrides its chosen profile."""
        credentials = dict(config["outputs"][output or config["target"]])
        if credentials.get("as_columnstore"):
            raise ValueError(f"connection {name}: as_columnstore cannot be done through Spark's catalog")
        return cls(
            name=name,
            kind=config["type"],
            catalog=credentials.get("catalog"),
            read_only=bool(config.get("read_only")),
            limit_rows=credentials.get("limit_rows"),
            table_where_clause=credentials.get("table_where_clause"),
            parallel_loads=credentials.get("table_parallel_loads", PARALLEL_LOADS),
            batch_rows=credentials.get("table_parallel_batch_size", BATCH_ROWS),
            table_format=credentials.get("table_format", "parquet"),
            credentials=credentials,
        )

    @property
    def is_jdbc(self) -> bool:
        return self.kind != "spark"

    @property
    def dialect(self) -> str:
        return self.kind

    def require_writable(self) -> None:
        """Raise before any Spark action when this endpoint is read only."""
        if self.read_only:
            raise ReadOnlyEndpoint(f"connection {self.name} is read only")

    def use(self, spark: SparkSession) -> None:
        """Make the endpoint's catalog known to the session."""
        if self.is_jdbc:
            jdbc.register_catalog(spark, self.name, self.kind, self.credentials)

    @property
    def in_session_catalog(self) -> bool:
        return not self.is_jdbc and self.catalog in (None, "spark_catalog")

    def _names(self, *names: str) -> list[str]:
        """Names as the database would read them without quotes."""
        fold = {"postgres": str.lower, "snowflake": str.upper}.get(self.kind, str)
        return [fold(name) for name in names]

    def schema_name(self, schema: str) -> str:
        return qualified(self.name if self.is_jdbc else self.catalog, *self._names(schema))

    def table_name(self, schema: str, table: str) -> str:
        return qualified(self.name if self.is_jdbc else self.catalog, *self._names(schema, table))

    def new_name(self, schema: str, table: str) -> str:
        """A name to rename to; it cannot move a table to another catalog."""
        return qualified(*self._names(schema, table))

    def table_exists(self, spark: SparkSession, schema: str, table: str) -> bool:
        self.use(spark)
        return spark.catalog.tableExists(self.table_name(schema, table))

    def read_table(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        self.use(spark)
        return spark.table(self.table_name(schema, table))

    def create_table(self, spark: SparkSession, schema: str, table: str, columns: T.StructType) -> None:
        """Create a table in a database with the type names of its own dialect: Spark's would round
        times or narrow text on some."""
        statement = database_table_ddl(*self._names(schema, table), columns, self.dialect)
        jdbc.execute(spark, self.kind, self.credentials, statement)

    def read_query(self, spark: SparkSession, query: str) -> DataFrame:
        """The user's query as it stands, run by Spark or by the database."""
        if self.is_jdbc:
            return jdbc.read_query(spark, self.kind, self.credentials, query)
        return spark.sql(query)

    def read_rows(
        self, spark: SparkSession, schema: str, table: str, predicates: list[str] | None = None
    ) -> DataFrame:
        """The rows of a table that pass the connection's own filter.

        A database gets the filter as it stands, in its own dialect. With ``predicates``
        it is asked one query for each, at most ``parallel_loads`` at a time.
        """
        where = self.table_where_clause
        if not self.is_jdbc:
            rows = self.read_table(spark, schema, table)
            return rows.where(where) if where else rows
        if not where and not predicates:
            return self.read_table(spark, schema, table)
        tasks, name = self.parallel_loads, f"{schema}.{table}"
        if predicates:
            # every task gets ranges from all over the key, so that a crowded stretch is shared
            predicates = [p for first in range(tasks) for p in predicates[first::tasks]]
        rows = jdbc.read_table(spark, self.kind, self.credentials, name, where, predicates)
        return rows.coalesce(tasks) if predicates else rows
