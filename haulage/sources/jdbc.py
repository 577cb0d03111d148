"""Options for Spark's JDBC source and its table catalog.

Drivers are not shipped; put the database's driver jar on the Spark class path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# JDBC driver classes, default ports and transfer sizes.
DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
    "snowflake": "net.snowflake.client.jdbc.SnowflakeDriver",
}
PORTS = {"postgres": 5432, "sqlserver": 1433, "oracle": 1521}
FETCH_ROWS = 5_000
WRITE_ROWS = 100_000

_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def url(kind: str, credentials: Mapping) -> str:
    """JDBC address of a connection; an explicit ``url`` wins."""
    if credentials.get("url"):
        return str(credentials["url"])
    database = credentials.get("database")
    if kind == "snowflake":
        address = f"jdbc:snowflake://{credentials['account']}.snowflakecomputing.com/?db={database}"
        extras = ("warehouse", "schema")
        return address + "".join(f"&{k}={credentials[k]}" for k in extras if credentials.get(k))
    server = f"{credentials['host']}:{credentials.get('port') or PORTS[kind]}"
    if kind == "oracle":
        return f"jdbc:oracle:thin:@//{server}/{database}"
    if kind == "sqlserver":
        trusted = ";integratedSecurity=true" if credentials.get("trusted_connection") else ""
        return f"jdbc:sqlserver://{server};databaseName={database}{trusted}"
    return f"jdbc:postgresql://{server}/{database}"


def options(kind: str, credentials: Mapping) -> dict[str, str]:
    """Options common to reading and writing."""
    chosen = {
        "url": url(kind, credentials),
        "driver": str(credentials.get("jdbc_driver") or DRIVERS[kind]),
        "fetchsize": str(FETCH_ROWS),
        "batchsize": str(WRITE_ROWS),
        "preferTimestampNTZ": "true",
    }
    if not credentials.get("trusted_connection"):
        chosen.update({k: str(credentials[k]) for k in ("user", "password") if k in credentials})
    return {**chosen, **credentials.get("jdbc_options", {})}


def register_catalog(spark: SparkSession, name: str, kind: str, credentials: Mapping) -> None:
    """Make the database a Spark catalog, with every read pushed down that can be."""
    prefix = f"spark.sql.catalog.{name}"
    if spark.conf.get(prefix, None) == _CATALOG:
        return
    pushdown = {
        f"pushDown{what}": "true"
        for what in ("Predicate", "Aggregate", "Limit", "Offset", "TableSample")
    }
    for key, value in {**options(kind, credentials), **pushdown}.items():
        spark.conf.set(f"{prefix}.{key}", value)
    spark.conf.set(prefix, _CATALOG)


def execute(spark: SparkSession, kind: str, credentials: Mapping, statement: str) -> None:
    """Run one statement in the database, from the driver."""
    chosen = options(kind, credentials)
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(chosen["driver"])
    properties = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in chosen:
            properties.setProperty(key, chosen[key])
    connection = jvm.java.sql.DriverManager.getConnection(chosen["url"], properties)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()


def read_query(spark: SparkSession, kind: str, credentials: Mapping, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options(kind, credentials)).option("query", query).load()


def table_query(table: str, where: str | None) -> str:
    """What to read of a table: all of it, or the rows a predicate of the database selects."""
    return f"(SELECT * FROM {table} WHERE {where}) q" if where else table


def read_table(
    spark: SparkSession,
    kind: str,
    credentials: Mapping,
    table: str,
    where: str | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """A table, or one partition for each predicate. Columns and filters are pushed down."""
    properties = options(kind, credentials)
    address = properties.pop("url")
    source = table_query(table, where)
    if predicates:
        return spark.read.jdbc(address, source, predicates=predicates, properties=properties)
    return spark.read.jdbc(address, source, properties=properties)
