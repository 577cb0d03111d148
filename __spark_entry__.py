"""

Every query reads whole tables of the given folder through the library's own
operators, and loads into a schema of its own in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage import Endpoint, LoadSpec, Project, RunLog, run_load, run_project
from haulage.functions.text import WHITESPACE, spool_text, strip_nul
from haulage.functions.types import cast_for_target, describe
from haulage.operators.extract import (
    drop_unsupported_columns,
    extract,
    in_ranges,
)
from haulage.operators.profile import (
    batch_row_counts,
    high_water,
    key_max,
    key_min_max,
    key_min_max_batch,
    key_ranges,
    query_columns,
    table_columns,
)
from haulage.operators.publish import (
    append_and_drop,
    create_staging,
    create_table,
    create_table_from_columns,
    import_delimited,
    insert,
    swap_table,
    truncate_table,
)
from haulage.operators.rows import normalise_text_rows
from haulage.plans import runlog
from haulage.plans.strategies import load_full_query, load_full_table, load_incremental
from haulage.scratch import fresh_schema, shared_folder
from haulage.sources.delimited import export_delimited, read_delimited
from haulage.sources.files import register_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()

SMOKE_DIR = "/root/testdata/sf0.001"
LAKE = Endpoint()

REVENUE_BY_NATION = """
    SELECT n.n_name AS nation, count(*) AS orders,
           CAST(sum(CAST(o.o_totalprice AS decimal(18,2))) AS decimal(28,2)) AS revenue
    FROM {s}orders o
    JOIN {s}customer c ON o.o_custkey = c.c_custkey
    JOIN {s}nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY n.n_name
"""
SEED_DATE = "1999-01-01"
PRICED_ITEMS = """
    SELECT l_orderkey, l_linenumber, l_returnflag,
           CAST(l_extendedprice AS decimal(12,2)) AS price, l_shipdate
    FROM {s}lineitem
"""


def _source(spark: SparkSession, sf_dir: str) -> str:
    """Schema whose tables are the folder's Parquet files."""
    schema = "src_" + hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    if not spark.catalog.tableExists(f"{schema}.{TABLES[-1]}"):
        register_parquet(spark, schema, sf_dir, TABLES, f"{shared_folder(spark)}/haulage/{schema}")
    return schema


def _target(spark: SparkSession) -> str:
    return fresh_schema(spark, "tgt")[0]


def _table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return LAKE.read_table(spark, _source(spark, sf_dir), table)


def _done(result) -> None:
    if result.status != "DONE":
        raise RuntimeError(f"load ended with {result}")


# --- extraction -----------------------------------------------------------------------


def q_extract_table(spark, sf_dir):
    items = _table(spark, sf_dir, "lineitem")
    return extract(items, [column.name for column in describe(items.schema)])


def q_extract_query(spark, sf_dir):
    query = REVENUE_BY_NATION.format(s=_source(spark, sf_dir) + ".")
    return LAKE.read_query(spark, query)


def q_extract_where(spark, sf_dir):
    return extract(_table(spark, sf_dir, "orders"), where="o_orderstatus = 'F'")


def q_drop_unsupported_columns(spark, sf_dir):
    return drop_unsupported_columns(_table(spark, sf_dir, "documents"), measure=True)


def _seed_mark(orders: DataFrame):
    return high_water(orders.where(f"o_orderdate <= timestamp_ntz '{SEED_DATE}'"), "o_orderdate")


def q_extract_high_water(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    mark = _seed_mark(orders)
    return extract(orders, high_water=mark)


def q_extract_conjunction(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    second_range = key_ranges(orders, "o_orderkey", 1000).predicates()[1]
    columns = ["o_orderkey", "o_custkey", "o_orderdate"]
    rows = orders.where(second_range)
    return extract(rows, columns, _seed_mark(orders), "o_totalprice > 100000")


def q_extract_limit(spark, sf_dir):
    limited = extract(_table(spark, sf_dir, "orders"), limit=100)
    return limited.agg(F.count(F.lit(1)).alias("row_count"))


def q_extract_range_batches(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return in_ranges(orders, key_ranges(orders, "o_orderkey", 1000))


def q_strip_nul_bytes(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    dirty = F.concat(F.char(F.lit(0)), "event_type", F.char(F.lit(0)), "props")
    return events.select("event_id", strip_nul(dirty).alias("text"))


def q_render_text_formats(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return events.select(*(spool_text(F.col(f.name), f.dataType).alias(f.name) for f in events.schema))


# --- staging and publishing -----------------------------------------------------------


def q_create_table_from_columns(spark, sf_dir):
    customers, schema = _table(spark, sf_dir, "customer"), _target(spark)
    create_table_from_columns(spark, LAKE, schema, "customer", describe(customers.schema))
    insert(customers, LAKE.table_name(schema, "customer"))
    return LAKE.read_table(spark, schema, "customer")


def q_export_delimited(spark, sf_dir):
    items, (_, folder) = _table(spark, sf_dir, "lineitem"), fresh_schema(spark, "stage")
    export_delimited(items, f"{folder}/lineitem")
    return read_delimited(spark, f"{folder}/lineitem", items.schema)


def q_import_delimited(spark, sf_dir):
    documents, (schema, folder) = _table(spark, sf_dir, "documents"), fresh_schema(spark, "stage")
    export_delimited(documents, f"{folder}/files/documents")
    create_table(spark, LAKE, schema, "documents", documents.schema)
    import_delimited(spark, f"{folder}/files/documents", LAKE, schema, "documents")
    return LAKE.read_table(spark, schema, "documents")


def q_import_skip_bad_rows(spark, sf_dir):
    orders, (schema, folder) = _table(spark, sf_dir, "orders"), fresh_schema(spark, "stage")
    key = F.when(F.col("o_custkey") % 10 == 3, "no number").otherwise(F.col("o_orderkey").cast("string"))
    export_delimited(orders.withColumn("o_orderkey", key), f"{folder}/files/orders")
    create_table(spark, LAKE, schema, "orders", orders.schema)
    import_delimited(spark, f"{folder}/files/orders", LAKE, schema, "orders", skip_bad_rows=True)
    return LAKE.read_table(spark, schema, "orders")


def q_normalise_text_rows(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").withColumn("is_long", F.col("n_chars") > 500)
    return normalise_text_rows(documents)


def q_swap_table(spark, sf_dir):
    orders, schema = _table(spark, sf_dir, "orders"), _target(spark)
    create_table(spark, LAKE, schema, "orders", orders.schema)
    create_staging(spark, LAKE, schema, "orders_tmp", orders.schema)
    for table, rows in (("orders", orders.where("o_orderstatus = 'F'")), ("orders_tmp", orders)):
        insert(rows, LAKE.table_name(schema, table))
    swap_table(spark, LAKE, schema, "orders", "orders_tmp")
    return LAKE.read_table(spark, schema, "orders")


def q_append_and_drop(spark, sf_dir):
    events, schema = _table(spark, sf_dir, "events"), _target(spark)
    for table, rows in (("events", "event_type = 'click'"), ("events_tmp", "event_type <> 'click'")):
        create_table(spark, LAKE, schema, table, events.schema)
        insert(events.where(rows), LAKE.table_name(schema, table))
    append_and_drop(spark, LAKE, schema, "events", "events_tmp")
    return LAKE.read_table(spark, schema, "events")


def q_truncate_table(spark, sf_dir):
    orders, schema = _table(spark, sf_dir, "orders"), _target(spark)
    create_table(spark, LAKE, schema, "orders", orders.schema)
    before = insert(orders, LAKE.table_name(schema, "orders")).rows
    truncate_table(spark, LAKE, schema, "orders")
    after = LAKE.read_table(spark, schema, "orders")
    return after.agg(F.lit(before).cast("bigint").alias("rows_before"),
                     F.count(F.lit(1)).alias("rows_after"))


# --- schema and key profiles ----------------------------------------------------------


def q_table_columns(spark, sf_dir):
    return table_columns(_table(spark, sf_dir, "documents"))


def q_query_columns(spark, sf_dir):
    return query_columns(spark, PRICED_ITEMS.format(s=_source(spark, sf_dir) + "."))


def q_cast_for_target(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("int").alias("user_id"),
        (F.col("event_type") == "error").alias("is_error"),
        "value",
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.col("ts").cast("date").alias("day"),
        (F.col("ts") - F.col("ts").cast("date").cast("timestamp_ntz")).alias("clock"),
        "ts",
        "event_type",
    )
    return cast_for_target(events, "sqlserver")


def q_key_max(spark, sf_dir):
    return key_max(_table(spark, sf_dir, "orders"), "o_orderdate")


def q_key_min_max(spark, sf_dir):
    return key_min_max(_table(spark, sf_dir, "events"), "ts")


def q_key_min_max_batch(spark, sf_dir):
    return key_min_max_batch(_table(spark, sf_dir, "orders"), "o_orderkey", 1000)


def q_batch_row_counts(spark, sf_dir):
    items = _table(spark, sf_dir, "lineitem")
    return batch_row_counts(items, key_ranges(items, "l_orderkey", 1000))


# --- load strategies ------------------------------------------------------------------


def q_load_full_table(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    _done(load_full_table(spark, LAKE, source, "orders", LAKE, target, "orders"))
    return LAKE.read_table(spark, target, "orders")


def q_load_full_query(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    query = REVENUE_BY_NATION.format(s=source + ".")
    _done(load_full_query(spark, LAKE, query, LAKE, target, "revenue"))
    return LAKE.read_table(spark, target, "revenue")


def q_load_incremental(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    seed = f"SELECT * FROM {source}.orders WHERE o_orderdate <= timestamp_ntz '{SEED_DATE}'"
    _done(load_full_query(spark, LAKE, seed, LAKE, target, "orders"))
    _done(load_incremental(spark, LAKE, source, "orders", LAKE, target, "orders",
                           replication_key="o_orderdate"))
    return LAKE.read_table(spark, target, "orders")


def q_load_incremental_bootstrap(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    for _ in range(2):  # the second run finds nothing newer
        _done(load_incremental(spark, LAKE, source, "events", LAKE, target, "events",
                               replication_key="event_id"))
    return LAKE.read_table(spark, target, "events")


def q_load_range_parallel(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    result = load_full_table(spark, Endpoint(batch_rows=1000), source, "lineitem", LAKE, target, "lineitem",
                             parallelization_key="l_orderkey")
    _done(result)
    if len(result.batch_rows) < 2 or sum(result.batch_rows) != result.imported_rows:
        raise RuntimeError(f"ranges {result.batch_rows} of {result.imported_rows} rows")
    return LAKE.read_table(spark, target, "lineitem")


# --- project runs and the run log -----------------------------------------------------


def _logged_loads(log: RunLog) -> DataFrame:
    bare = F.substring_index
    return log.read().where("source_table IS NOT NULL").select(
        bare("source_table", ".", -1).alias("source_table"),
        bare("target_table", ".", -1).alias("target_table"),
        "status", "exported_rows", "imported_rows",
    )


def q_run_load(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    log = RunLog(spark, LAKE, target)
    log.create()
    for table in ("lineitem", "orders"):
        load = LoadSpec(source_schema=source, source_table=table,
                        target_schema=target, target_table=f"pre_{table}")
        run_load(spark, load, LAKE, LAKE, log, "one by one")
    return _logged_loads(log)


def q_run_project(spark, sf_dir):
    source, target = _source(spark, sf_dir), _target(spark)
    connections = {"lake": {"type": "spark", "outputs": {"dev": {}}, "target": "dev"}}
    config = {
        "source": "lake", "target": "lake", "logdb": "lake", "logschema": target,
        "parallel_loads": 4,
        "schemas": [{
            "source_schema": source, "target_schema": target, "table_suffix": "_copy",
            "tables": [
                {"table_name": "lineitem", "parallelization_key": "l_orderkey"},
                {"table_name": "orders", "replication_method": "INCREMENTAL",
                 "replication_key": "o_orderdate"},
                {"table_name": "customer"},
                {"table_name": "events", "replication_method": "INCREMENTAL",
                 "replication_key": "no_such_column"},
                {"table_name": "no_such_table"},
            ],
        }],
        "queries": [{"target_schema": target, "queries": [{
            "query_name": "revenue", "table_name": "revenue",
            "query": REVENUE_BY_NATION.format(s=source + "."),
        }]}],
    }
    run_project(spark, Project.from_config("Daily", config, connections))
    return _logged_loads(RunLog(spark, LAKE, target))


def _event_log(spark, sf_dir):
    """A run log in which every event is a load or, one in ten, the end of a run."""
    return _table(spark, sf_dir, "events").selectExpr(
        "ts AS log_time",
        "concat('p', user_id % 5) AS project",
        "cast(cast(ts AS date) AS timestamp_ntz) AS project_started_at",
        "CASE WHEN event_id % 10 <> 0 THEN event_type END AS source_table",
        "CASE WHEN event_id % 10 <> 0 THEN concat('t_', event_type) END AS target_table",
        "ts AS started_at",
        "ts + make_dt_interval(0, 0, 0, (event_id % 90) * 1.377123) AS ended_at",
        "CASE WHEN event_id % 10 = 0 THEN 'END' WHEN event_id % 7 = 0 THEN 'ERROR'"
        " WHEN event_id % 13 = 0 THEN 'WARN' ELSE 'DONE' END AS status",
        "event_id % 1000 AS exported_rows",
        "event_id % 900 AS imported_rows",
    )


def q_run_log_append(spark, sf_dir):
    log = RunLog(spark, LAKE, _target(spark))
    log.create()
    log.append(_event_log(spark, sf_dir))
    return log.read()


def q_run_log_summary(spark, sf_dir):
    return runlog.summary(_event_log(spark, sf_dir))


def q_run_log_details(spark, sf_dir):
    return runlog.details(_event_log(spark, sf_dir))


def q_run_outcomes(spark, sf_dir):
    return runlog.outcomes(_event_log(spark, sf_dir))


def q_load_throughput(spark, sf_dir):
    return runlog.load_throughput(_event_log(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Load the smallest ``orders`` table in full and read the published table back."""
    return q_load_full_table(spark, SMOKE_DIR)


def load_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per extract-load operator."""
    return {name[2:]: query for name, query in globals().items() if name.startswith("q_")}


def _training() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    try:
        import haulage.llm.registry as registry
        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "haulage.llm", "haulage.llm.registry"):
            raise
        return {}, {}
    oracles = dict(registry.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return registry.QUERIES | {"pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    return load_queries() | _training()[0]


_LOG_SQL = """
    log AS (
        SELECT ts AS log_time, 'p' || (user_id % 5) AS project,
               date_trunc('day', ts)::TIMESTAMP AS project_started_at,
               CASE WHEN event_id % 10 <> 0 THEN event_type END AS source_table,
               CASE WHEN event_id % 10 <> 0 THEN 't_' || event_type END AS target_table,
               ts AS started_at,
               ts + to_microseconds((event_id % 90) * 1377123) AS ended_at,
               CASE WHEN event_id % 10 = 0 THEN 'END' WHEN event_id % 7 = 0 THEN 'ERROR'
                    WHEN event_id % 13 = 0 THEN 'WARN' ELSE 'DONE' END AS status,
               event_id % 1000 AS exported_rows, event_id % 900 AS imported_rows
        FROM events
    )
"""


def _duration_sql(start: str, end: str) -> str:
    millis = f"date_diff('millisecond', {start}, {end}) % 86400000"
    return f"strftime(TIMESTAMP '1970-01-01' + to_milliseconds({millis}), '%H:%M:%S')"


def _measured_sql(rows: list[tuple]) -> str:
    columns = ("ordinal_position", "column_name", "data_type", "character_maximum_length",
               "numeric_precision", "numeric_scale")
    casts = ("INTEGER", "VARCHAR", "VARCHAR", "INTEGER", "INTEGER", "INTEGER")
    return " UNION ALL ".join(
        "SELECT " + ", ".join(f"CAST({v} AS {t}) AS {c}" for v, t, c in zip(row, casts, columns))
        + f" FROM {row[-1]}"
        for row in rows
    )


def oracle_sql() -> dict[str, str]:
    """The same results from DuckDB over the same tables."""
    return load_oracle_sql() | _training()[1]


def load_oracle_sql() -> dict[str, str]:
    orders, items, events = "SELECT * FROM orders", "SELECT * FROM lineitem", "SELECT * FROM events"
    revenue = REVENUE_BY_NATION.format(s="")
    seed = f"SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '{SEED_DATE}'"
    bounds = (
        "SELECT min({k}) AS mn, max({k}) AS mx, greatest(1, ((max({k}) - min({k}))::HUGEINT * 1000"
        " + count(*) - 1) // count(*))::BIGINT AS b FROM {t}"
    )
    order_bounds = bounds.format(k="o_orderkey", t="orders")
    digits = "greatest(length(abs(min({0}))::VARCHAR), length(abs(max({0}))::VARCHAR))"
    priced = "(" + PRICED_ITEMS.format(s="") + ") q"
    whitespace = f"'{WHITESPACE}'"
    return {
        "extract_table": items,
        "extract_query": revenue,
        "extract_where": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "drop_unsupported_columns": "SELECT doc_id, lang, source, n_chars FROM documents",
        "extract_high_water": f"SELECT * FROM orders WHERE o_orderdate > ({seed})",
        "extract_conjunction": f"""
            SELECT o_orderkey, o_custkey, o_orderdate FROM orders, ({order_bounds}) r
            WHERE o_orderdate > ({seed}) AND o_totalprice > 100000
              AND o_orderkey >= mn + b AND o_orderkey < mn + 2 * b""",
        "extract_limit": "SELECT least(count(*), 100) AS row_count FROM orders",
        "extract_range_batches": f"""
            SELECT orders.*, (o_orderkey - mn) // b AS batch_id FROM orders, ({order_bounds}) r""",
        "strip_nul_bytes": """
            SELECT event_id,
                   replace(chr(0) || event_type || chr(0) || props, chr(0), '') AS text
            FROM events""",
        "render_text_formats": """
            SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
                   user_id::VARCHAR AS user_id, event_type, value::VARCHAR AS value, props
            FROM events""",
        "create_table_from_columns":
            "SELECT * REPLACE (c_nationkey::BIGINT AS c_nationkey) FROM customer",
        "export_delimited": items,
        "import_delimited": "SELECT * FROM documents",
        "import_skip_bad_rows": "SELECT * FROM orders WHERE o_custkey % 10 <> 3",
        "normalise_text_rows": f"""
            SELECT regexp_replace(
                       doc_id || '|' || coalesce(trim(text, {whitespace}), '')
                       || '|' || coalesce(trim(lang, {whitespace}), '')
                       || '|' || coalesce(trim(source, {whitespace}), '')
                       || '|' || n_chars || '|' || (n_chars > 500)::INTEGER,
                       '[\\n\\r]', ' ', 'g') AS line
            FROM documents""",
        "swap_table": orders,
        "append_and_drop": events,
        "truncate_table": "SELECT count(*) AS rows_before, 0::BIGINT AS rows_after FROM orders",
        "table_columns": _measured_sql([
            (1, "'doc_id'", "'int'", "NULL", digits.format("doc_id"), 0, "documents"),
            (2, "'text'", "'str'", "max(length(text))", "NULL", "NULL", "documents"),
            (3, "'lang'", "'str'", "max(length(lang))", "NULL", "NULL", "documents"),
            (4, "'source'", "'str'", "max(length(source))", "NULL", "NULL", "documents"),
            (5, "'n_chars'", "'int'", "NULL", digits.format("n_chars"), 0, "documents"),
        ]),
        "query_columns": _measured_sql([
            (1, "'l_orderkey'", "'int'", "NULL", digits.format("l_orderkey"), 0, priced),
            (2, "'l_linenumber'", "'int'", "NULL", digits.format("l_linenumber"), 0, priced),
            (3, "'l_returnflag'", "'str'", "max(length(l_returnflag))", "NULL", "NULL", priced),
            (4, "'price'", "'decimal.Decimal'", "NULL",
             "max(length(split_part(price::VARCHAR, '.', 1)))"
             " + max(length(rtrim(split_part(price::VARCHAR, '.', 2), '0')))",
             "max(length(rtrim(split_part(price::VARCHAR, '.', 2), '0')))", priced),
            (5, "'l_shipdate'", "'datetime.datetime'", "NULL", "NULL", "min(NULL)", priced),
        ]),
        "cast_for_target": """
            SELECT event_id, user_id, (event_type = 'error')::INTEGER AS is_error, value,
                   value::DECIMAL(12,2) AS amount, ts::DATE AS day,
                   strftime(ts, '%H:%M:%S.%f') AS clock, ts, event_type
            FROM events""",
        "key_max": "SELECT max(o_orderdate)::VARCHAR AS max_value FROM orders",
        "key_min_max": "SELECT min(ts) AS min_value, max(ts) AS max_value FROM events",
        "key_min_max_batch": f"""
            SELECT mn AS min_value, mx AS max_value, b AS batch_size FROM ({order_bounds}) r""",
        "batch_row_counts": f"""
            SELECT (l_orderkey - mn) // b AS batch_id, count(*) AS row_count
            FROM lineitem, ({bounds.format(k="l_orderkey", t="lineitem")}) r GROUP BY 1""",
        "load_full_table": orders,
        "load_full_query": revenue,
        "load_incremental": orders,
        "load_incremental_bootstrap": events,
        "load_range_parallel": items,
        "run_load": " UNION ALL ".join(
            f"SELECT '{t}' AS source_table, 'pre_{t}' AS target_table, 'DONE' AS status,"
            f" count(*) AS exported_rows, count(*) AS imported_rows FROM {t}"
            for t in ("lineitem", "orders")),
        "run_project": " UNION ALL ".join([
            *(f"SELECT '{t}' AS source_table, '{t}_copy' AS target_table, 'DONE' AS status,"
              f" count(*) AS exported_rows, count(*) AS imported_rows FROM {t}"
              for t in ("lineitem", "orders", "customer")),
            *(f"SELECT '{t}', '{t}_copy', 'ERROR', 0::BIGINT, 0::BIGINT"
              for t in ("events", "no_such_table")),
            f"SELECT 'query', 'revenue', 'DONE', count(*), count(*) FROM ({revenue}) q",
        ]),
        "run_log_append": f"WITH {_LOG_SQL} SELECT * FROM log",
        "run_log_summary": f"""
            WITH {_LOG_SQL}
            SELECT strftime(project_started_at, '%Y-%m-%d') AS project_started_date,
                   project_started_at, project,
                   CASE WHEN count(*) FILTER (status = 'END') > 0 THEN 'Finished'
                        ELSE 'Running or failed' END AS status,
                   count(*) FILTER (source_table IS NOT NULL AND status = 'DONE')
                       AS completed_loads,
                   CASE WHEN count(*) FILTER (status = 'END') > 0 THEN max(ended_at) END AS ended_at,
                   {_duration_sql("min(project_started_at)", "max(ended_at)")} AS duration,
                   sum(exported_rows)::BIGINT AS exported_rows,
                   sum(imported_rows)::BIGINT AS imported_rows,
                   sum(imported_rows)::BIGINT // nullif(date_diff('second',
                       min(project_started_at), max(ended_at)), 0) AS loaded_rows_per_sec
            FROM log GROUP BY project_started_at, project""",
        "run_log_details": f"""
            WITH {_LOG_SQL}
            SELECT strftime(project_started_at, '%Y-%m-%d') AS project_started_date,
                   project_started_at, project, source_table, target_table,
                   strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
                   strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS ended_at,
                   {_duration_sql("started_at", "ended_at")} AS duration, status,
                   exported_rows, imported_rows,
                   imported_rows // nullif(date_diff('second', started_at, ended_at), 0)
                       AS loaded_rows_per_sec
            FROM log WHERE source_table IS NOT NULL""",
        "run_outcomes": f"""
            WITH {_LOG_SQL}
            SELECT count(*) FILTER (status = 'DONE') AS successes,
                   count(*) FILTER (status = 'WARN') AS warnings,
                   count(*) FILTER (status = 'ERROR') AS errors,
                   CASE WHEN count(*) FILTER (status = 'ERROR') > 0 THEN 'Completed with errors'
                        WHEN count(*) FILTER (status = 'WARN') > 0 THEN 'Completed with warnings'
                        ELSE 'Completed successfully' END AS outcome
            FROM log""",
        "load_throughput": f"""
            WITH {_LOG_SQL}
            SELECT project, source_table, started_at, imported_rows,
                   imported_rows * 1000000
                       // nullif(date_diff('microsecond', started_at, ended_at), 0) AS rows_per_sec
            FROM log WHERE source_table IS NOT NULL""",
    }
