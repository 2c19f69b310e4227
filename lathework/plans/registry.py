"""Queries by name, each with the SQL that gives the same rows, and adapters from the test tables.

Adapters are SQL that both engines read alike; the operators themselves are applied to their results.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"]

ADAPTERS = {
    "sessions": """
        SELECT user_id * 1000 + CAST(floor(event_id / 400) AS BIGINT) AS sid, count(*) AS steps,
               count(CASE WHEN event_type IN ('click', 'purchase') THEN 1 END) AS tool_call_count,
               CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS total_tokens,
               max(CASE WHEN event_type = 'error' THEN 'Interrupted' END) AS exit_status,
               user_id % 17 = 0 AS excluded_hit, CASE WHEN user_id % 3 = 0 THEN 'codex' ELSE 'claude_code' END AS agent_source,
               CASE user_id % 4 WHEN 0 THEN 'openai' WHEN 1 THEN 'zhipu' ELSE 'anthropic' END AS vendor
        FROM {events} GROUP BY user_id, CAST(floor(event_id / 400) AS BIGINT)""",
    "steps": """
        SELECT user_id AS sid, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx, ts,
               event_type AS tool, event_type = 'error' AS is_error, event_type = 'purchase' AS is_edit,
               concat('src/f', CAST(event_id % 40 AS VARCHAR(10)), '.py') AS path
        FROM {events}""",
    "units": """
        SELECT l_orderkey AS sid, CAST(n AS BIGINT) AS seq, concat(CAST(l_orderkey AS VARCHAR(20)), '#', CAST(n AS VARCHAR(20))) AS unit_id,
               CASE l_partkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'high' END AS boundary_confidence,
               concat('repo', CAST(l_suppkey % 3 AS VARCHAR(4))) AS repo,
               CASE l_partkey % 6 WHEN 0 THEN 'conflict' WHEN 1 THEN 'unresolved' WHEN 2 THEN 'voted' ELSE 'direct' END AS repo_resolution,
               CAST(floor(l_quantity) AS BIGINT) % 14 AS edit_ops, l_suppkey % 4 AS n_test_cmds,
               CASE l_partkey % 7 WHEN 0 THEN 'high' WHEN 1 THEN NULL ELSE 'medium' END AS secret_severity,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS started_at,
               CASE l_partkey % 5 WHEN 0 THEN 'bug_fix' WHEN 1 THEN 'feature_impl' WHEN 2 THEN 'refactor' WHEN 3 THEN 'doc_authoring' ELSE 'env_ops' END AS category,
               CAST(floor(l_extendedprice) AS BIGINT) % 1500 AS instruction_len,
               CASE WHEN l_suppkey % 2 = 0 THEN 'codex' ELSE 'claude_code' END AS agent_source, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'anthropic' END AS vendor
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS n FROM {lineitem}) AS numbered""",
    "trials": """
        SELECT concat('T', CAST(o_custkey % 60 AS VARCHAR(6))) AS task, concat('r', CAST(o_orderkey % 3 AS VARCHAR(2))) AS run, o_orderkey AS trial_id,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 1.0E0 ELSE 0.0E0 END AS reward,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 0.5E0 WHEN o_orderkey % 2 = 0 THEN 1.0E0 ELSE 0.0E0 END AS reward_txt,
               CASE WHEN o_orderkey % 5 = 0 THEN 1.0E0 WHEN o_orderkey % 2 = 0 THEN 1.0E0 ELSE 0.0E0 END AS f2p,
               CASE WHEN o_orderkey % 9 = 0 THEN 0.0E0 ELSE 1.0E0 END AS p2p,
               CASE o_orderkey % 13 WHEN 0 THEN 'AgentTimeoutError' WHEN 1 THEN 'BuildError' END AS exception,
               CASE o_orderkey % 7 WHEN 0 THEN 'error_during_execution' WHEN 1 THEN 'error_max_turns' WHEN 2 THEN NULL ELSE 'success' END AS subtype,
               CASE WHEN o_orderkey % 4 = 0 THEN 'The Socket Connection was closed unexpectedly' ELSE 'TypeError: x' END AS error_text,
               CASE WHEN o_orderkey % 18 = 0 THEN 'xml_missing' END AS p2p_error,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE floor(o_totalprice) / 100000 END AS cost_usd, o_orderpriority AS model
        FROM {orders}""",
    "turns": """
        SELECT conv_id AS sid, turn AS seq, turn AS line_no, role, text, CAST(conv_id * 10 + turn * turn * 400 AS DOUBLE) AS ts_epoch
        FROM {conversations}""",
}


def adapted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = ADAPTERS[name]
    used = [t for t in TABLES if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def cte(*names: str) -> str:
    """The adapters as common table expressions."""
    return ",\n".join(f"{n} AS ({ADAPTERS[n].format(**{t: t for t in TABLES})})" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share; a local one only where none is set and Spark runs on this machine alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lathework-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(literal, value)) + "]"
    return repr(value)


def values(rows: list[tuple], columns: str) -> str:
    """Rows as a SQL subquery."""
    names = ", ".join(c.split()[0] for c in columns.split(", "))
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS v({names}))"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
