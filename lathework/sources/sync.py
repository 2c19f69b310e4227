"""Incremental pulls: what to fetch, when a session counts as fetched, results of trials on disk."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def markers(fetched: DataFrame) -> DataFrame:
    """(sid, fingerprint, complete) from file results (sid, fingerprint, file, status): a session is complete only if no
    file failed; a file that does not exist there is no failure."""
    return fetched.groupBy("sid").agg(F.max("fingerprint").alias("fingerprint"), F.bool_and(F.col("status").isin("ok", "missing", "exists")).alias("complete"))


def recent(files: DataFrame, now: datetime.datetime, days: int, modified: str = "modified") -> DataFrame:
    return files.where(F.col(modified) >= F.lit(now - datetime.timedelta(days=days)))


def latest_run(runs: DataFrame, name: str = "run") -> DataFrame:
    """The last of the names that start like a year, by text."""
    return runs.where(F.col(name).startswith("20")).agg(F.max(name).alias(name))


def trial_rows(documents: DataFrame, column: str = "doc", prefix: str = "agent") -> DataFrame:
    """(task, reward, f2p, p2p, error_code, exception, subtype, turns) from result documents; those without a task are
    not results of a trial. The exception may be an object or a text, the metadata may lie in either of two places."""
    j = lambda p: F.get_json_object(column, p)
    number = lambda n: j(f"$.verifier_result.rewards.{n}").cast("double")
    meta = lambda n: F.coalesce(j(f"$.agent_result.metadata.{prefix}_{n}"), j(f"$.agent_info.metadata.{prefix}_{n}"))
    out = documents.select(
        j("$.task_name").alias("task"), number("reward").alias("reward"), number("f2p").alias("f2p"), number("p2p").alias("p2p"), number("error_code").cast("int").alias("error_code"),
        F.coalesce(j("$.exception_info.exception_type"), F.nullif(j("$.exception_info"), F.lit("null"))).alias("exception"), meta("subtype").alias("subtype"), meta("num_turns").cast("int").alias("turns"),
    )
    return out.where(F.coalesce("task", F.lit("")) != "")


def run_rewards(rows: DataFrame) -> DataFrame:
    """(task, reward) of judged rows."""
    return rows.where(F.col("reward").isNotNull() & (F.coalesce("task", F.lit("")) != "")).groupBy("task").agg(F.max("reward").alias("reward"))
