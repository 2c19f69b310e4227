"""Schemas of the session model and checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROVENANCE = ["agent_source", "model", "vendor", "repo", "repo_resolution", "provenance", "batch_version"]

STEPS = "sid string, step_idx int, message_type string, tool_name string, tool_input map<string,string>, is_error boolean, timestamp string, tool_use_id string"
TRIALS = "task string, run string, reward double, f2p double, p2p double, error_code int, exception string, reward_txt double, cost_usd double, model string, subtype string, errors array<string>, p2p_error string"


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def assert_schema(df: DataFrame, ddl: str) -> DataFrame:
    """df in the wanted columns and types; raises if a column is missing."""
    wanted = T.StructType.fromDDL(ddl)
    if gone := missing_columns(df, wanted.names):
        raise ValueError(f"missing columns: {', '.join(gone)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))


def all_null_columns(df: DataFrame) -> DataFrame:
    """(column_name, rows): columns that are null in every row; an empty table gives all."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(c).alias(f"n_{c}") for c in df.columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("n")) for c in df.columns))
    return counted.select("rows", F.explode(pairs).alias("p")).where("p.n = 0").select("p.column_name", "rows")
