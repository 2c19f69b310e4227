"""Turns and tool results from raw API lines with nested messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import stripped, user_text_blocks
from lathework.operators.sessions import first_turns

MESSAGE = "struct<role:string,texts:array<string>>"


def line_texts(messages: Column, increments: Column, first_line: Column) -> Column:
    """Real user texts of a line. The first line, if it is no increment, repeats a whole history: only its last user
    message with a real text counts."""
    part = F.when(F.size(F.coalesce(increments, F.array().cast(f"array<{MESSAGE}>"))) > 0, increments).otherwise(F.coalesce(messages, F.array().cast(f"array<{MESSAGE}>")))
    whole = F.size(F.coalesce(increments, F.array().cast(f"array<{MESSAGE}>"))) == 0
    by_message = F.transform(F.filter(part, lambda m: m["role"] == "user"), lambda m: user_text_blocks(m["texts"]))
    real = F.filter(by_message, lambda t: F.size(t) > 0)
    last = F.when(F.size(real) > 0, F.slice(real, -1, 1)).otherwise(real)
    return F.flatten(F.when(first_line & whole, last).otherwise(real))


def extract_turns(lines: DataFrame) -> DataFrame:
    """(sid, seq, line_no, ts, text) from lines (sid, line_no, raw_idx, ts, messages, new_messages): a line gives at most
    one turn, its last real text; repeats of a start go before the turns are ordered by time."""
    texts = line_texts(F.col("messages"), F.col("new_messages"), F.col("line_no") == 0)
    turns = lines.withColumn("texts", texts).where(F.size("texts") > 0)
    turns = turns.select("sid", "line_no", "raw_idx", "ts", stripped(F.element_at("texts", -1)).alias("text"))
    return first_turns(turns).select("sid", "seq", "line_no", "ts", "text")


def longest_results(uses: DataFrame, results: DataFrame, wanted: DataFrame, least_bytes: int = 800) -> DataFrame:
    """(sid, path, text): for wanted (sid, path) the longest result of a tool whose input names the file. Short results
    and single lines that hold the name are shell output and no file; JSON files must parse."""
    name = F.substring_index("path", "/", -1)
    named = wanted.join(uses, "sid").where(F.contains(F.col("input"), name)).select("sid", "path", "use_id").distinct()
    best = named.join(results, ["sid", "use_id"]).groupBy("sid", "path").agg(F.max(F.struct(F.length("text").alias("n"), "text")).alias("b")).select("sid", "path", stripped(F.col("b.text")).alias("text"))
    shell = (F.length(F.regexp_replace("text", "[^\n]", "")) <= 1) & F.contains(F.col("text"), name)
    broken = F.lower("path").endswith(".json") & F.try_parse_json("text").isNull()
    return best.where((F.octet_length("text") >= least_bytes) & ~shell & ~broken)


def actions_between(actions: DataFrame, units: DataFrame) -> DataFrame:
    """Actions (sid, idx, …) inside the closed intervals of units (unit_id, sid, lo, hi)."""
    a = actions.withColumnRenamed("sid", "__sid")
    return units.join(a, (units["sid"] == a["__sid"]) & a["idx"].between(units["lo"], units["hi"])).drop("__sid")


def write_calls(documents: DataFrame, column: str, names: list[str]) -> DataFrame:
    """(…, n_writes): how often a tool of these names is called anywhere in a JSON text, at any depth."""
    pattern = r'"name"\s*:\s*"(?i:' + "|".join(names) + r')"'
    return documents.withColumn("n_writes", F.regexp_count(column, F.lit(pattern)))


def first_edits(operations: DataFrame) -> DataFrame:
    """(unit_id, path, idx, old): the first edit of each file, which anchors it in its base."""
    best = operations.where("tool = 'Edit'").groupBy("unit_id", "path").agg(F.min(F.struct("idx", "old")).alias("e"))
    return best.select("unit_id", "path", "e.idx", "e.old")
