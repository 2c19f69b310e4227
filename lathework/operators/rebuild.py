"""Ordered text operations that no column expression gives: rebuilding files from edits, matching prompts, literals."""

from __future__ import annotations

import ast
import difflib
import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_edits(original: str | None, operations: Iterable[dict]) -> tuple[str | None, str | None]:
    """(final text, failure). A write replaces all; an edit replaces its first match, or all; the first edit that does
    not fit ends the attempt, because nothing after it can be trusted."""
    text, new_file = original or "", original is None
    for op in operations:
        if op["tool"] == "Write":
            if op.get("content") is None:
                return None, "write_without_content"
            text = op["content"]
            continue
        edits = [op] if op["tool"] == "Edit" else list(op["edits"] if op.get("edits") is not None else [])
        if not edits:
            return None, "empty_multiedit"
        for e in edits:
            old, put = e.get("old") or "", e.get("new") or ""
            if not old:
                text = put
            elif old not in text:
                return None, "phantom_file" if new_file else "old_string_not_found"
            else:
                text = text.replace(old, put) if e.get("all") else text.replace(old, put, 1)
    return text, None


def rebuilt_files(bases: DataFrame, operations: DataFrame) -> DataFrame:
    """(unit_id, path, final, failure) from bases (unit_id, path, text) and operations (unit_id, path, idx, tool,
    content, old, new, all), applied in order of idx. A file's operations are one row, so they meet in one task."""
    op = F.struct("idx", "tool", "content", "old", "new", "all")
    ordered = operations.groupBy("unit_id", "path").agg(F.array_sort(F.collect_list(op)).alias("ops"))

    @F.pandas_udf("final string, failure string")
    def run(text: pd.Series, ops: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([apply_edits(t, [o if isinstance(o, dict) else o.asDict() for o in x]) for t, x in zip(text, ops, strict=True)], columns=["final", "failure"])

    return ordered.join(bases, ["unit_id", "path"], "left").select("unit_id", "path", run("text", "ops").alias("r")).select("unit_id", "path", "r.*")


def unified_diff(before: str | None, after: str, path: str) -> str:
    old, new = (before or "").splitlines(keepends=True), after.splitlines(keepends=True)
    return "".join(difflib.unified_diff(old, new, f"a/{path}", f"b/{path}"))


def parse_literal(value: str | None) -> dict[str, str]:
    """A dict from JSON, else from a Python literal, else empty; values as text."""
    for parse in (json.loads, ast.literal_eval):
        try:
            found = parse(value or "")
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
        if isinstance(found, dict):
            return {str(k): v if isinstance(v, str) else json.dumps(v, default=str) for k, v in found.items()}
    return {}


def with_tool_input(df: DataFrame, column: str) -> DataFrame:
    """column as map<string,string>. JSON objects are parsed natively; only other texts go to Python."""
    native = F.when(F.col(column).rlike(r"^\s*\{"), F.from_json(column, "map<string,string>"))

    @F.pandas_udf("map<string,string>")
    def fallback(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else parse_literal(v))

    bad = native.isNull() & F.col(column).isNotNull()
    return df.withColumn(column, F.coalesce(native, fallback(F.when(bad, F.col(column))), F.create_map().cast("map<string,string>")))


def normalized(text: str | None) -> str:
    return " ".join((text or "").split())[:120].lower()


def greedy_matches(mine: list[str], judge: list[str]) -> list[int | None]:
    """For each of the judge's prompts the first free unit that contains its start, is contained, or is much alike."""
    taken: set[int] = set()
    out: list[int | None] = []
    for j in map(normalized, judge):
        hit = next((i for i, m in enumerate(map(normalized, mine)) if i not in taken and ((j[:60] and (j[:60] in m or m[:60] in j)) or difflib.SequenceMatcher(None, j[:100], m[:100]).ratio() > 0.75)), None)
        if hit is not None:
            taken.add(hit)
        out.append(hit)
    return out


def judged_segmentation(units: DataFrame, prompts: DataFrame) -> DataFrame:
    """(sid, tp, fp, fn): units (sid, seq, text) against independent prompts (sid, seq, text), one to one, in order."""
    u = units.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]).alias("mine"))
    p = prompts.where(F.trim("text") != "").groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]).alias("judge"))

    @F.pandas_udf("int")
    def hits(mine: pd.Series, judge: pd.Series) -> pd.Series:
        return pd.Series([sum(x is not None for x in greedy_matches(list(m), list(j))) for m, j in zip(mine, judge, strict=True)], dtype="int32")

    out = u.join(p, "sid").withColumn("tp", hits("mine", "judge"))
    return out.select("sid", "tp", (F.size("mine") - F.col("tp")).alias("fp"), (F.size("judge") - F.col("tp")).alias("fn"))


def precision_recall(judged: DataFrame) -> DataFrame:
    total = judged.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")))
    return total.withColumns({"precision": F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)), "recall": F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))})


def json_damage(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, line_no) of lines that were JSON before a change and are not after it."""
    valid = F.try_parse_json("line").isNotNull()
    was = before.where(valid).select("path", "line_no")
    now = after.where(F.try_parse_json("line").isNull()).select("path", "line_no")
    return was.join(now, ["path", "line_no"], "left_semi")
