"""Verdicts on tasks, ordered diagnoses, and gates as assertion tables (gate, ok, detail). An empty scope fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import ANSWER_KEYS, gold_candidates
from lathework.operators.trials import dual_source_ok

CLEAN_FINISH = ["success"]
UNFINISHED_FROM = ["true_zero_wrong_fix", "true_zero_missing_symbol", "true_zero_no_attempt"]


def verdict(ok: bool, reason: str, infra: bool = False) -> Column:
    return F.struct(F.lit(ok).alias("ok"), F.lit(reason).alias("reason"), F.lit(infra).alias("infra"))


def gate_oracle() -> Column:
    """The reference solution must be all green. What cannot be told from a broken machine is marked infra."""
    agreed = dual_source_ok(F.col("reward"), F.col("reward_txt"))
    return (
        F.when(F.col("exception").isNotNull(), verdict(False, "exception", True))
        .when(~agreed, verdict(False, "sources_disagree", True))
        .when(F.col("reward") == 1.0, verdict(True, ""))
        .when(F.coalesce((F.col("f2p") == 1.0) & ~F.col("p2p").eqNullSafe(F.lit(1.0)), F.lit(False)), verdict(False, "breaks_others", True))
        .otherwise(verdict(False, "not_solved"))
    )


def gate_nop() -> Column:
    """Without a change the target tests must be red and all others green; parts count, not the total."""
    agreed = dual_source_ok(F.col("reward"), F.col("reward_txt"))
    return (
        F.when(F.col("exception").isNotNull(), verdict(False, "exception", True))
        .when(~agreed, verdict(False, "sources_disagree", True))
        .when(F.coalesce(F.col("f2p") == 1.0, F.lit(False)), verdict(False, "green_without_change"))
        .when(F.coalesce(F.col("p2p") == 0.0, F.lit(False)), verdict(False, "broken_environment", True))
        .when(F.coalesce((F.col("f2p") == 0.0) & (F.col("p2p") == 1.0), F.lit(False)), verdict(True, ""))
        .otherwise(verdict(False, "unexpected_values"))
    )


def gate_consistency(trials: DataFrame) -> DataFrame:
    """(task, ok, reason, infra): repeated runs give one reward; a null reward is a value of its own."""
    out = trials.groupBy("task").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("exception").alias("raised"),
        (F.count_distinct("reward") + F.max(F.col("reward").isNull().cast("int"))).alias("values"),
    )
    v = F.when(F.col("raised") > 0, verdict(False, "exception", True)).when(F.col("n") < 2, verdict(False, "too_few_runs", True)).when(F.col("values") == 1, verdict(True, "")).otherwise(verdict(False, "inconsistent"))
    return out.withColumn("v", v).select("task", "v.ok", "v.reason", "v.infra")


def zero_diagnosis() -> Column:
    """Why a trial has no points, first reason first. Needs reward, upstream_failure, started, judged_all, load_failures
    and write_calls."""
    return (
        F.when(~F.col("has_reward"), "running").when(F.col("reward") == 1.0, "solved").when(F.col("upstream_failure"), "infra_upstream_disconnect")
        .when(~F.col("started"), "infra_agent_not_launched").when(~F.col("judged_all") & (F.col("load_failures") > 0), "true_zero_missing_symbol")
        .when(~F.col("judged_all"), "grader_incomplete").when(F.col("write_calls") == 0, "true_zero_no_attempt").otherwise("true_zero_wrong_fix")
    )


def reclassify(diagnosis: Column, subtype: Column) -> Column:
    """Zeros of trials that did not end by themselves are unfinished; doing it twice changes nothing."""
    return F.when(diagnosis.isin(UNFINISHED_FROM) & ~F.coalesce(subtype.isin(CLEAN_FINISH), F.lit(False)), "true_zero_unfinished").otherwise(diagnosis)


def assertions(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(gate, ok, detail) from conditions that no row may break; each needs rows in scope."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(~F.coalesce(c, F.lit(False))).alias(f"bad_{g}") for g, c in checks.items()))
    rows = F.array(*(F.struct(F.lit(g).alias("gate"), ((F.col("n") > 0) & (F.col(f"bad_{g}") == 0)).alias("ok"), F.concat(F.col(f"bad_{g}").cast("string"), F.lit(" of "), F.col("n").cast("string")).alias("detail")) for g in checks))
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def share_gate(df: DataFrame, gate: str, condition: Column, least: float, scope: Column | None = None, least_rows: int = 1) -> DataFrame:
    """Whether at least this share of the rows in scope meets the condition."""
    scope = F.lit(True) if scope is None else scope
    out = df.agg(F.count_if(scope).alias("n"), F.count_if(scope & F.coalesce(condition, F.lit(False))).alias("k"))
    share = F.try_divide(F.col("k").cast("double"), F.col("n").cast("double"))
    return out.select(F.lit(gate).alias("gate"), F.coalesce((F.col("n") >= least_rows) & (share >= least), F.lit(False)).alias("ok"), F.round(share, 4).alias("share"))


def session_gate(sessions: DataFrame) -> DataFrame:
    """Legal reasons, kept exactly without a reason, and interruption by itself never drops a session."""
    legal = ["R1_EMPTY", "R2_TOO_SHORT", "R3_NO_ACTION", "R4_TOO_FEW_TOKENS", "E_SELF_REFERENTIAL"]
    return assertions(sessions, {
        "reason_legal": F.col("drop_reason").isNull() | F.col("drop_reason").isin(legal),
        "keep_iff_no_reason": F.col("keep") == F.col("drop_reason").isNull(),
        "interrupted_not_dropped_for_it": ~F.coalesce(F.col("drop_reason"), F.lit("")).contains("INTERRUPT"),
    })


def label_gate(units: DataFrame, share: float = 0.6) -> DataFrame:
    """Legal difficulty, unrated exactly without edits, no category or rated difficulty above the share, four categories."""
    n = F.count(F.lit(1))
    one = units.agg(
        n.alias("n"),
        F.count_if((F.col("difficulty") == "unrated") != (F.col("edit_ops") == 0)).alias("bad_unrated"),
        F.count_distinct("category").alias("categories"),
    )
    top = units.groupBy("category").agg(n.alias("k")).agg(F.max("k").alias("top"))
    rated = units.where("difficulty <> 'unrated'").groupBy("difficulty").agg(n.alias("k")).agg(F.coalesce(F.max("k"), F.lit(0)).alias("top_rated"), F.coalesce(F.sum("k"), F.lit(0)).alias("rated"))
    all_of = one.crossJoin(top).crossJoin(rated)
    some = F.col("n") > 0
    rows = F.array(
        F.struct(F.lit("unrated_iff_no_edits").alias("gate"), (some & (F.col("bad_unrated") == 0)).alias("ok")),
        F.struct(F.lit("category_share").alias("gate"), (some & (F.col("top") <= share * F.col("n"))).alias("ok")),
        F.struct(F.lit("difficulty_share").alias("gate"), (some & (F.col("top_rated") <= share * F.col("rated"))).alias("ok")),
        F.struct(F.lit("four_categories").alias("gate"), (F.col("categories") >= 4).alias("ok")),
    )
    return all_of.select(F.explode(rows).alias("r")).select("r.*")


def prompt_leaks(diffs: DataFrame, prompts: DataFrame) -> DataFrame:
    """(task, line): added lines of a task's reference diff that stand in its prompt."""
    lines = diffs.select("task", F.explode(gold_candidates(F.col("diff"))).alias("line"))
    return lines.join(prompts.select("task", "prompt"), "task").where(F.contains(F.col("prompt"), F.col("line"))).select("task", "line")


def leak_verdict(leaks: DataFrame, allowed: DataFrame) -> DataFrame:
    """(task, line, state): leaks that are not allowed, and allowances that no leak uses any more."""
    new = leaks.join(allowed, ["task", "line"], "left_anti").withColumn("state", F.lit("leak"))
    return new.unionByName(allowed.join(leaks, ["task", "line"], "left_anti").withColumn("state", F.lit("stale_allowance")))


def contamination(files: DataFrame) -> DataFrame:
    """(path, keyword, line_no) for lines with a key under which answers are recorded."""
    lines = files.select("path", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    keys = F.filter(F.array(*(F.lit(k) for k in ANSWER_KEYS)), lambda k: F.contains(F.col("line"), k))
    return lines.select("path", F.explode(keys).alias("keyword"), (F.col("i") + 1).alias("line_no"))


def closed_funnel(total: DataFrame, channels: DataFrame) -> DataFrame:
    """channels (channel, n) with their sum and whether it equals total (n)."""
    s = channels.agg(F.sum("n").alias("channel_sum"))
    return channels.crossJoin(F.broadcast(s)).crossJoin(F.broadcast(total.select(F.col("n").alias("total")))).withColumn("closes", F.col("channel_sum") == F.col("total"))


def side_score(required: DataFrame, suites: DataFrame) -> DataFrame:
    """(task, required, green, score): a required file is green if its suite ran tests and none failed; none required: 0."""
    s = suites.groupBy("task", "file").agg(F.sum("tests").alias("tests"), F.sum("failures").alias("failures"))
    green = F.coalesce((F.col("tests") > 0) & (F.col("failures") == 0), F.lit(False))
    out = required.join(s, ["task", "file"], "left").groupBy("task").agg(F.count("file").alias("required"), F.count_if(green).alias("green"))
    return out.withColumn("score", F.when((F.col("required") > 0) & (F.col("green") == F.col("required")), 1.0).otherwise(0.0))
