"""Frozen batches, stage statistics and projections that carry every field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.operators.joins import batch_fingerprint
from lathework.schema import PROVENANCE


def with_provenance(df: DataFrame, **known) -> DataFrame:
    """df with all provenance fields: those it has stay, others are null or as given."""
    return df.withColumns({c: F.lit(known.get(c)).cast("string") for c in PROVENANCE if c not in df.columns})


def freeze(index: DataFrame, version: str) -> DataFrame:
    """One row about a batch: counts, anchor rate among sessions of three steps or more, latest start, fingerprint."""
    steps = F.coalesce("steps", F.lit(0))
    anchored = (steps >= 3) & F.col("repo").isNotNull()
    head = index.agg(
        F.count(F.lit(1)).alias("session_count"), F.max(F.coalesce("start_time", F.lit(""))).alias("latest_session_start"),
        F.count_if(steps >= 3).alias("steps_ge3"), F.count_if(anchored).alias("steps_ge3_anchored"),
    )
    rate = F.round(F.coalesce(F.try_divide(F.col("steps_ge3_anchored").cast("double"), F.col("steps_ge3").cast("double")), F.lit(0.0)), 4)
    digest = batch_fingerprint(index.withColumn("steps", steps)).select(F.col("digest").alias("fingerprint"))
    return head.withColumns({"version": F.lit(version), "anchor_rate": rate}).crossJoin(digest)


def frozen_conflict(frozen: DataFrame, again: DataFrame) -> DataFrame:
    """(version, was, now) where a version would be rewritten with another fingerprint."""
    was = frozen.select("version", F.col("fingerprint").alias("was"))
    return again.select("version", F.col("fingerprint").alias("now")).join(was, "version").where("was <> now").select("version", "was", "now")


def distribution(df: DataFrame, key: str, most: int = 25) -> DataFrame:
    """(key, n), largest first, ties by key, missing as (unresolved)."""
    return df.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("(unresolved)")).alias("key")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(most)


def unit_statistics(units: DataFrame) -> DataFrame:
    """One row: sessions, units, kept, units a session, sessions of several units, share of kept units with an interval."""
    per = units.groupBy("sid").agg(F.count_if("keep").alias("kept"), F.count(F.lit(1)).alias("units"), F.count_if(F.col("keep") & F.col("lo").isNotNull()).alias("mapped"))
    out = per.agg(F.count(F.lit(1)).alias("sessions"), F.sum("units").alias("units"), F.sum("kept").alias("kept"), F.count_if(F.col("kept") > 1).alias("multi"), F.sum("mapped").alias("mapped"))
    share = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)), 4)
    return out.withColumns({"units_per_session": share("units", "sessions"), "multi_rate": share("multi", "sessions"), "mapped_rate": share("mapped", "kept")})


def label_statistics(units: DataFrame) -> DataFrame:
    """(difficulty, n, share): rated difficulties and their shares among rated units."""
    rated = units.where("difficulty <> 'unrated'").groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return rated.withColumn("share", F.round(F.col("n") / total, 4))


def merged_counts(df: DataFrame, maps: str) -> DataFrame:
    """(key, n): maps of counts added up."""
    return df.select(F.explode(maps).alias("key", "v")).groupBy("key").agg(F.sum("v").alias("n"))


def size_statistics(df: DataFrame, bytes_column: str) -> DataFrame:
    """n, least and most megabytes over positive sizes."""
    mb = F.round(F.col(bytes_column) / 1e6, 3)
    return df.where(F.col(bytes_column) > 0).agg(F.count(F.lit(1)).alias("n"), F.min(mb).alias("least_mb"), F.max(mb).alias("most_mb"))


def regression_candidates(green: DataFrame, touched: DataFrame, most: int = 30) -> DataFrame:
    """(task, path, tier, tests, rank): green files (path, tests) for tasks (task, path touched): same folder first, then
    same top folder, then others; many tests first; never a touched file. Files of a touched top folder are joined by
    it. Of the others the best `most` of every top folder are enough, and of these the first `most` for one more folder
    than a task touches at most, so every task meets a short list and not all files."""
    folder = lambda c: F.when(F.instr(c, "/") > 0, F.regexp_replace(c, "/[^/]*$", "")).otherwise("")
    of = touched.groupBy("task").agg(F.collect_set("path").alias("own"), F.collect_set(F.when(F.instr("path", "/") > 0, folder("path"))).alias("dirs"), F.collect_set(F.substring_index("path", "/", 1)).alias("tops"))
    files = green.withColumn("top", F.substring_index("path", "/", 1))
    near = files.join(of.withColumn("top", F.explode("tops")), "top").where(~F.array_contains("own", F.col("path")))
    near = near.select("task", "path", "tests", F.when(F.array_contains("dirs", folder("path")), 0).otherwise(1).alias("tier"))
    folders = of.agg(F.coalesce(F.max(F.size("tops")), F.lit(0))).first()[0]
    best = Window.partitionBy("top").orderBy(F.desc("tests"), "path")
    short = files.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).orderBy(F.desc("tests"), "path").limit(most * (folders + 1))
    far = of.select("task", "tops").crossJoin(F.broadcast(short)).where(~F.array_contains("tops", F.col("top"))).select("task", "path", "tests", F.lit(2).alias("tier"))
    pairs = near.unionByName(far)
    w = Window.partitionBy("task").orderBy("tier", F.desc("tests"), "path")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select("task", "path", "tier", "tests", "rank")


DROPS = ["base_not_found", "path_leak", "incomplete_paths", "gitignored_paths", "truncated_tool_input", "no_code_ops", "rebuild_failed", "not_two_sided", "apply_check_failed", "anchor_below_threshold"]


def drop_reason(least_anchor: float = 0.7):
    """The first reason against a candidate: boolean columns of these names, and anchor_rate. Null counts as no reason."""
    out = None
    for name in DROPS[:-1]:
        hit = F.coalesce(F.col(name), F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.when(F.coalesce(F.col("anchor_rate"), F.lit(0.0)) < least_anchor, DROPS[-1])


def survivor_groups(survivors: DataFrame, groups: list[tuple[str, object]]) -> DataFrame:
    """(name, n, closes): survivors dealt to the first group whose condition holds, else scored; closes: sums agree."""
    out = None
    for name, condition in groups:
        hit = F.coalesce(condition, F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    dealt = survivors.groupBy((F.lit("scored") if out is None else out.otherwise("scored")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    total = survivors.agg(F.count(F.lit(1)).alias("total"))
    added = dealt.agg(F.sum("n").alias("added"))
    return dealt.crossJoin(total).crossJoin(added).select("name", "n", (F.col("total") == F.col("added")).alias("closes"))


def rerun_summary(trials: DataFrame, turns: str = "turns") -> DataFrame:
    """One row: tasks, share solved of all rows, tasks without a write, tasks at the turn limit, total cost."""
    rows = F.count(F.lit(1))
    return trials.agg(
        rows.alias("tasks"), F.round(100 * F.count_if(F.col("reward") == 1.0) / F.nullif(rows, F.lit(0)), 1).alias("pass_pct"), F.count_if(F.coalesce("write_calls", F.lit(0)) == 0).alias("silent"),
        F.count_if(F.col("subtype") == "error_max_turns").alias("capped"), F.round(F.sum("cost_usd"), 4).alias("cost"),
    )


def probe_verdict(trials: DataFrame, solved_before: DataFrame, least_new: int = 3) -> DataFrame:
    """One row about a probe with more turns: judged, still at the limit, newly solved, whether it was useful."""
    judged = trials.where(F.col("reward").isNotNull()).join(solved_before.withColumn("before", F.lit(True)), "task", "left")
    out = judged.agg(F.count(F.lit(1)).alias("n_judged"), F.count_if(F.col("subtype") == "error_max_turns").alias("still_capped"), F.count_if((F.col("reward") == 1.0) & F.col("before").isNull()).alias("new_solved"))
    fine = (F.col("n_judged") > 0) & ((F.col("n_judged") - F.col("still_capped")) * 2 >= F.col("n_judged"))
    return out.withColumn("useful", fine & (F.col("new_solved") >= least_new))


def price_verdict(host, registry, placeholders: tuple[float, ...] = (0.0, 1.0)):
    """struct of source and problem for two price structs (input, output): the host's counts before the registry's."""
    p = F.coalesce(host, registry)
    source = F.when(host.isNotNull(), "host").when(registry.isNotNull(), "registry").otherwise("none")
    zero = lambda c: F.coalesce(c, F.lit(0.0)) == 0.0
    problem = F.when(p.isNull(), "no_price").when(p["input"].isin(*placeholders) & p["output"].isin(*placeholders), "placeholder").when(zero(p["input"]) | zero(p["output"]), "incomplete")
    return F.struct(source.alias("source"), problem.alias("problem"))


def control_group(rows: DataFrame, control: DataFrame) -> DataFrame:
    """One row about trials of control tasks: the verdict waits until all have run."""
    joined = control.select("task").distinct().join(rows, "task", "left")
    out = joined.agg(
        F.count(F.lit(1)).alias("n_control"), F.count("verdict").alias("n_done"), F.count_if(F.col("write_calls") > 0).alias("n_attempted"),
        F.count_if(F.col("verdict").isin("true_zero_wrong_fix", "solved")).alias("n_supporting"), F.count_if(F.col("subtype") == "error_max_turns").alias("n_capped"),
    )
    reading = (
        F.when(F.col("n_done") == 0, "not_run").when(F.col("n_done") < F.col("n_control"), "withheld").when(F.col("n_supporting") > 0, "supported")
        .when((F.col("n_attempted") == 0) & (F.col("n_capped") == F.col("n_done")), "incomplete").otherwise("mixed")
    )
    return out.withColumn("reading", reading)


def health_checks(summary: DataFrame) -> DataFrame:
    """(check, state) from one row (p, models, best_gap, small, medium, large): ok, failed or cannot_judge."""
    three = lambda known, ok: F.when(~known, "cannot_judge").when(ok, "ok").otherwise("failed")
    rows = F.array(
        F.struct(F.lit("rate_in_range").alias("check"), three(F.col("p").isNotNull(), F.col("p").between(0.2, 0.8)).alias("state")),
        F.struct(F.lit("models_apart").alias("check"), three(F.col("models") >= 2, F.col("best_gap") >= 0.1).alias("state")),
        F.struct(F.lit("bands_fall").alias("check"), three(F.col("small").isNotNull() & F.col("medium").isNotNull() & F.col("large").isNotNull(), (F.col("small") >= F.col("medium")) & (F.col("medium") >= F.col("large"))).alias("state")),
    )
    return summary.select(F.explode(rows).alias("r")).select("r.*")


def framework_mode(package_json):
    """workspace, external or absent, from the dependencies of a package.json."""
    spec = F.coalesce(F.get_json_object(package_json, "$.devDependencies['eval-framework']"), F.get_json_object(package_json, "$.dependencies['eval-framework']"))
    return F.when(spec.isNull(), "absent").when(spec.startswith("workspace:"), "workspace").otherwise("external")


def started(sessions: DataFrame, calls: str = "tools") -> DataFrame:
    """sessions with started: at least one recorded call."""
    return sessions.withColumn("started", F.size(F.coalesce(calls, F.array().cast("array<string>"))) > 0)


def ordered_documents(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, doc): JSON with fixed column order, rows by key; nulls are written."""
    return df.select(key, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("doc")).orderBy(key)


def candidates_by_base(candidates: DataFrame) -> DataFrame:
    """(base, paths): candidate files of all tasks that share a base, sorted."""
    return candidates.groupBy("base").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def kept_and_dropped(units: DataFrame) -> DataFrame:
    """All units with list: kept or dropped."""
    return units.where("keep").withColumn("list", F.lit("kept")).unionByName(units.where("not coalesce(keep, false)").withColumn("list", F.lit("dropped")))


def member_states(members: DataFrame, rates: DataFrame) -> DataFrame:
    """(task, state): solved, unsolved, excluded (ran without a usable attempt) or missing (did not run)."""
    joined = members.select("task").distinct().join(rates, "task", "left")
    return joined.select("task", F.when(F.col("attempts").isNull(), "missing").when(F.col("rate").isNull(), "excluded").when(F.bround("rate") > 0, "solved").otherwise("unsolved").alias("state"))


def attribution(rows: DataFrame, gate: str) -> DataFrame:
    """(gate, passed, failed, infra, total, closes): every gate with its own denominator, and whether its parts add up."""
    out = rows.groupBy(gate).agg(F.count_if("ok").alias("passed"), F.count_if(~F.col("ok") & ~F.col("infra")).alias("failed"), F.count_if(~F.col("ok") & F.col("infra")).alias("infra"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("closes", F.col("passed") + F.col("failed") + F.col("infra") == F.col("total"))
