"""Ordered operators on sessions: turns, boundaries, intervals of steps, measures, as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.functions import text as X

GAP_SECONDS = 30 * 60
STRETCH = 64


def first_turns(turns: DataFrame) -> DataFrame:
    """Turns without repeats: of equal first 200 characters the first in file order stays, then seq by time."""
    w = Window.partitionBy("sid", F.substring("text", 1, 200)).orderBy("line_no")
    kept = turns.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    order = Window.partitionBy("sid").orderBy(F.coalesce("ts", F.lit("")), F.coalesce("raw_idx", F.lit(0)), "line_no")
    return kept.withColumn("seq", F.row_number().over(order))


def with_unit_ids(units: DataFrame, order: Column) -> DataFrame:
    """seq from 0 and unit_id by session and order."""
    w = Window.partitionBy("sid").orderBy(order)
    out = units.withColumn("seq", F.row_number().over(w) - 1)
    return out.withColumn("unit_id", F.format_string("%s#%02d", F.col("sid").cast("string"), F.col("seq")))


def ended_by(units: DataFrame, order: Column) -> DataFrame:
    """next_ts, and whether a unit ends with the next one or with the session."""
    w = Window.partitionBy("sid").orderBy(order)
    return units.withColumns({"next_ts": F.lead("ts").over(w), "ended_by": F.when(F.lead(F.lit(1)).over(w).isNull(), "session_end").otherwise("next_unit")})


def boundaries(turns: DataFrame) -> DataFrame:
    """turns (sid, seq, text, ts_epoch, files) with boundary and reason.

    First turn; then a follow-up is never a boundary; then a gap of over half an hour; then disjoint files; then a task
    pattern. The files to be disjoint from are those since the last boundary, so this fold needs the session's turns in
    order; all else is a flag of its own.
    """
    w = Window.partitionBy("sid").orderBy("seq")
    gap = F.coalesce(F.col("ts_epoch") - F.lag("ts_epoch").over(w) > GAP_SECONDS, F.lit(False))
    flags = turns.withColumns({"gap": gap, "followup": X.looks_like_followup(F.col("text")), "pattern": X.looks_like_task_start(F.col("text"))})
    turn = F.struct("seq", "gap", "followup", "pattern", F.coalesce("files", F.array().cast("array<string>")).alias("files"))
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<struct<seq:int,reason:string>>").alias("out"))

    def step(a: Column, t: Column) -> Column:
        disjoint = (F.size(a["seen"]) > 0) & (F.size(t["files"]) > 0) & ~F.arrays_overlap(a["seen"], t["files"])
        reason = (
            F.when(F.size(a["out"]) == 0, "B_FIRST").when(t["followup"], F.lit(None).cast("string")).when(t["gap"], "B_TIME_GAP")
            .when(disjoint, "B_FILE_DISJOINT").when(t["pattern"], "B_TASK_PATTERN")
        )
        seen = F.when(reason.isNotNull(), t["files"]).otherwise(F.array_union(a["seen"], t["files"]))
        return F.struct(seen.alias("seen"), F.concat(a["out"], F.array(F.struct(t["seq"].cast("int").alias("seq"), reason.alias("reason")))).alias("out"))

    folded = flags.groupBy("sid").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    out = folded.select("sid", F.explode(F.aggregate("turns", start, step, lambda a: a["out"])).alias("o")).select("sid", "o.seq", "o.reason")
    return out.withColumns({"boundary": F.col("reason").isNotNull(), "confidence": F.when(F.col("reason").isNotNull(), X.boundary_confidence(F.col("reason")))})


def step_intervals(spans: DataFrame, steps: DataFrame) -> DataFrame:
    """(unit_id, sid, lo, hi) of the steps from start up to before end, exact for timelines that are not monotone.

    spans: unit_id, sid, start, end (null: open). steps: sid, idx, ts. lo is the first step at or after start, else the
    last step; hi is the last step before the first one at or after end. Both are null without a start or any step.
    Starts, ends and steps of a session are ordered together and looked up with one window, so the work grows with
    their number and not with its square.
    """
    before = F.lag("idx").over(Window.partitionBy("sid").orderBy("idx"))
    none = F.lit(None).cast("string")
    kind = steps.schema["idx"].dataType
    marks = steps.select("sid", F.col("ts").alias("t"), F.struct("idx", before.alias("before")).alias("s"), none.alias("unit_id"), none.alias("side"))
    empty = F.lit(None).cast(marks.schema["s"].dataType).alias("s")
    ends = spans.select("sid", F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit("lo").alias("side")), F.struct(F.col("end").alias("t"), F.lit("hi").alias("side")))).alias("e"), "unit_id")
    both = marks.unionByName(ends.select("sid", "e.t", empty, F.col("unit_id").cast("string").alias("unit_id"), "e.side"))
    at_or_after = Window.partitionBy("sid").orderBy("t").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    found = both.withColumns({"hit": F.min("s").over(at_or_after), "last": F.max("s.idx").over(Window.partitionBy("sid"))}).where("unit_id is not null")
    out = found.groupBy("unit_id", "sid").agg(
        F.max("last").cast(kind).alias("last"), F.max(F.when(F.col("side") == "lo", F.col("t"))).isNotNull().alias("begins"),
        F.max(F.when((F.col("side") == "lo") & F.col("t").isNotNull(), F.col("hit.idx"))).alias("first"), F.max(F.when((F.col("side") == "hi") & F.col("t").isNotNull(), F.col("hit"))).alias("stop"),
    )
    lo = F.when(F.col("begins"), F.coalesce("first", "last"))
    hi = F.when(F.col("stop").isNull(), F.col("last")).otherwise(F.coalesce("stop.before", lo))
    return out.select("unit_id", "sid", lo.alias("lo"), F.when(F.col("begins"), F.greatest(lo, hi)).alias("hi"))


def enforce_partition(intervals: DataFrame) -> DataFrame:
    """lo raised above all earlier hi of the session; both null if nothing is left. Null intervals do not count."""
    w = Window.partitionBy("sid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    lo = F.greatest(F.col("lo"), F.coalesce(F.max("hi").over(w) + 1, F.col("lo")))
    out = intervals.withColumn("__lo", F.when(F.col("lo").isNotNull(), lo))
    fine = F.col("__lo") <= F.col("hi")
    return out.withColumns({"lo": F.when(fine, F.col("__lo")), "hi": F.when(fine, F.col("hi"))}).drop("__lo")


def interval_faults(intervals: DataFrame) -> DataFrame:
    """Intervals that overlap the one before or run backward."""
    w = Window.partitionBy("sid").orderBy("seq")
    kept = intervals.where("lo is not null")
    out = kept.withColumns({"overlaps": F.coalesce(F.col("lo") <= F.lag("hi").over(w), F.lit(False)), "backward": F.coalesce(F.col("lo") < F.lag("lo").over(w), F.lit(False))})
    return out.where("overlaps or backward")


def measures(steps: DataFrame, *keys: str) -> DataFrame:
    """Per-group measures of steps (tool, is_error, path, command)."""
    paths = F.array_sort(F.collect_set("path"))
    out = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.count("tool").alias("n_tool_calls"),
        F.array_sort(F.collect_set("tool")).alias("unique_tools"),
        F.count_if(F.col("is_error")).alias("error_ops"),
        F.count_if(F.col("is_edit")).alias("edit_ops"),
        F.size(F.collect_set("path")).cast("long").alias("n_paths"),
        F.substring(F.sha2(F.array_join(paths, "\n"), 256), 1, 16).alias("path_hash"),
    )
    return out


def measures_in_intervals(intervals: DataFrame, steps: DataFrame) -> DataFrame:
    """Measures of the steps inside each interval, 0 where it is null or empty. Every interval gives a row. Intervals
    meet the steps of the stretches of STRETCH steps that they touch, not all steps of their session."""
    s = steps.select("sid", F.col("idx").alias("i"), "is_edit", "is_error", "tool", F.floor(F.col("idx") / STRETCH).alias("stretch"))
    touched = F.when(F.col("lo") <= F.col("hi"), F.sequence(F.floor(F.col("lo") / STRETCH), F.floor(F.col("hi") / STRETCH)))
    parts = intervals.withColumn("stretch", F.explode_outer(touched))
    same = (parts["sid"] == s["sid"]) & (parts["stretch"] == s["stretch"]) & s["i"].between(parts["lo"], parts["hi"])
    joined = parts.join(s, same, "left").drop(s["sid"], s["stretch"])
    return joined.groupBy("unit_id").agg(F.count("i").alias("n_steps"), F.count_if("is_edit").alias("edit_ops"), F.count_if("is_error").alias("error_ops"), F.count_distinct("tool").alias("n_tools"))


def mode(df: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """(key, value, hits): the most frequent non-null value, ties by first position."""
    counted = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("hits"), F.min(position).alias("first"))
    best = counted.groupBy(key).agg(F.min(F.struct(-F.col("hits"), "first", value, "hits")).alias("b"))
    return best.select(key, F.col(f"b.{value}").alias(value), F.col("b.hits").alias("hits"))


def resolve_repo(wd: Column, raw: Column, traj: Column) -> tuple[Column, Column]:
    """(repo, resolution): what was touched outvotes both declarations; between those the working directory wins."""
    top = F.coalesce(traj, wd, raw)
    agree = sum((F.when(c == top, 1).otherwise(0) for c in (wd, raw, traj)), F.lit(0))
    present = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in (wd, raw, traj)), F.lit(0))
    resolution = (
        F.when(present == 0, "unresolved").when(agree == 3, "direct").when((agree == present) & (present == 1), "inferred")
        .when(agree >= 2, F.when((agree == present) | (agree >= 2), "voted")).otherwise("conflict")
    )
    return top, resolution


def as_of(events: DataFrame, history: DataFrame, by: list[str], at: str, time: str, value: str) -> DataFrame:
    """events with the value of the last history row at or before their time: both are ordered together, so nothing is
    joined by range."""
    both = events.withColumns({"__t": F.col(at), "__kind": F.lit(1), value: F.lit(None).cast(history.schema[value].dataType)})
    past = history.select(*by, F.col(time).alias("__t"), F.lit(0).alias("__kind"), value)
    w = Window.partitionBy(*by).orderBy("__t", "__kind", value)
    all_rows = both.unionByName(past, allowMissingColumns=True).withColumn("__v", F.last(value, ignorenulls=True).over(w))
    return all_rows.where("__kind = 1").withColumn(value, F.col("__v")).drop("__v", "__t", "__kind")


def failed_actions(actions: DataFrame, observations: DataFrame) -> DataFrame:
    """actions with failed: the last observation of the same tool use is an error; none: false."""
    last = observations.groupBy("sid", "tool_use_id").agg(F.max(F.struct("idx", "is_error")).alias("o")).select("sid", "tool_use_id", F.col("o.is_error").alias("failed"))
    return actions.join(last, ["sid", "tool_use_id"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
