"""Ordered filters: verdict columns instead of deletion, funnels, ad-hoc queries over units, tallies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INTERRUPTED = ["interrupted", "aborted", "cancelled"]
TARGET_CATEGORIES = ["bug_fix", "feature_impl", "refactor", "test_authoring"]
GROUPABLE = ["repo", "category", "vendor", "agent_source", "repo_resolution", "boundary_confidence", "secret_severity", "band"]


def session_drop_reason(steps: Column, tools: Column, tokens: Column, excluded: Column) -> Column:
    """The first rule that fits, or null; null counters are 0."""
    steps, tools, tokens = (F.coalesce(c, F.lit(0)) for c in (steps, tools, tokens))
    return (
        F.when(steps == 0, "R1_EMPTY").when(steps < 3, "R2_TOO_SHORT").when((steps < 6) & (tools == 0), "R3_NO_ACTION")
        .when(tokens < 1000, "R4_TOO_FEW_TOKENS").when(F.coalesce(excluded, F.lit(False)), "E_SELF_REFERENTIAL")
    )


def filter_sessions(sessions: DataFrame) -> DataFrame:
    """All sessions with keep, drop_reason and forced_split (kept, but the agent was interrupted)."""
    reason = session_drop_reason(F.col("steps"), F.col("tool_call_count"), F.col("total_tokens"), F.col("excluded_hit"))
    out = sessions.withColumn("drop_reason", reason).withColumn("keep", F.col("drop_reason").isNull())
    return out.withColumn("forced_split", F.col("keep") & F.lower(F.coalesce("exit_status", F.lit(""))).isin(INTERRUPTED))


def unit_verdict(interrupted: Column, has_raw: Column, session_steps: Column) -> Column:
    return F.when(interrupted, "U_INTERRUPTED").when(~has_raw & (session_steps > 100), "U_NO_BOUNDARY")


def band(edit_ops: Column) -> Column:
    n = F.coalesce(edit_ops, F.lit(0))
    return F.when(n <= 3, "S").when(n <= 10, "M").otherwise("L")


def next_unit_is_high(units: DataFrame) -> DataFrame:
    """units with endpoint_high: the next unit of the session starts with high confidence, or there is none.

    Looks at all units, before any filter, and by next larger seq, so gaps in seq don't matter.
    """
    w = Window.partitionBy("sid").orderBy("seq")
    last = F.lead("seq").over(w).isNull()
    return units.withColumn("endpoint_high", last | F.coalesce(F.lead("boundary_confidence").over(w) == "high", F.lit(False)))


def candidate_steps(repos: Sequence[str]) -> list[tuple[str, Column]]:
    """The eight conditions of candidate selection, in order. Unknown severity is not high; unknown dates are early."""
    return [
        ("boundaries_high", (F.col("boundary_confidence") == "high") & F.col("endpoint_high")),
        ("target_repo", F.col("repo").isin(*repos) & ~F.coalesce(F.col("repo_resolution").isin("unresolved", "conflict"), F.lit(False))),
        ("edits", F.coalesce("edit_ops", F.lit(0)) >= 1),
        ("tests", F.coalesce("n_test_cmds", F.lit(0)) > 0),
        ("not_leaking", ~F.col("secret_severity").eqNullSafe("high")),
        ("recent", F.coalesce("started_at", F.lit("")) >= F.col("since")),
        ("category", F.col("category").isin(TARGET_CATEGORIES)),
        ("instruction_length", F.coalesce("instruction_len", F.lit(0)).between(60, 1200)),
    ]


def with_chain(units: DataFrame, repos: Sequence[str], since: str) -> DataFrame:
    """units with pass_1 .. pass_8: whether all conditions up to that one hold."""
    out, before = next_unit_is_high(units).withColumn("since", F.lit(since)), F.lit(True)
    for i, (_, condition) in enumerate(candidate_steps(repos), 1):
        out = out.withColumn(f"pass_{i}", before & F.coalesce(condition, F.lit(False)))
        before = F.col(f"pass_{i}")
    return out.drop("since")


def funnel(units: DataFrame, repos: Sequence[str], since: str) -> DataFrame:
    """(step, name, remaining), from one pass over the units."""
    names = ["all", *(n for n, _ in candidate_steps(repos))]
    counted = with_chain(units, repos, since).agg(F.count(F.lit(1)).alias("c0"), *(F.count_if(f"pass_{i}").alias(f"c{i}") for i in range(1, 9)))
    rows = F.array(*(F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(f"c{i}").alias("remaining")) for i, n in enumerate(names)))
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def candidates(units: DataFrame, repos: Sequence[str], since: str) -> DataFrame:
    return with_chain(units, repos, since).where("pass_8").withColumn("band", band(F.col("edit_ops")))


def matching(equal: dict[str, str] | None = None, contains: dict[str, str] | None = None, tags: Sequence[str] = (), least: dict[str, int] | None = None, not_equal: dict[str, str] | None = None) -> Column:
    """A condition from equalities, case-insensitive substrings, required tags, minima and exclusions (null is not excluded)."""
    out = F.lit(True)
    for c, v in (equal or {}).items():
        out = out & (F.col(c) == v)
    for c, v in (contains or {}).items():
        out = out & F.lower(F.coalesce(c, F.lit(""))).contains(v.lower())
    for t in tags:
        out = out & F.array_contains("tags", t)
    for c, v in (least or {}).items():
        out = out & (F.coalesce(c, F.lit(0)) >= v)
    for c, v in (not_equal or {}).items():
        out = out & ~F.col(c).eqNullSafe(v)
    return out


def top_groups(df: DataFrame, dims: Sequence[str], most: int = 30) -> DataFrame:
    """Counts by text of dimensions (null is None), largest first, ties by key, with shares of all rows."""
    if bad := [d for d in dims if d not in GROUPABLE]:
        raise ValueError(f"not groupable: {', '.join(bad)}")
    keys = [F.coalesce(F.col(d).cast("string"), F.lit("None")).alias(d) for d in dims]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counted.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total")).drop("total").orderBy(F.desc("n"), *dims).limit(most)


def overview(df: DataFrame) -> DataFrame:
    """Counts and the upper median of edit operations. The median reads a histogram, not a list of all values."""
    edits = df.where(F.col("edit_ops").isNotNull()).groupBy("edit_ops").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("edit_ops")
    total = F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = edits.withColumns({"upto": F.sum("n").over(w), "all": total})
    middle = ranked.where(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min("edit_ops").alias("median_edit_ops"))
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("edit_ops") >= 1).alias("with_edits"), F.count_if(F.col("n_test_cmds") >= 1).alias("with_tests"), F.count_if(F.col("instruction_len") >= 60).alias("with_instruction"))
    return counts.crossJoin(middle)


def tallies(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(dimension, key, n) for every dimension by itself, in one pass with grouping sets."""
    keys = [F.col(d).cast("string").alias(d) for d in dims]
    grouped = df.select(*keys).groupingSets([[d] for d in dims], *dims).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    name, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dims):
        own = F.col("g") == (1 << len(dims)) - 1 - (1 << (len(dims) - 1 - i))
        name, key = F.when(own, d).otherwise(name), F.when(own, F.col(d)).otherwise(key)
    return grouped.select(name.alias("dimension"), F.coalesce(key, F.lit("None")).alias("key"), "n")
