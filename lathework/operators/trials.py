"""Facts about scored trials: what counts, rates by task and group, costs, stability, comparisons between runs."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.functions import stats
from lathework.functions.text import text_of
from lathework.operators.joins import at_ranks

# Fixed values that results depend on.
BUDGET_EXCEPTIONS = ["AgentTimeoutError"]
UPSTREAM_SIGNS = ["socket connection", "closed unexpectedly", "econnreset", "etimedout", "fetch failed", "502 bad gateway", "503 service unavailable", "504 gateway"]
SMALL_CELL = 5


def with_flags(trials: DataFrame) -> DataFrame:
    """trials with upstream_failure, budget_exhausted, infra_failure and solved.

    No reward is infrastructure; so are a broken upstream line (by subtype and error text) and any exception that is no
    exhausted budget. A timeout with a reward is a result.
    """
    errors = F.lower(F.array_join(F.coalesce("errors", F.array().cast("array<string>")), " "))
    upstream = F.lit(False)
    for sign in UPSTREAM_SIGNS:
        upstream = upstream | errors.contains(sign)
    out = trials.withColumns({
        "upstream_failure": F.coalesce(F.col("subtype") == "error_during_execution", F.lit(False)) & upstream,
        "budget_exhausted": F.coalesce(F.col("exception").isin(BUDGET_EXCEPTIONS), F.lit(False)),
        "solved": F.coalesce(F.col("reward") == 1.0, F.lit(False)),
    })
    raised = text_of(F.col("exception")) != ""
    return out.withColumn("infra_failure", F.col("reward").isNull() | F.col("upstream_failure") | (raised & ~F.col("budget_exhausted")))


def dual_source_ok(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a - b) < 1e-9, F.lit(False))


def latest_run_per_task(trials: DataFrame) -> DataFrame:
    """All attempts of a task's latest run (by name)."""
    w = Window.partitionBy("task").orderBy(F.desc("run"))
    return trials.withColumn("__r", F.dense_rank().over(w)).where("__r = 1").drop("__r")


def task_rates(trials: DataFrame) -> DataFrame:
    """(task, attempts, usable, rate): the share of usable attempts that solve it; null without one."""
    return with_flags(trials).groupBy("task").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(~F.col("infra_failure")).alias("usable"),
        F.avg(F.when(~F.col("infra_failure"), F.col("solved").cast("double"))).alias("rate"),
    )


def pass_at_1(trials: DataFrame) -> DataFrame:
    """One row: mean of task rates over scored tasks, with a Wilson interval around the rounded sum."""
    out = task_rates(trials).agg(F.count("rate").alias("n"), F.round(F.coalesce(F.sum("rate"), F.lit(0.0)), 4).alias("passed"), F.count_if(F.col("rate").isNull()).alias("excluded"))
    interval = stats.wilson(F.bround("passed"), F.col("n"))
    return out.withColumn("w", interval).select("n", "passed", "excluded", F.col("w.p").alias("p"), F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"), ((F.col("w.hi") - F.col("w.lo")) / 2 * 100).alias("halfwidth_pp"))


def cells(members: DataFrame, trials: DataFrame) -> DataFrame:
    """members (label, task) counted: solved, excluded (ran, no usable attempt), missing (did not run), scored; a
    percentage only from five scored tasks on."""
    joined = members.distinct().join(task_rates(trials), "task", "left")
    out = joined.groupBy("label").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.coalesce(F.sum(F.bround("rate")), F.lit(0.0)).cast("long").alias("solved"),
        F.count_if(F.col("attempts").isNotNull() & F.col("rate").isNull()).alias("excluded"),
        F.count_if(F.col("attempts").isNull()).alias("missing"),
    )
    out = out.withColumn("scored", F.col("tasks") - F.col("excluded") - F.col("missing"))
    return out.withColumn("pct", F.when(F.col("scored") >= SMALL_CELL, F.round(100 * F.col("solved") / F.nullif(F.col("scored"), F.lit(0)), 1)))


def side_split(trials: DataFrame) -> DataFrame:
    """Means and full counts of both sides over usable trials, regressions, and failures of the grader."""
    usable = with_flags(trials).where("not infra_failure")
    return usable.agg(
        F.avg("f2p").alias("f2p_mean"), F.avg("p2p").alias("p2p_mean"),
        F.count_if(F.col("f2p") == 1.0).alias("f2p_full"), F.count_if(F.col("p2p") == 1.0).alias("p2p_full"),
        F.array_join(F.array_sort(F.collect_set(F.when((F.col("p2p") < 1.0) & F.col("p2p_error").isNull(), F.col("task")))), ",").alias("regressions"),
        F.array_join(F.array_sort(F.collect_set(F.when((F.col("p2p") < 1.0) & F.col("p2p_error").isNotNull(), F.col("task")))), ",").alias("grader_failures"),
    )


def cost_stats(trials: DataFrame) -> DataFrame:
    """Over trials that report a cost: total, mean, averaged median, the element at int(0.9 n), maximum."""
    sums = trials.agg(F.count("cost_usd").alias("n"), F.sum("cost_usd").alias("total"), F.avg("cost_usd").alias("mean"), F.max("cost_usd").alias("max"))
    places = {"lower": lambda n: F.floor((n - 1) / 2), "upper": lambda n: F.floor(n / 2), "p90": lambda n: F.least(n - 1, F.floor(n * 0.9))}
    ranked = at_ranks(trials, "cost_usd", places).select(((F.col("lower") + F.col("upper")) / 2).alias("median"), "p90")
    return sums.crossJoin(ranked).select("n", "total", "mean", "median", "max", "p90")


def controlled(trials: DataFrame, columns: list[str]) -> DataFrame:
    """(name, distinct_values, missing): what was held fixed, by column."""
    aggregates = [a for c in columns for a in (F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(f"v_{c}"), F.count_if(F.col(c).isNull()).alias(f"m_{c}"))]
    rows = F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"v_{c}").alias("distinct_values"), F.col(f"m_{c}").alias("missing")) for c in columns))
    return trials.agg(*aggregates).select(F.explode(rows).alias("r")).select("r.*")


def stability(trials: DataFrame) -> DataFrame:
    """(task, runs, passed, state): stable if reward is 1 in every run of all; partial if not in all runs. Rows without
    a reward did not run; of several rows for a run the last by reward counts."""
    seen = trials.where(F.col("reward").isNotNull()).groupBy("task", "run").agg(F.max("reward").alias("reward"))
    total = seen.agg(F.count_distinct("run").alias("total"))
    out = seen.groupBy("task").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("reward") == 1.0).alias("passed")).crossJoin(F.broadcast(total))
    state = F.when(F.col("runs") < F.col("total"), "partial").when(F.col("passed") == F.col("runs"), "stable").when(F.col("passed") > 0, "unstable").otherwise("never")
    return out.withColumn("state", state).drop("total")


def epsilon(stable: DataFrame, holdout: DataFrame) -> Fraction:
    """The share of stable tasks that fail in the holdout, at least one tenth; a stable task that did not run raises."""
    row = stable.join(holdout.groupBy("task").agg(F.max("reward").alias("r")), "task", "left").agg(F.count(F.lit(1)).alias("n"), F.count("r").alias("ran"), F.count_if(F.col("r") != 1.0).alias("failed")).first()
    if not row.n or row.ran < row.n:
        raise ValueError(f"{row.n - row.ran} of {row.n} stable tasks did not run in the holdout")
    return max(Fraction(row.failed, row.n), stats.EPSILON_FLOOR)


def thresholds(stable: DataFrame, eps: Fraction = stats.EPSILON_FLOOR) -> DataFrame:
    """(n_s, eps, m, detect, degraded) for the stable tasks; degraded: too few of them, or no threshold exists."""
    n = stable.count()
    m = stats.block_threshold(n, eps) if n else None
    detect = None if m is None else float(stats.detection_probability(n, m))
    row = (n, float(eps), m, detect, n < stats.MIN_STABLE or m is None)
    return stable.sparkSession.createDataFrame([row], "n_s long, eps double, m long, detect double, degraded boolean")


def flips(trials: DataFrame) -> DataFrame:
    """(run_a, run_b, common, flipped, rate) for all pairs of runs over common tasks; no common task: no row."""
    best = trials.where(F.col("reward").isNotNull()).groupBy("run", "task").agg((F.max("reward") == 1.0).alias("ok"))
    a = best.select(F.col("run").alias("run_a"), "task", F.col("ok").alias("ok_a"))
    b = best.select(F.col("run").alias("run_b"), "task", F.col("ok").alias("ok_b"))
    out = a.join(b, "task").where("run_a < run_b").groupBy("run_a", "run_b").agg(F.count(F.lit(1)).alias("common"), F.count_if(F.col("ok_a") != F.col("ok_b")).alias("flipped"))
    return out.withColumn("rate", F.col("flipped") / F.col("common"))
