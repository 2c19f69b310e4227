"""Queries on trials, gates and statistics."""

from fractions import Fraction

from pyspark.sql import functions as F

from lathework.functions import stats
from lathework.operators import gates, trials
from lathework.plans.registry import adapted, cte, literal, query, table, values

SIGNS = " OR ".join(f"contains(lower(error_text), {literal(s)})" for s in trials.UPSTREAM_SIGNS)
FLAGS = f"""{cte('trials')}, flagged AS (SELECT *, coalesce(subtype = 'error_during_execution', FALSE) AND ({SIGNS}) AS upstream_failure, coalesce(exception IN ('AgentTimeoutError'), FALSE) AS budget_exhausted, coalesce(reward = 1.0, FALSE) AS solved FROM trials),
t AS (SELECT *, reward IS NULL OR upstream_failure OR (coalesce(exception, '') <> '' AND NOT budget_exhausted) AS infra_failure FROM flagged)"""
RATES = f"{FLAGS}, rates AS (SELECT task, count(*) AS attempts, count_if(NOT infra_failure) AS usable, avg(CASE WHEN NOT infra_failure THEN solved::INT::DOUBLE END) AS rate FROM t GROUP BY task)"


def facts(spark, sf):
    return adapted(spark, sf, "trials").withColumn("errors", F.array("error_text"))


@query("fi20_trial_flags", f"WITH {FLAGS} SELECT trial_id, upstream_failure, budget_exhausted, infra_failure, solved FROM t")
def _(spark, sf):
    return trials.with_flags(facts(spark, sf)).select("trial_id", "upstream_failure", "budget_exhausted", "infra_failure", "solved")


@query("fi21_dual_source", f"WITH {cte('trials')} SELECT trial_id, coalesce(abs(reward - reward_txt) < 1e-9, FALSE) AS ok FROM trials")
def _(spark, sf):
    return facts(spark, sf).select("trial_id", trials.dual_source_ok(F.col("reward"), F.col("reward_txt")).alias("ok"))


@query("io17_latest_run_per_task", f"WITH {cte('trials')} SELECT trial_id, task, run FROM (SELECT *, dense_rank() OVER (PARTITION BY task ORDER BY run DESC) AS r FROM trials) WHERE r = 1")
def _(spark, sf):
    return trials.latest_run_per_task(facts(spark, sf)).select("trial_id", "task", "run")


@query("ag14_task_rates", f"WITH {RATES} SELECT task, attempts, usable, round(rate, 9) AS rate FROM rates")
def _(spark, sf):
    return trials.task_rates(facts(spark, sf)).withColumn("rate", F.round("rate", 9))


WILSON = lambda p, n: f"CASE WHEN {n} = 0 THEN 0.0 ELSE {p}::DOUBLE / {n} END AS p, CASE WHEN {n} = 0 THEN 0.0 ELSE greatest(0.0, ({p}::DOUBLE / {n} + {stats.Z95 ** 2} / (2 * {n})) / (1 + {stats.Z95 ** 2} / {n}) - {stats.Z95} * sqrt({p}::DOUBLE / {n} * (1 - {p}::DOUBLE / {n}) / {n} + {stats.Z95 ** 2} / (4.0 * {n} * {n})) / (1 + {stats.Z95 ** 2} / {n})) END AS lo, CASE WHEN {n} = 0 THEN 0.0 ELSE least(1.0, ({p}::DOUBLE / {n} + {stats.Z95 ** 2} / (2 * {n})) / (1 + {stats.Z95 ** 2} / {n}) + {stats.Z95} * sqrt({p}::DOUBLE / {n} * (1 - {p}::DOUBLE / {n}) / {n} + {stats.Z95 ** 2} / (4.0 * {n} * {n})) / (1 + {stats.Z95 ** 2} / {n})) END AS hi"


@query("ag14_pass_at_1", f"WITH {RATES}, a AS (SELECT count(rate) AS n, coalesce(sum(rate), 0.0) AS s, count_if(rate IS NULL) AS excluded FROM rates), w AS (SELECT *, round_even(s, 0) AS k FROM a), x AS (SELECT n, s, excluded, {WILSON('k', 'n')} FROM w) SELECT n, round(s, 4) AS passed, excluded, round(p, 6) AS p, round(lo, 6) AS lo, round(hi, 6) AS hi, round((hi - lo) / 2 * 100, 4) AS halfwidth_pp FROM x")
def _(spark, sf):
    out = trials.pass_at_1(facts(spark, sf))
    return out.select("n", "passed", "excluded", *(F.round(c, 6).alias(c) for c in ("p", "lo", "hi")), F.round("halfwidth_pp", 4).alias("halfwidth_pp"))


MEMBERS = "members AS (SELECT DISTINCT concat('T', CAST(c_custkey % 70 AS VARCHAR)) AS task, c_mktsegment AS label FROM customer)"


@query("ag15_cells", f"WITH {RATES}, {MEMBERS}, c AS (SELECT label, count(*) AS tasks, coalesce(sum(round_even(rate, 0)), 0)::BIGINT AS solved, count_if(attempts IS NOT NULL AND rate IS NULL) AS excluded, count_if(attempts IS NULL) AS missing FROM members LEFT JOIN rates USING (task) GROUP BY label) SELECT *, tasks - excluded - missing AS scored, CASE WHEN tasks - excluded - missing >= 5 THEN round(100 * solved / (tasks - excluded - missing), 1) END AS pct FROM c")
def _(spark, sf):
    members = table(spark, sf, "customer").select(F.concat(F.lit("T"), (F.col("c_custkey") % 70).cast("string")).alias("task"), F.col("c_mktsegment").alias("label"))
    return trials.cells(members, facts(spark, sf))


@query("ag16_side_split", f"WITH {FLAGS}, u AS (SELECT * FROM t WHERE NOT infra_failure) SELECT round(avg(f2p), 6) AS f2p_mean, round(avg(p2p), 6) AS p2p_mean, count_if(f2p = 1.0) AS f2p_full, count_if(p2p = 1.0) AS p2p_full, coalesce(string_agg(DISTINCT CASE WHEN p2p < 1 AND p2p_error IS NULL THEN task END, ',' ORDER BY CASE WHEN p2p < 1 AND p2p_error IS NULL THEN task END), '') AS regressions, coalesce(string_agg(DISTINCT CASE WHEN p2p < 1 AND p2p_error IS NOT NULL THEN task END, ',' ORDER BY CASE WHEN p2p < 1 AND p2p_error IS NOT NULL THEN task END), '') AS grader_failures FROM u")
def _(spark, sf):
    return trials.side_split(facts(spark, sf)).withColumns({c: F.round(c, 6) for c in ("f2p_mean", "p2p_mean")})


@query("ag17_cost_stats", f"WITH {cte('trials')}, k AS (SELECT list_sort(list(cost_usd)) AS l, count(cost_usd) AS n, sum(cost_usd) AS s, avg(cost_usd) AS a, median(cost_usd) AS m, max(cost_usd) AS x FROM trials) SELECT n, round(s, 4) AS total, round(a, 6) AS mean, round(m, 6) AS median, round(x, 6) AS max, round(l[least(n - 1, floor(n * 0.9)::BIGINT) + 1], 6) AS p90 FROM k")
def _(spark, sf):
    out = trials.cost_stats(facts(spark, sf))
    return out.select("n", F.round("total", 4).alias("total"), *(F.round(c, 6).alias(c) for c in ("mean", "median", "max", "p90")))


@query("ag18_controlled", f"WITH {cte('trials')} SELECT 'model' AS name, coalesce(string_agg(DISTINCT model, ',' ORDER BY model), '') AS distinct_values, count_if(model IS NULL) AS missing FROM trials UNION ALL SELECT 'subtype', coalesce(string_agg(DISTINCT subtype, ',' ORDER BY subtype), ''), count_if(subtype IS NULL) FROM trials")
def _(spark, sf):
    return trials.controlled(facts(spark, sf), ["model", "subtype"])


STABLE = f"{cte('trials')}, seen AS (SELECT task, run, max(reward) AS reward FROM trials WHERE reward IS NOT NULL GROUP BY task, run), st AS (SELECT task, count(*) AS runs, count_if(reward = 1.0) AS passed, CASE WHEN count(*) < (SELECT count(DISTINCT run) FROM seen) THEN 'partial' WHEN count_if(reward = 1.0) = count(*) THEN 'stable' WHEN count_if(reward = 1.0) > 0 THEN 'unstable' ELSE 'never' END AS state FROM seen GROUP BY task)"


@query("ag20_stability", f"WITH {STABLE} SELECT * FROM st")
def _(spark, sf):
    return trials.stability(facts(spark, sf))


@query("ag22_flips", f"WITH {cte('trials')}, b AS (SELECT run, task, max(reward) = 1.0 AS ok FROM trials WHERE reward IS NOT NULL GROUP BY run, task) SELECT x.run AS run_a, y.run AS run_b, count(*) AS common, count_if(x.ok <> y.ok) AS flipped, round(count_if(x.ok <> y.ok)::DOUBLE / count(*), 6) AS rate FROM b x JOIN b y ON x.task = y.task AND x.run < y.run GROUP BY ALL")
def _(spark, sf):
    return trials.flips(facts(spark, sf)).withColumn("rate", F.round("rate", 6))


@query("ag25_best_reward", f"WITH {cte('trials')} SELECT task, max(reward) AS best FROM trials GROUP BY task")
def _(spark, sf):
    return facts(spark, sf).groupBy("task").agg(F.max("reward").alias("best"))


@query("ag32_tiers", f"WITH {cte('trials')} SELECT model AS tier, count(DISTINCT task) AS tasks, string_agg(DISTINCT task, ',' ORDER BY task) AS members FROM trials GROUP BY model")
def _(spark, sf):
    return facts(spark, sf).groupBy(F.col("model").alias("tier")).agg(F.count_distinct("task").alias("tasks"), F.array_join(F.array_sort(F.collect_set("task")), ",").alias("members"))


ORACLE_GATE = "CASE WHEN exception IS NOT NULL THEN 'exception' WHEN NOT coalesce(abs(reward - reward_txt) < 1e-9, FALSE) THEN 'sources_disagree' WHEN reward = 1.0 THEN '' WHEN f2p = 1.0 AND p2p IS DISTINCT FROM 1.0 THEN 'breaks_others' ELSE 'not_solved' END"
NOP_GATE = "CASE WHEN exception IS NOT NULL THEN 'exception' WHEN NOT coalesce(abs(reward - reward_txt) < 1e-9, FALSE) THEN 'sources_disagree' WHEN f2p = 1.0 THEN 'green_without_change' WHEN p2p = 0.0 THEN 'broken_environment' WHEN f2p = 0.0 AND p2p = 1.0 THEN '' ELSE 'unexpected_values' END"
CODES = lambda gate: f"SELECT trial_id, reason = '' AS ok, reason, reason IN ('exception', 'sources_disagree', 'breaks_others', 'broken_environment') AS infra FROM (SELECT trial_id, {gate} AS reason FROM trials)"


@query("qa10_gate_oracle", f"WITH {cte('trials')} {CODES(ORACLE_GATE)}")
def _(spark, sf):
    return facts(spark, sf).withColumn("v", gates.gate_oracle()).select("trial_id", "v.ok", "v.reason", "v.infra")


@query("qa11_gate_nop", f"WITH {cte('trials')} {CODES(NOP_GATE)}")
def _(spark, sf):
    return facts(spark, sf).withColumn("v", gates.gate_nop()).select("trial_id", "v.ok", "v.reason", "v.infra")


@query("qa12_gate_consistency", f"WITH {cte('trials')}, g AS (SELECT task, count(*) AS n, count(exception) AS raised, count(DISTINCT reward) + max((reward IS NULL)::INT) AS v FROM trials GROUP BY task), r AS (SELECT task, CASE WHEN raised > 0 THEN 'exception' WHEN n < 2 THEN 'too_few_runs' WHEN v = 1 THEN '' ELSE 'inconsistent' END AS reason FROM g) SELECT task, reason = '' AS ok, reason, reason IN ('exception', 'too_few_runs') AS infra FROM r")
def _(spark, sf):
    return gates.gate_consistency(facts(spark, sf))


DIAG = "trial_id, reward, subtype, reward IS NOT NULL AS has_reward, trial_id % 6 <> 0 AS started, trial_id % 8 <> 1 AS judged_all, trial_id % 3 AS load_failures, trial_id % 4 AS write_calls, upstream_failure"
ZERO = f"""{FLAGS}, d AS (SELECT {DIAG} FROM t), z AS (SELECT *, CASE WHEN NOT has_reward THEN 'running' WHEN reward = 1.0 THEN 'solved' WHEN upstream_failure THEN 'infra_upstream_disconnect' WHEN NOT started THEN 'infra_agent_not_launched' WHEN NOT judged_all AND load_failures > 0 THEN 'true_zero_missing_symbol' WHEN NOT judged_all THEN 'grader_incomplete' WHEN write_calls = 0 THEN 'true_zero_no_attempt' ELSE 'true_zero_wrong_fix' END AS verdict FROM d),
f AS (SELECT *, CASE WHEN verdict IN ('true_zero_wrong_fix', 'true_zero_missing_symbol', 'true_zero_no_attempt') AND NOT coalesce(subtype = 'success', FALSE) THEN 'true_zero_unfinished' ELSE verdict END AS final FROM z)"""


def diagnosed(spark, sf):
    k = F.col("trial_id")
    d = trials.with_flags(facts(spark, sf)).withColumns({"has_reward": F.col("reward").isNotNull(), "started": k % 6 != 0, "judged_all": k % 8 != 1, "load_failures": k % 3, "write_calls": k % 4})
    d = d.withColumn("verdict", gates.zero_diagnosis())
    return d.withColumn("final", gates.reclassify(F.col("verdict"), F.col("subtype")))


@query("qa13_zero_diagnosis", f"WITH {ZERO} SELECT trial_id, verdict, final FROM f")
def _(spark, sf):
    return diagnosed(spark, sf).select("trial_id", "verdict", "final")


@query("ag19_diagnosis_counts", f"WITH {ZERO} SELECT final, count(*) AS n, sum(write_calls)::BIGINT AS write_calls, count_if(subtype IS NULL) AS killed FROM f GROUP BY final")
def _(spark, sf):
    return diagnosed(spark, sf).groupBy("final").agg(F.count(F.lit(1)).alias("n"), F.sum("write_calls").alias("write_calls"), F.count_if(F.col("subtype").isNull()).alias("killed"))


@query("jo14_verdict_gather", f"WITH {cte('trials')}, g AS (SELECT task, bool_and(({ORACLE_GATE}) = '') AS oracle, bool_and(({NOP_GATE}) = '') AS nop FROM trials GROUP BY task) SELECT task, oracle, nop, oracle AND nop AS survives FROM g")
def _(spark, sf):
    v = facts(spark, sf).select("task", gates.gate_oracle()["ok"].alias("o"), gates.gate_nop()["ok"].alias("n"))
    return v.groupBy("task").agg(F.bool_and("o").alias("oracle"), F.bool_and("n").alias("nop")).withColumn("survives", F.col("oracle") & F.col("nop"))


@query("jo11_three_valued_writeback", f"WITH {cte('trials')}, s AS (SELECT task, count(*) AS leaks FROM trials WHERE p2p_error IS NOT NULL GROUP BY task), g AS (SELECT task, bool_and(reward = 1.0) AS oracle FROM trials WHERE run = 'r0' GROUP BY task) SELECT task, oracle, leaks = 0 AS clean FROM (SELECT DISTINCT task FROM trials) LEFT JOIN g USING (task) LEFT JOIN s USING (task)")
def _(spark, sf):
    t = facts(spark, sf)
    scanned = t.where("p2p_error is not null").groupBy("task").agg(F.count(F.lit(1)).alias("leaks"))
    gated = t.where("run = 'r0'").groupBy("task").agg(F.bool_and(F.col("reward") == 1.0).alias("oracle"))
    return t.select("task").distinct().join(gated, "task", "left").join(scanned, "task", "left").select("task", "oracle", (F.col("leaks") == 0).alias("clean"))


@query("qa21_side_score", "WITH req AS (SELECT o_custkey % 40 AS task, 'f' || (o_orderkey % 6) AS file FROM orders), s AS (SELECT l_suppkey % 40 AS task, 'f' || (l_orderkey % 6) AS file, sum(l_linenumber) AS tests, sum(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) AS failures FROM lineitem GROUP BY ALL), r AS (SELECT DISTINCT * FROM req) SELECT task, count(file) AS required, count_if(coalesce(tests > 0 AND failures = 0, FALSE)) AS green, CASE WHEN count_if(coalesce(tests > 0 AND failures = 0, FALSE)) = count(file) THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM r LEFT JOIN s USING (task, file) GROUP BY task")
def _(spark, sf):
    name = lambda c: F.concat(F.lit("f"), (F.col(c) % 6).cast("string"))
    required = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("task"), name("o_orderkey").alias("file")).distinct()
    suites = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 40).alias("task"), name("l_orderkey").alias("file"), F.col("l_linenumber").alias("tests"), (F.col("l_quantity") > 49).cast("int").alias("failures"))
    return gates.side_score(required, suites)


@query("qa03_share_gate", "SELECT 'english_share' AS gate, count_if(lang = 'en')::DOUBLE / count(*) >= 0.5 AS ok, round(count_if(lang = 'en')::DOUBLE / count(*), 4) AS share FROM documents WHERE n_chars > 100")
def _(spark, sf):
    return gates.share_gate(table(spark, sf, "documents"), "english_share", F.col("lang") == "en", 0.5, F.col("n_chars") > 100, 50)


@query("qa05_session_gate", f"WITH {cte('sessions')} SELECT gate, TRUE AS ok, concat('0 of ', n) AS detail FROM (SELECT unnest(['reason_legal', 'keep_iff_no_reason', 'interrupted_not_dropped_for_it']) AS gate, count(*) AS n FROM sessions)")
def _(spark, sf):
    from lathework.operators.selection import filter_sessions

    return gates.session_gate(filter_sessions(adapted(spark, sf, "sessions")))


@query("ma01_wilson", f"WITH k AS (SELECT p_partkey, p_size AS n, p_partkey % (p_size + 1) AS k FROM part), w AS (SELECT p_partkey, {WILSON('k', 'n')} FROM k) SELECT p_partkey, round(p, 6) AS p, round(lo, 6) AS lo, round(hi, 6) AS hi FROM w")
def _(spark, sf):
    k = F.col("p_partkey") % (F.col("p_size") + 1)
    return table(spark, sf, "part").select("p_partkey", stats.wilson(k, F.col("p_size")).alias("w")).select("p_partkey", *(F.round(f"w.{c}", 6).alias(c) for c in ("p", "lo", "hi")))


@query("ma02_min_detectable_delta", "SELECT n, CASE WHEN phi < pi() THEN round(100 * (pow(sin(phi / 2), 2) - 14.0 / 37), 4) END AS delta FROM (SELECT n, sqrt(2 * pow(1.959963984540054 + 0.8416212335729143, 2) / n) + 2 * asin(sqrt(14.0::DOUBLE / 37)) AS phi FROM (VALUES (2), (4), (32), (37), (100), (300), (500)) v(n))")
def _(spark, sf):
    n = spark.createDataFrame([(i,) for i in (2, 4, 32, 37, 100, 300, 500)], "n int")
    return n.select("n", F.round(stats.min_detectable_delta(F.col("n"), 14 / 37), 4).alias("delta"))


@query("ma03_discordant_count", "SELECT p_partkey, round_even(p_size * 0.25, 0)::BIGINT AS k FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", stats.discordant_count(F.col("p_size"), F.lit(0.25)).alias("k"))


@query("ma05_mcnemar", f"SELECT k, CAST(b AS BIGINT) AS b FROM {values([(3, None), (4, None), (5, None), (6, 6), (7, 7), (8, 8), (9, 8), (10, 9), (11, 10), (12, 10)], 'k, b')}")
def _(spark, sf):
    return stats.mcnemar_table(spark, list(range(3, 13)))


@query("ma06_block_thresholds", f"SELECT CAST(n AS BIGINT) AS n, CAST(eps AS DOUBLE) AS eps, CAST(m AS BIGINT) AS m FROM {values([(n, e, m) for n, ms in ((6, (2, 3, 3)), (8, (3, 3, 4)), (10, (3, 4, 4)), (12, (3, 4, 5)), (14, (3, 4, 5))) for e, m in zip((0.05, 0.1, 0.15), ms, strict=True)], 'n, eps, m')}")
def _(spark, sf):
    return stats.threshold_table(spark, [6, 8, 10, 12, 14], [Fraction(1, 20), Fraction(1, 10), Fraction(3, 20)]).drop("detect")


@query("ma07_detection", f"SELECT CAST(n AS BIGINT) AS n, CAST(pct AS BIGINT) AS pct FROM {values([(6, 66), (8, 86), (10, 83), (12, 93), (14, 97)], 'n, pct')}")
def _(spark, sf):
    return stats.threshold_table(spark, [6, 8, 10, 12, 14], [Fraction(1, 10)]).select("n", F.round(100 * F.col("detect")).cast("long").alias("pct"))


@query("ma08_thresholds", f"WITH {STABLE} SELECT count(*) AS n_s, CAST(0.1 AS DOUBLE) AS eps, count(*) < 6 AS few FROM st WHERE state = 'stable'")
def _(spark, sf):
    stable = trials.stability(facts(spark, sf)).where("state = 'stable'").select("task")
    return trials.thresholds(stable).select("n_s", "eps", (F.col("n_s") < 6).alias("few"))
