"""Queries on the remaining small operators."""

from fractions import Fraction

from pyspark.sql import functions as F

from lathework.functions import paths as P
from lathework.functions import redaction as R
from lathework.functions import stats
from lathework.functions import text as X
from lathework.operators import batches, gates, joins, labels, trials
from lathework.plans.registry import adapted, cte, query, table, values
from lathework.plans.trial_queries import NOP_GATE, ORACLE_GATE, RATES
from lathework.sources import sync

ROOT = "/home/u/Code/"
FILES = [(1, "docs/a.md"), (2, "src/a.md"), (3, "src/a.ts"), (4, "evals/x"), (5, "evals/keep.ts"), (6, "ci/weekly.yml"), (7, "evals-two/x")]


@query("fi09_snapshot_files", f"SELECT id, id NOT IN (4, 6) AS kept, starts_with(path, 'docs/') OR ends_with(path, '.md') AS is_doc FROM {values(FILES, 'id, path')}")
def _(spark, sf):
    p = F.col("path")
    return spark.createDataFrame(FILES, "id long, path string").select("id", P.kept_in_snapshot(p, ["evals"], ["ci/weekly.yml"], ["evals/keep.ts"]).alias("kept"), P.is_doc_file(p).alias("is_doc"))


TRIPS = [(1, "/home/u/Code/team/app/src/a.py", "src/a.py"), (2, "/home/u/Code/team/app/src/a.py", "a.py"), (3, "/tmp/x", None)]


@query("fi13_round_trips", f"SELECT id, coalesce('/home/u/Code/team/app/' || rel = path, FALSE) AS ok FROM {values(TRIPS, 'id, path, rel')}")
def _(spark, sf):
    return spark.createDataFrame(TRIPS, "id long, path string, rel string").select("id", P.round_trips(F.col("path"), F.col("rel"), ROOT, F.lit("team/app")).alias("ok"))


@query("st39_relative_in_known", "SELECT id, rel FROM (VALUES (1, 'src/a.py'), (2, 'src/a.py'), (3, NULL)) v(id, rel)")
def _(spark, sf):
    return spark.createDataFrame(TRIPS, "id int, path string, rel string").select("id", P.relative_in_known(F.col("path"), ROOT, ["team/app", "team"]).alias("rel"))


@query("fi23_started", "SELECT user_id % 7 AS sid, TRUE AS started FROM events WHERE event_type = 'click' GROUP BY 1 UNION ALL SELECT 99, FALSE")
def _(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'click'").groupBy((F.col("user_id") % 7).alias("sid")).agg(F.collect_set("event_type").alias("tools"))
    none = spark.createDataFrame([(99, None)], "sid long, tools array<string>")
    return batches.started(e.unionByName(none)).select("sid", "started")


@query("fi24_ordered_documents", "SELECT r_regionkey, '{\"r_name\":\"' || r_name || '\",\"r_regionkey\":' || r_regionkey || '}' AS doc FROM region ORDER BY r_regionkey")
def _(spark, sf):
    return batches.ordered_documents(table(spark, sf, "region"), "r_regionkey", ["r_name", "r_regionkey"])


@query("se03_candidates_by_base", "SELECT l_suppkey % 20 AS base, string_agg(DISTINCT concat('f', l_partkey % 50), ',' ORDER BY concat('f', l_partkey % 50)) AS paths FROM lineitem GROUP BY 1")
def _(spark, sf):
    c = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 20).alias("base"), F.concat(F.lit("f"), (F.col("l_partkey") % 50).cast("string")).alias("path"))
    return batches.candidates_by_base(c).withColumn("paths", F.array_join("paths", ","))


@query("se06_kept_and_dropped", "SELECT doc_id, CASE WHEN n_chars > 500 THEN 'kept' ELSE 'dropped' END AS list FROM documents")
def _(spark, sf):
    return batches.kept_and_dropped(table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 500).alias("keep"))).select("doc_id", "list")


@query("jo12_member_states", f"WITH {RATES}, m AS (SELECT DISTINCT concat('T', CAST(c_custkey % 70 AS VARCHAR)) AS task FROM customer) SELECT task, CASE WHEN attempts IS NULL THEN 'missing' WHEN rate IS NULL THEN 'excluded' WHEN round_even(rate, 0) > 0 THEN 'solved' ELSE 'unsolved' END AS state FROM m LEFT JOIN rates USING (task)")
def _(spark, sf):
    members = table(spark, sf, "customer").select(F.concat(F.lit("T"), (F.col("c_custkey") % 70).cast("string")).alias("task"))
    return batches.member_states(members, trials.task_rates(adapted(spark, sf, "trials").withColumn("errors", F.array("error_text"))))


ATTRIBUTED = f"a AS (SELECT 'oracle' AS gate, {ORACLE_GATE} AS r FROM trials UNION ALL SELECT 'nop', {NOP_GATE} FROM trials)"


@query("qa20_attribution", f"WITH {cte('trials')}, {ATTRIBUTED} SELECT gate, count_if(r = '') AS passed, count_if(r IN ('not_solved', 'green_without_change', 'unexpected_values')) AS failed, count_if(r IN ('exception', 'sources_disagree', 'breaks_others', 'broken_environment')) AS infra, count(*) AS total, TRUE AS closes FROM a GROUP BY gate")
def _(spark, sf):
    t = adapted(spark, sf, "trials")
    rows = t.select(F.lit("oracle").alias("gate"), gates.gate_oracle().alias("v")).unionByName(t.select(F.lit("nop").alias("gate"), gates.gate_nop().alias("v")))
    return batches.attribution(rows.select("gate", "v.ok", "v.infra"), "gate")


@query("qa04_source_gate", f"WITH {cte('sessions')} SELECT gate, ok FROM (SELECT 'source_known' AS gate, count_if(agent_source NOT IN ('claude_code', 'codex')) = 0 AS ok FROM sessions UNION ALL SELECT 'excluded_flagged', count_if(excluded_hit IS NULL) = 0 FROM sessions)")
def _(spark, sf):
    return gates.assertions(adapted(spark, sf, "sessions"), {"source_known": F.col("agent_source").isin("claude_code", "codex"), "excluded_flagged": F.col("excluded_hit").isNotNull()}).select("gate", "ok")


@query("qa17_contamination_gate", "SELECT count(*) > 0 AS in_scope, count_if(contains(text, 'response_content')) = 0 AS clean FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")
    hits = gates.contamination(docs).agg((F.count(F.lit(1)) == 0).alias("clean"))
    return docs.agg((F.count(F.lit(1)) > 0).alias("in_scope")).crossJoin(hits)


@query("qa22_precheck", "SELECT task, red FROM (VALUES ('a', FALSE), ('b', TRUE), ('c', TRUE)) v(task, red)")
def _(spark, sf):
    required = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "z")], "task string, file string")
    suites = spark.createDataFrame([("a", "x", 2, 0), ("b", "x", 1, 0), ("b", "y", 3, 1)], "task string, file string, tests int, failures int")
    return gates.side_score(required, suites).select("task", (F.col("score") < 1).alias("red"))


@query("qa24_set_preflight", "SELECT TRUE AS same_tasks, FALSE AS same_as_part")
def _(spark, sf):
    t = adapted(spark, sf, "trials").select("task")
    return spark.createDataFrame([(joins.same_sets(t, t.distinct(), ["task"]), joins.same_sets(t, t.where("task > 'T2'"), ["task"]))], "same_tasks boolean, same_as_part boolean")


@query("ma04_binomial_tails", "SELECT n, m, round(sum(factorial(n::INTEGER)::DOUBLE / (factorial(k::INTEGER)::DOUBLE * factorial((n - k)::INTEGER)::DOUBLE) * pow(0.15::DOUBLE, k) * pow(0.85::DOUBLE, n - k)), 9) AS p FROM (SELECT n, m, unnest(range(m, n + 1)) AS k FROM (VALUES (10, 4), (6, 0), (6, 6), (3, 2)) v(n, m)) GROUP BY n, m")
def _(spark, sf):
    rows = [(n, m, float(stats.binomial_tail(n, Fraction(3, 20), m))) for n, m in ((10, 4), (6, 0), (6, 6), (3, 2))]
    return spark.createDataFrame(rows, "n int, m int, p double").withColumn("p", F.round("p", 9))


@query("ma09_reconciliation", "SELECT 5 AS rows, TRUE AS agrees")
def _(spark, sf):
    frozen = spark.createDataFrame([(32, 34.1), (37, 31.9), (100, 19.7), (300, 11.3), (500, 8.7)], "n int, pp double")
    now = F.round(stats.min_detectable_delta(F.col("n"), 14 / 37), 1)
    return frozen.agg(F.count(F.lit(1)).cast("int").alias("rows"), F.bool_and(F.col("pp") == now).alias("agrees"))


@query("st22_instruction_heads", "SELECT doc_id, md5(CASE WHEN trim(split_part(text, chr(10), 1)) <> '' THEN substr(split_part(text, chr(10), 1), 1, 120) ELSE substr(text, 1, 120) END) AS head FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(labels.instruction_head(F.col("text"))).alias("head"))


KEYS = [(1, "a1B2c3D4e5F6g7H8i9J0k", True), (2, "specific-scorer-registry", False), (3, "short1A", False), (4, "aaaaaaaaaaaaaaaaaaaaaaA1", False), (5, "abcdefghijklmnopqrstuvwxyz", False)]


@query("st19_real_keys", f"SELECT id, real FROM {values(KEYS, 'id, k, real')}")
def _(spark, sf):
    return spark.createDataFrame([k[:2] for k in KEYS], "id long, k string").select("id", R.looks_like_real_key(F.col("k")).alias("real"))


SEVERITIES = [(1, ["medium", "high"]), (2, ["medium"]), (3, []), (4, ["low", "medium"])]


@query("st21_worst_severity", "SELECT id, s FROM (VALUES (1, 'high'), (2, 'medium'), (3, NULL), (4, 'medium')) v(id, s)")
def _(spark, sf):
    return spark.createDataFrame(SEVERITIES, "id int, l array<string>").select("id", R.worst_severity(F.col("l")).alias("s"))


@query("st07_working_directories", "SELECT '/a/with space/b|/c' AS d")
def _(spark, sf):
    row = spark.createDataFrame([("Primary working directory: /a/with space/b \nx\nWorking directory = /c\n",)], "t string")
    return row.select(F.array_join(X.working_directories(F.col("t")), "|").alias("d"))


@query("io13_markers", "SELECT doc_id % 40 AS sid, max(n_chars) AS fingerprint, bool_and(doc_id % 17 <> 3) AS complete FROM documents GROUP BY 1")
def _(spark, sf):
    k = F.col("doc_id")
    files = table(spark, sf, "documents").select((k % 40).alias("sid"), F.col("n_chars").alias("fingerprint"), F.when(k % 17 == 3, "error").when(k % 2 == 0, "ok").otherwise("missing").alias("status"))
    return sync.markers(files)


RESULTS = [
    ('{"task_name": "a", "verifier_result": {"rewards": {"reward": 1, "f2p": 1.0, "p2p": 0.5, "error_code": 0}}, "exception_info": null, "agent_result": {"metadata": {"agent_subtype": "success", "agent_num_turns": 7}}}',),
    ('{"task_name": "b", "exception_info": {"exception_type": "AgentTimeoutError"}, "agent_info": {"metadata": {"agent_subtype": "error_max_turns"}}}',), ('{"n_trials": 4}',), ('{"task_name": "c", "exception_info": "boom"}',),
]


@query("io15_trial_rows", "SELECT task, reward, f2p, p2p, error_code, exception, subtype, turns FROM (VALUES ('a', 1.0::DOUBLE, 1.0::DOUBLE, 0.5::DOUBLE, 0, NULL, 'success', 7), ('b', NULL, NULL, NULL, NULL, 'AgentTimeoutError', 'error_max_turns', NULL), ('c', NULL, NULL, NULL, NULL, 'boom', NULL, NULL)) v(task, reward, f2p, p2p, error_code, exception, subtype, turns)")
def _(spark, sf):
    return sync.trial_rows(spark.createDataFrame(RESULTS, "doc string"))


@query("io19_latest_run", "SELECT '2026-09-14__01-00-00' AS run")
def _(spark, sf):
    return sync.latest_run(spark.createDataFrame([("2026-09-13__10-00-00",), ("2026-09-14__01-00-00",), ("tmp",)], "run string"))


@query("io20_run_rewards", f"WITH {cte('trials')} SELECT task, max(reward) AS reward FROM trials WHERE reward IS NOT NULL AND run = 'r1' GROUP BY task")
def _(spark, sf):
    return sync.run_rewards(adapted(spark, sf, "trials").where("run = 'r1'"))


@query("ag30_lock_fields", f"WITH {cte('trials')} SELECT 'model' AS name, string_agg(DISTINCT model, ',' ORDER BY model) AS distinct_values, count_if(model IS NULL) AS missing FROM trials UNION ALL SELECT 'run', string_agg(DISTINCT run, ',' ORDER BY run), 0 FROM trials")
def _(spark, sf):
    return trials.controlled(adapted(spark, sf, "trials"), ["model", "run"])


@query("ag26_scoring_tallies", "SELECT source AS kind, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, kind")
def _(spark, sf):
    return joins.most_common(table(spark, sf, "documents").withColumnRenamed("source", "kind"), "kind")
