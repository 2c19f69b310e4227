"""Queries on batches, turns, candidate reconstruction and the remaining gates."""

from pyspark.sql import functions as F

from lathework.functions import paths as P
from lathework.functions import text as X
from lathework.operators import batches, gates, joins, labels, rebuild, selection, sessions, trials, turns
from lathework.plans.registry import adapted, cte, query, table, values

INDEX = "ix AS (SELECT c_custkey AS sid, c_custkey % 40 AS steps, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS repo, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(2024 + c_custkey % 3 AS VARCHAR) END AS start_time FROM customer)"


def index(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("sid"), (k % 40).alias("steps"), F.when(k % 7 != 0, F.col("c_mktsegment")).alias("repo"), F.when(k % 5 != 0, (2024 + k % 3).cast("string")).alias("start_time"))


@query("ag27_freeze", f"WITH {INDEX} SELECT count(*) AS session_count, max(coalesce(start_time, '')) AS latest_session_start, count_if(steps >= 3) AS steps_ge3, count_if(steps >= 3 AND repo IS NOT NULL) AS steps_ge3_anchored, 'v1' AS version, round(count_if(steps >= 3 AND repo IS NOT NULL)::DOUBLE / count_if(steps >= 3), 4) AS anchor_rate, sha256(string_agg(concat(sid, ':', steps), chr(10) ORDER BY concat(sid, ':', steps))) AS fingerprint FROM ix")
def _(spark, sf):
    return batches.freeze(index(spark, sf), "v1")


@query("ag27_distribution", f"WITH {INDEX} SELECT coalesce(repo, '(unresolved)') AS key, count(*) AS n FROM ix GROUP BY 1 ORDER BY n DESC, key LIMIT 25")
def _(spark, sf):
    return batches.distribution(index(spark, sf), "repo")


@query("se01_frozen_conflict", f"WITH {INDEX} SELECT 'v1' AS version, sha256(string_agg(concat(sid, ':', steps), chr(10) ORDER BY concat(sid, ':', steps))) AS was, sha256(string_agg(concat(sid, ':', steps + 1), chr(10) ORDER BY concat(sid, ':', steps + 1))) AS now FROM ix")
def _(spark, sf):
    ix = index(spark, sf)
    return batches.frozen_conflict(batches.freeze(ix, "v1"), batches.freeze(ix.withColumn("steps", F.col("steps") + 1), "v1"))


@query("se05_index_drift", f"WITH {INDEX} SELECT sid, 'only_left' AS side FROM ix WHERE sid % 11 = 0 AND sid <> 0 UNION ALL SELECT -sid, 'only_right' FROM ix WHERE sid % 13 = 0 AND sid <> 0")
def _(spark, sf):
    ix = index(spark, sf).select("sid")
    other = ix.where("sid % 11 <> 0").unionByName(ix.where("sid % 13 = 0").select((-F.col("sid")).alias("sid")))
    return joins.two_way_difference(ix, other, ["sid"])


@query("fi03_session_projection", f"WITH {cte('sessions')} SELECT sid, agent_source, vendor, CAST(NULL AS VARCHAR) AS model, CAST(NULL AS VARCHAR) AS repo, 'b1' AS batch_version FROM sessions")
def _(spark, sf):
    return batches.with_provenance(adapted(spark, sf, "sessions"), batch_version="b1").select("sid", "agent_source", "vendor", "model", "repo", "batch_version")


@query("ag07_unit_statistics", f"""WITH {cte('units')}, k AS (SELECT sid, boundary_confidence <> 'medium' AS keep, CASE WHEN edit_ops > 2 THEN seq END AS lo FROM units), p AS (SELECT sid, count_if(keep) AS kept, count(*) AS units, count_if(keep AND lo IS NOT NULL) AS mapped FROM k GROUP BY sid)
SELECT count(*) AS sessions, sum(units)::BIGINT AS units, sum(kept)::BIGINT AS kept, count_if(kept > 1) AS multi, sum(mapped)::BIGINT AS mapped, round(sum(units)::DOUBLE / count(*), 4) AS units_per_session, round(count_if(kept > 1)::DOUBLE / count(*), 4) AS multi_rate, round(sum(mapped)::DOUBLE / sum(kept), 4) AS mapped_rate FROM p""")
def _(spark, sf):
    return batches.unit_statistics(adapted(spark, sf, "units").withColumns({"keep": F.col("boundary_confidence") != "medium", "lo": F.when(F.col("edit_ops") > 2, F.col("seq"))}))


@query("ag09_label_statistics", "WITH d AS (SELECT CASE WHEN e = 0 THEN 'unrated' WHEN l_linenumber <= 1 AND e <= 2 THEN 'easy' WHEN l_linenumber <= 2 AND e <= 6 THEN 'medium' ELSE 'hard' END AS difficulty FROM (SELECT *, CAST(floor(l_quantity) AS BIGINT) % 9 AS e FROM lineitem)), c AS (SELECT difficulty, count(*) AS n FROM d WHERE difficulty <> 'unrated' GROUP BY 1) SELECT difficulty, n, round(n / sum(n) OVER (), 4) AS share FROM c")
def _(spark, sf):
    e = F.floor("l_quantity") % 9
    return batches.label_statistics(table(spark, sf, "lineitem").select(labels.difficulty(F.col("l_linenumber"), e).alias("difficulty")))


@query("ag13_merged_counts", "SELECT key, sum(v)::BIGINT AS n FROM (SELECT 'cross_repo' AS key, o_orderkey % 4 AS v FROM orders UNION ALL SELECT 'out_of_scope', o_orderkey % 7 FROM orders) GROUP BY key")
def _(spark, sf):
    k = F.col("o_orderkey")
    maps = F.create_map(F.lit("cross_repo"), k % 4, F.lit("out_of_scope"), k % 7)
    return batches.merged_counts(table(spark, sf, "orders").select(maps.alias("m")), "m")


@query("ag31_size_statistics", "SELECT count(*) AS n, min(round(s / 1e6, 3)) AS least_mb, max(round(s / 1e6, 3)) AS most_mb FROM (SELECT n_chars * 1000 - 300000 AS s FROM documents) WHERE s > 0")
def _(spark, sf):
    return batches.size_statistics(table(spark, sf, "documents").select((F.col("n_chars") * 1000 - 300_000).alias("s")), "s")


GREEN = [("src/a/x.test.ts", 5), ("src/a/y.test.ts", 9), ("src/b/z.test.ts", 7), ("lib/q.test.ts", 3), ("top.test.ts", 1)]
TOUCHED = [("T1", "src/a/x.test.ts"), ("T2", "top.test.ts")]
PICKED = [("T1", "src/a/y.test.ts", 0, 9, 1), ("T1", "src/b/z.test.ts", 1, 7, 2), ("T1", "lib/q.test.ts", 2, 3, 3), ("T2", "src/a/y.test.ts", 2, 9, 1), ("T2", "src/b/z.test.ts", 2, 7, 2), ("T2", "src/a/x.test.ts", 2, 5, 3)]


@query("wi11_regression_candidates", f"SELECT task, path, tier, tests, rank FROM {values(PICKED, 'task, path, tier, tests, rank')}")
def _(spark, sf):
    green, touched = spark.createDataFrame(GREEN, "path string, tests int"), spark.createDataFrame(TOUCHED, "task string, path string")
    return batches.regression_candidates(green, touched, 3)


FLAGS = "c AS (SELECT o_orderkey AS id, o_orderkey % 5 = 0 AS base_not_found, o_orderkey % 7 = 0 AS incomplete_paths, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 11 = 0 END AS rebuild_failed, (o_orderkey % 10) / 10.0::DOUBLE AS anchor_rate FROM orders)"


@query("fi16_drop_reasons", f"WITH {FLAGS} SELECT id, CASE WHEN base_not_found THEN 'base_not_found' WHEN incomplete_paths THEN 'incomplete_paths' WHEN rebuild_failed THEN 'rebuild_failed' WHEN anchor_rate < 0.7 THEN 'anchor_below_threshold' END AS reason FROM c")
def _(spark, sf):
    k, no = F.col("o_orderkey"), F.lit(False)
    flags = {n: no for n in batches.DROPS} | {"base_not_found": k % 5 == 0, "incomplete_paths": k % 7 == 0, "rebuild_failed": F.when(k % 3 != 0, k % 11 == 0), "anchor_rate": (k % 10) / 10.0}
    return table(spark, sf, "orders").withColumns(flags).select(k.alias("id"), batches.drop_reason().alias("reason"))


@query("fi15_ignored_paths", "SELECT DISTINCT l_orderkey AS task FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 48)")
def _(spark, sf):
    ignored = table(spark, sf, "part").where("p_size > 48").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf, "lineitem").join(ignored, "l_partkey", "left_semi").select(F.col("l_orderkey").alias("task")).distinct()


@query("fi19_allowlist_difference", "SELECT p_partkey AS file FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 7 <> 0")
def _(spark, sf):
    files = table(spark, sf, "part").select(F.col("p_partkey").alias("file"))
    for n in (3, 5, 7):
        files = files.join(table(spark, sf, "part").where(F.col("p_partkey") % n == 0).select(F.col("p_partkey").alias("file")), "file", "left_anti")
    return files


@query("fi12_test_files", "SELECT id, contains(regexp_extract(path, '[^/]*$'), '.test.') OR contains(regexp_extract(path, '[^/]*$'), '.spec.') OR contains(regexp_extract(path, '[^/]*$'), '_test_') OR contains(regexp_extract(path, '[^/]*$'), '_spec_') AS is_test_file FROM (VALUES (1, 'a.test.d/x.ts'), (2, 'a/b.test.ts'), (3, 'b_spec_.ts'), (4, 'c.ts')) v(id, path)")
def _(spark, sf):
    return spark.createDataFrame([(1, "a.test.d/x.ts"), (2, "a/b.test.ts"), (3, "b_spec_.ts"), (4, "c.ts")], "id int, path string").select("id", P.is_test_file(F.col("path")).alias("is_test_file"))


@query("jo10_build_join", "SELECT o_orderkey, c_name, n_name, count(*) AS files FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = joins.complete_join(o, table(spark, sf, "customer"), ["c_custkey"]).withColumnRenamed("c_nationkey", "n_nationkey")
    joined = joins.complete_join(joined, table(spark, sf, "nation"), ["n_nationkey"])
    return joined.join(table(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "c_name", "n_name").agg(F.count(F.lit(1)).alias("files"))


@query("jo16_stale_diagnoses", f"WITH {cte('trials')} SELECT trial_id FROM trials WHERE reward IS NOT NULL AND trial_id NOT IN (SELECT trial_id FROM trials WHERE run <> 'r2')")
def _(spark, sf):
    t = adapted(spark, sf, "trials")
    return t.where("reward is not null").join(t.where("run <> 'r2'").select("trial_id"), "trial_id", "left_anti").select("trial_id")


@query("jo17_same_task_sets", f"WITH {cte('trials')} SELECT a.run AS run, a.l = b.l AS same FROM (SELECT run, string_agg(DISTINCT task, ',' ORDER BY task) AS l FROM trials GROUP BY run) a, (SELECT string_agg(DISTINCT task, ',' ORDER BY task) AS l FROM trials WHERE run = 'r0') b")
def _(spark, sf):
    t = adapted(spark, sf, "trials")
    sets = t.groupBy("run").agg(F.array_sort(F.collect_set("task")).alias("l"))
    first = sets.where("run = 'r0'").select(F.col("l").alias("m"))
    return sets.crossJoin(F.broadcast(first)).select("run", (F.col("l") == F.col("m")).alias("same"))


@query("jo09_evidence_due", "SELECT c_custkey AS job FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def _(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("job")).join(table(spark, sf, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("job")), "job", "left_anti")


@query("se07_survivor_groups", f"WITH {cte('trials')}, g AS (SELECT CASE WHEN p2p_error IS NOT NULL THEN 'audit' WHEN exception IS NOT NULL THEN 'excluded' ELSE 'scored' END AS name FROM trials) SELECT name, count(*) AS n, TRUE AS closes FROM g GROUP BY name")
def _(spark, sf):
    return batches.survivor_groups(adapted(spark, sf, "trials"), [("audit", F.col("p2p_error").isNotNull()), ("excluded", F.col("exception").isNotNull())])


@query("ag24_rerun_summary", f"WITH {cte('trials')} SELECT count(*) AS tasks, round(100.0 * count_if(reward = 1.0) / count(*), 1)::DOUBLE AS pass_pct, count_if(trial_id % 4 = 0) AS silent, count_if(subtype = 'error_max_turns') AS capped, round(sum(cost_usd), 4) AS cost FROM trials")
def _(spark, sf):
    return batches.rerun_summary(adapted(spark, sf, "trials").withColumn("write_calls", F.col("trial_id") % 4))


@query("ag23_probe_verdict", f"WITH {cte('trials')}, j AS (SELECT * FROM trials WHERE reward IS NOT NULL), s AS (SELECT DISTINCT task FROM trials WHERE run = 'r0'), a AS (SELECT count(*) AS n_judged, count_if(subtype = 'error_max_turns') AS still_capped, count_if(reward = 1.0 AND task NOT IN (SELECT task FROM s WHERE task < 'T2')) AS new_solved FROM j) SELECT *, n_judged > 0 AND (n_judged - still_capped) * 2 >= n_judged AND new_solved >= 3 AS useful FROM a")
def _(spark, sf):
    t = adapted(spark, sf, "trials")
    return batches.probe_verdict(t, t.where("run = 'r0' and task < 'T2'").select("task").distinct())


PRICES = [(1, 2.0, 3.0, None, None), (2, None, None, 0.0, 1.0), (3, None, None, None, None), (4, 2.0, None, 5.0, 6.0), (5, None, None, 5.0, 6.0)]


@query("ma10_price_verdict", "SELECT id, source, problem FROM (VALUES (1, 'host', NULL), (2, 'registry', 'placeholder'), (3, 'none', 'no_price'), (4, 'host', 'incomplete'), (5, 'registry', NULL)) v(id, source, problem)")
def _(spark, sf):
    rows = spark.createDataFrame(PRICES, "id int, hi double, ho double, ri double, ro double")
    price = lambda i, o: F.when(F.col(i).isNotNull() | F.col(o).isNotNull(), F.struct(F.col(i).alias("input"), F.col(o).alias("output")))
    return rows.withColumn("v", batches.price_verdict(price("hi", "ho"), price("ri", "ro"))).select("id", "v.source", "v.problem")


@query("qa15_control_group", "SELECT 4 AS n_control, 3 AS n_done, 1 AS n_attempted, 1 AS n_supporting, 2 AS n_capped, 'withheld' AS reading")
def _(spark, sf):
    rows = [("a", "true_zero_wrong_fix", 2, "success"), ("b", "true_zero_no_attempt", 0, "error_max_turns"), ("c", "true_zero_no_attempt", 0, "error_max_turns"), ("z", "solved", 1, "success")]
    control = spark.createDataFrame([(t,) for t in "abcd"], "task string")
    return batches.control_group(spark.createDataFrame(rows, "task string, verdict string, write_calls int, subtype string"), control)


@query("qa18_health_checks", "SELECT \"check\", state FROM (VALUES ('rate_in_range', 'ok'), ('models_apart', 'cannot_judge'), ('bands_fall', 'failed')) v(\"check\", state)")
def _(spark, sf):
    return batches.health_checks(spark.createDataFrame([(0.38, 1, None, 0.2, 0.5, 0.1)], "p double, models int, best_gap double, small double, medium double, large double"))


PACKAGES = [(1, '{"dependencies": {"eval-framework": "workspace:*"}}'), (2, '{"devDependencies": {"eval-framework": "1.2.3"}}'), (3, '{"dependencies": {}}'), (4, None), (5, "not json")]


@query("st40_framework_mode", "SELECT id, mode FROM (VALUES (1, 'workspace'), (2, 'external'), (3, 'absent'), (4, 'absent'), (5, 'absent')) v(id, mode)")
def _(spark, sf):
    return spark.createDataFrame(PACKAGES, "id int, j string").select("id", batches.framework_mode(F.col("j")).alias("mode"))


PROVENANCES = [(1, "clean", None), (2, "", ""), (3, None, "abc"), (4, None, None)]


@query("st03_provenance", "SELECT id, CASE WHEN id IN (1, 3) THEN 'anchored' ELSE 'unanchored' END AS provenance FROM (VALUES (1), (2), (3), (4)) v(id)")
def _(spark, sf):
    return spark.createDataFrame(PROVENANCES, "id int, s string, h string").select("id", X.provenance(F.col("s"), F.col("h")).alias("provenance"))


BLOCKS = [(1, ["<system-reminder>x", "short", "a real instruction"]), (2, ["short"]), (3, [])]


@query("st06_first_prompt", "SELECT id, prompt FROM (VALUES (1, 'a real instruction'), (2, 'short'), (3, NULL)) v(id, prompt)")
def _(spark, sf):
    return spark.createDataFrame(BLOCKS, "id int, b array<string>").select("id", X.first_prompt(F.col("b")).alias("prompt"))


SYSTEM = [("s1", 0, "You are here.\nPrimary working directory: /home/u/Code/team/app\nEnd\n"), ("s1", 1, "Working directory = /home/u/Code/other/z \n"), ("s1", 2, "Current working directory: /home/u/Code/team/app\n"), ("s1", 3, "Working directory: /ignored\n"), ("s2", 0, "none")]
WORKING = r"(?:Primary working directory|Working directory|Current working directory)\s*[:=]\s*(/[^\n\"\\'`]+?)\s*\n"


@query("ag04_working_directory", "SELECT 's1' AS sid, '/home/u/Code/team/app' AS wd, CAST(2 AS BIGINT) AS hits")
def _(spark, sf):
    rows = spark.createDataFrame(SYSTEM, "sid string, line_no int, system string").where("line_no < 3")
    found = rows.select("sid", "line_no", F.explode(F.regexp_extract_all("system", F.lit(WORKING), F.lit(1))).alias("wd"))
    return sessions.mode(found, "sid", "wd", "line_no")


LINES = [
    ("s", 0, 0, "T3", [("user", ["old one from the history"]), ("user", ["<system-reminder>x"]), ("user", ["please fix the parser"]), ("user", ["Caveat: no"])], None),
    ("s", 1, 1, "T1", None, [("user", ["first", "and then the second"]), ("assistant", ["no"])]), ("s", 2, 2, "T2", None, [("user", ["please fix the parser"])]),
    ("s", 3, 3, "T4", None, [("user", ["<command-name>/goal</command-name><command-args>please review the whole document</command-args>"])]), ("s", 4, 4, None, None, [("user", ["[Request interrupted by user]"])]),
]


@query("ne01_extract_turns", "SELECT sid, seq, line_no, ts, text FROM (VALUES ('s', 1, 1, 'T1', 'and then the second'), ('s', 2, 0, 'T3', 'please fix the parser'), ('s', 3, 3, 'T4', 'please review the whole document')) v(sid, seq, line_no, ts, text)")
def _(spark, sf):
    return turns.extract_turns(spark.createDataFrame(LINES, f"sid string, line_no int, raw_idx int, ts string, messages array<{turns.MESSAGE}>, new_messages array<{turns.MESSAGE}>"))


@query("ne03_actions_between", f"WITH {cte('steps')} SELECT s.sid, idx, tool, is_error FROM steps s JOIN (SELECT DISTINCT user_id AS sid, user_id % 10 AS lo, user_id % 10 + 3 AS hi FROM events) u ON s.sid = u.sid AND idx BETWEEN lo AND hi")
def _(spark, sf):
    sid = F.col("user_id")
    units = table(spark, sf, "events").select(sid.cast("string").alias("unit_id"), sid.alias("sid"), (sid % 10).alias("lo"), (sid % 10 + 3).alias("hi")).distinct()
    return turns.actions_between(adapted(spark, sf, "steps").select("sid", "idx", "tool", "is_error"), units).select("sid", "idx", "tool", "is_error")


@query("ne08_write_calls", "SELECT * FROM (VALUES (1, 2), (2, 0)) v(id, n_writes)")
def _(spark, sf):
    rows = [(1, '{"a": [{"name": "Edit", "b": {"name" : "write"}}], "name": "bash"}'), (2, "{}")]
    return turns.write_calls(spark.createDataFrame(rows, "id int, j string"), "j", ["edit", "write", "multiedit"]).select("id", "n_writes")


LONG = "\n".join(f"line {i} of the document that was read by a tool" for i in range(40))
NAMED = [("s", "docs/a.md"), ("s", "docs/b.md"), ("s", "c.json")]


@query("ne09_longest_results", "SELECT 's' AS sid, 'docs/a.md' AS path, 40 AS lines")
def _(spark, sf):
    uses = spark.createDataFrame([("s", "u1", '{"f": "/x/a.md"}'), ("s", "u2", "wc -l b.md"), ("s", "u3", "cat a.md | head"), ("s", "u4", "c.json")], "sid string, use_id string, input string")
    results = spark.createDataFrame([("s", "u1", LONG + "\n"), ("s", "u3", LONG[:900]), ("s", "u2", "40 b.md" + " " * 900), ("s", "u4", LONG)], "sid string, use_id string, text string")
    found = turns.longest_results(uses, results, spark.createDataFrame(NAMED, "sid string, path string"))
    return found.select("sid", "path", F.size(F.split("text", "\n")).alias("lines"))


@query("wi14_first_edits", "SELECT unit_id, path, CAST(i AS INTEGER) AS idx, o AS old FROM (VALUES ('u', 'a', 1, 'x'), ('u', 'b', 0, 'y')) v(unit_id, path, i, o)")
def _(spark, sf):
    ops = spark.createDataFrame([("u", "a", 0, "Write", None), ("u", "a", 1, "Edit", "x"), ("u", "a", 2, "Edit", "z"), ("u", "b", 0, "Edit", "y")], "unit_id string, path string, idx int, tool string, old string")
    return turns.first_edits(ops)


@query("wi13_confidence_order", "SELECT TRUE AS ok")
def _(spark, sf):
    rates = spark.createDataFrame([("high", 0.9), ("medium", 0.7), ("low", 0.4)], "confidence string, precision double")
    rank = F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), "precision"))), lambda x: -x["precision"])
    return rates.agg((F.array_sort(ordered) == ordered).alias("ok"))


@query("ne06_unified_diffs", "SELECT 'a.py' AS path, 1 AS added, 1 AS removed")
def _(spark, sf):
    @F.pandas_udf("string")
    def diff(before, after, path):
        import pandas as pd

        return pd.Series([rebuild.unified_diff(b, a, p) for b, a, p in zip(before, after, path, strict=True)])

    rows = spark.createDataFrame([("a.py", "x = 1\ny = 2\n", "x = 1\ny = 3\n")], "path string, before string, after string")
    d = rows.select("path", diff("before", "after", "path").alias("d"))
    return d.select("path", F.regexp_count("d", F.lit(r"(?m)^\+[^+]")).alias("added"), F.regexp_count("d", F.lit("(?m)^-[^-]")).alias("removed"))


@query("st35_fixpoint", "SELECT id, t FROM (VALUES (1, 'ab'), (2, 'plain')) v(id, t)")
def _(spark, sf):
    return spark.createDataFrame([(1, "a<<x>x>b"), (2, "plain")], "id int, t string").select("id", X.redact_to_fixpoint(F.col("t"), "<x>", "").alias("t"))


@query("qa01_index_gate", f"WITH {INDEX} SELECT gate, ok FROM (SELECT 'sid_unique' AS gate, count(*) = count(DISTINCT sid) AS ok FROM ix UNION ALL SELECT 'steps_not_negative', count_if(steps < 0) = 0 FROM ix UNION ALL SELECT 'start_known', count_if(start_time IS NULL) = 0 FROM ix)")
def _(spark, sf):
    ix = index(spark, sf)
    rows = gates.assertions(ix, {"steps_not_negative": F.col("steps") >= 0, "start_known": F.col("start_time").isNotNull()}).select("gate", "ok")
    unique = ix.agg(F.lit("sid_unique").alias("gate"), (F.count("sid") == F.count_distinct("sid")).alias("ok"))
    return rows.unionByName(unique)


@query("qa02_anchor_gate", f"WITH {INDEX} SELECT 'anchor_rate' AS gate, count_if(repo IS NOT NULL)::DOUBLE / count(*) >= 0.85 AS ok, round(count_if(repo IS NOT NULL)::DOUBLE / count(*), 4) AS share FROM ix WHERE steps >= 3")
def _(spark, sf):
    return gates.share_gate(index(spark, sf), "anchor_rate", F.col("repo").isNotNull(), 0.85, F.col("steps") >= 3)


@query("qa09_provenance_gate", f"WITH {cte('sessions')} SELECT count(DISTINCT agent_source) >= 2 AS two_sources, TRUE AS one_batch FROM sessions")
def _(spark, sf):
    s = batches.with_provenance(adapted(spark, sf, "sessions"), batch_version="b1")
    return s.agg((F.count_distinct("agent_source") >= 2).alias("two_sources"), (F.count_distinct("batch_version") == 1).alias("one_batch"))


@query("ag21_epsilon", f"WITH {cte('trials')}, st AS (SELECT task FROM (SELECT task, run, max(reward) AS r FROM trials WHERE reward IS NOT NULL GROUP BY ALL) GROUP BY task HAVING count_if(r = 1.0) >= 1), h AS (SELECT task, max(reward) AS r FROM trials WHERE reward IS NOT NULL GROUP BY task) SELECT greatest(count_if(r <> 1.0)::DOUBLE / count(*), 0.1) AS eps FROM st JOIN h USING (task)")
def _(spark, sf):
    t = adapted(spark, sf, "trials").where("reward is not null")
    stable = trials.stability(t).where("passed >= 1").select("task")
    return spark.createDataFrame([(float(trials.epsilon(stable, t)),)], "eps double")


@query("st26_bands", f"WITH {cte('units')} SELECT CASE WHEN edit_ops <= 3 THEN 'S' WHEN edit_ops <= 10 THEN 'M' ELSE 'L' END AS band, count(*) AS n FROM units GROUP BY 1")
def _(spark, sf):
    return adapted(spark, sf, "units").groupBy(selection.band(F.col("edit_ops")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
