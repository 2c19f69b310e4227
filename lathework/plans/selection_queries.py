"""Queries on filters, funnels, tallies, joins and set operators."""

from pyspark.sql import functions as F

from lathework.functions import paths as P
from lathework.operators import gates, joins, selection
from lathework.plans.registry import adapted, cte, query, table, values

REPOS, SINCE = ["repo0", "repo1"], "1995-06"
REASON = "CASE WHEN steps = 0 THEN 'R1_EMPTY' WHEN steps < 3 THEN 'R2_TOO_SHORT' WHEN steps < 6 AND tool_call_count = 0 THEN 'R3_NO_ACTION' WHEN total_tokens < 1000 THEN 'R4_TOO_FEW_TOKENS' WHEN excluded_hit THEN 'E_SELF_REFERENTIAL' END"
FILTERED = f"{cte('sessions')}, filtered AS (SELECT *, {REASON} AS drop_reason, {REASON} IS NULL AS keep, {REASON} IS NULL AND lower(coalesce(exit_status, '')) IN ('interrupted', 'aborted', 'cancelled') AS forced_split FROM sessions)"
CHAIN = f"""{cte('units')}, nxt AS (
  SELECT *, lead(seq) OVER w IS NULL OR coalesce(lead(boundary_confidence) OVER w = 'high', FALSE) AS endpoint_high FROM units WINDOW w AS (PARTITION BY sid ORDER BY seq)
), s1 AS (SELECT *, coalesce(boundary_confidence = 'high' AND endpoint_high, FALSE) AS pass_1 FROM nxt),
s2 AS (SELECT *, pass_1 AND repo IN ('repo0', 'repo1') AND repo_resolution NOT IN ('unresolved', 'conflict') AS pass_2 FROM s1),
s3 AS (SELECT *, pass_2 AND coalesce(edit_ops, 0) >= 1 AS pass_3 FROM s2), s4 AS (SELECT *, pass_3 AND coalesce(n_test_cmds, 0) > 0 AS pass_4 FROM s3),
s5 AS (SELECT *, pass_4 AND secret_severity IS DISTINCT FROM 'high' AS pass_5 FROM s4), s6 AS (SELECT *, pass_5 AND coalesce(started_at, '') >= '{SINCE}' AS pass_6 FROM s5),
s7 AS (SELECT *, pass_6 AND category IN ('bug_fix', 'feature_impl', 'refactor', 'test_authoring') AS pass_7 FROM s6),
s8 AS (SELECT *, pass_7 AND coalesce(instruction_len, 0) BETWEEN 60 AND 1200 AS pass_8 FROM s7)"""


@query("fi01_session_rules", f"WITH {FILTERED} SELECT sid, keep, drop_reason, forced_split FROM filtered")
def _(spark, sf):
    return selection.filter_sessions(adapted(spark, sf, "sessions")).select("sid", "keep", "drop_reason", "forced_split")


@query("ag06_session_tallies", f"""WITH {FILTERED}, k AS (SELECT *, coalesce(drop_reason, 'None') AS r FROM filtered)
SELECT 'drop_reason' AS dimension, r AS key, count(*) AS n FROM k GROUP BY r UNION ALL SELECT 'agent_source', agent_source, count(*) FROM k GROUP BY agent_source UNION ALL SELECT 'vendor', vendor, count(*) FROM k GROUP BY vendor""")
def _(spark, sf):
    return selection.tallies(selection.filter_sessions(adapted(spark, sf, "sessions")), ["drop_reason", "agent_source", "vendor"])


@query("fi04_unit_verdict", f"WITH {cte('sessions')} SELECT sid, CASE WHEN exit_status = 'Interrupted' AND sid % 5 = 0 THEN 'U_INTERRUPTED' WHEN sid % 3 <> 0 AND steps * 30 > 100 THEN 'U_NO_BOUNDARY' END AS verdict FROM sessions")
def _(spark, sf):
    interrupted = F.coalesce(F.col("exit_status") == "Interrupted", F.lit(False)) & (F.col("sid") % 5 == 0)
    return adapted(spark, sf, "sessions").select("sid", selection.unit_verdict(interrupted, F.col("sid") % 3 == 0, F.col("steps") * 30).alias("verdict"))


@query("fi05_candidate_funnel", f"""WITH {CHAIN} SELECT * FROM (
SELECT 0 AS step, 'all' AS name, count(*) AS remaining FROM s8 UNION ALL SELECT 1, 'boundaries_high', count_if(pass_1) FROM s8 UNION ALL SELECT 2, 'target_repo', count_if(pass_2) FROM s8
UNION ALL SELECT 3, 'edits', count_if(pass_3) FROM s8 UNION ALL SELECT 4, 'tests', count_if(pass_4) FROM s8 UNION ALL SELECT 5, 'not_leaking', count_if(pass_5) FROM s8
UNION ALL SELECT 6, 'recent', count_if(pass_6) FROM s8 UNION ALL SELECT 7, 'category', count_if(pass_7) FROM s8 UNION ALL SELECT 8, 'instruction_length', count_if(pass_8) FROM s8)""")
def _(spark, sf):
    return selection.funnel(adapted(spark, sf, "units"), REPOS, SINCE)


@query("fi06_candidates", f"WITH {CHAIN} SELECT unit_id, sid, seq, repo, category, edit_ops, CASE WHEN edit_ops <= 3 THEN 'S' WHEN edit_ops <= 10 THEN 'M' ELSE 'L' END AS band, started_at, secret_severity FROM s8 WHERE pass_8")
def _(spark, sf):
    return selection.candidates(adapted(spark, sf, "units"), REPOS, SINCE).select("unit_id", "sid", "seq", "repo", "category", "edit_ops", "band", "started_at", "secret_severity")


@query("jo04_next_unit", f"WITH {CHAIN} SELECT unit_id, endpoint_high FROM nxt")
def _(spark, sf):
    return selection.next_unit_is_high(adapted(spark, sf, "units")).select("unit_id", "endpoint_high")


@query("fi07_unit_query", f"WITH {cte('units')} SELECT unit_id FROM units WHERE category = 'bug_fix' AND contains(lower(coalesce(agent_source, '')), 'codex') AND coalesce(edit_ops, 0) >= 5 AND secret_severity IS DISTINCT FROM 'high'")
def _(spark, sf):
    wanted = selection.matching(equal={"category": "bug_fix"}, contains={"agent_source": "CODEX"}, least={"edit_ops": 5}, not_equal={"secret_severity": "high"})
    return adapted(spark, sf, "units").where(wanted).select("unit_id")


@query("ag10_top_groups", f"WITH {cte('units')} SELECT coalesce(repo, 'None') AS repo, coalesce(vendor, 'None') AS vendor, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM units) AS share FROM units GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 30")
def _(spark, sf):
    return selection.top_groups(adapted(spark, sf, "units"), ["repo", "vendor"])


@query("ag11_overview", f"WITH {cte('units')} SELECT count(*) AS n, count_if(edit_ops >= 1) AS with_edits, count_if(n_test_cmds >= 1) AS with_tests, count_if(instruction_len >= 60) AS with_instruction, list_sort(list(edit_ops))[(count(edit_ops) // 2) + 1] AS median_edit_ops FROM units")
def _(spark, sf):
    return selection.overview(adapted(spark, sf, "units"))


@query("ag12_candidate_distributions", f"WITH {CHAIN}, c AS (SELECT *, CASE WHEN edit_ops <= 3 THEN 'S' WHEN edit_ops <= 10 THEN 'M' ELSE 'L' END AS band, substr(started_at, 1, 7) AS month FROM s8 WHERE pass_8) SELECT 'repo' AS dimension, repo AS key, count(*) AS n FROM c GROUP BY repo UNION ALL SELECT 'category', category, count(*) FROM c GROUP BY category UNION ALL SELECT 'band', band, count(*) FROM c GROUP BY band UNION ALL SELECT 'month', month, count(*) FROM c GROUP BY month")
def _(spark, sf):
    found = selection.candidates(adapted(spark, sf, "units"), REPOS, SINCE).withColumn("month", F.substring("started_at", 1, 7))
    return selection.tallies(found, ["repo", "category", "band", "month"])


@query("so01_most_common", "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def _(spark, sf):
    return joins.most_common(table(spark, sf, "documents"), "source", 10)


@query("so02_prefix_limit", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25")
def _(spark, sf):
    return table(spark, sf, "documents").orderBy("doc_id").limit(25).select("doc_id", "lang")


@query("so05_even_stride", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT doc_id FROM r WHERE i % greatest(1, n // 20) = 0 ORDER BY doc_id LIMIT 20")
def _(spark, sf):
    return joins.even_stride(table(spark, sf, "documents").select("doc_id"), "doc_id", 20)


@query("so03_seeded_sample", "SELECT doc_id, lang FROM documents ORDER BY md5(concat(doc_id, '#20260905')), doc_id LIMIT 50")
def _(spark, sf):
    return joins.seeded_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 20260905, 50)


@query("jo01_complete_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, sf):
    orders, customers = table(spark, sf, "orders").withColumnRenamed("o_custkey", "k"), table(spark, sf, "customer").withColumnRenamed("c_custkey", "k")
    return joins.complete_join(orders, customers, ["k"]).select("o_orderkey", "c_name")


@query("jo08_two_way_difference", "SELECT doc_id, 'only_left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'only_right' FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) AND doc_id NOT IN (SELECT doc_id FROM documents))")
def _(spark, sf):
    return joins.two_way_difference(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])


@query("jo06_best_matches", """WITH p AS (SELECT DISTINCT l_orderkey AS sid, l_partkey AS path FROM lineitem), k AS (SELECT DISTINCT l_partkey AS path, l_suppkey % 7 AS repo FROM lineitem),
h AS (SELECT sid, repo, count(*) AS matched FROM p JOIN k USING (path) GROUP BY sid, repo) SELECT sid, repo, matched FROM (SELECT *, rank() OVER (PARTITION BY sid ORDER BY matched DESC) AS r FROM h) WHERE r = 1""")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    known = items.select(F.col("l_partkey").alias("path"), (F.col("l_suppkey") % 7).alias("repo")).distinct()
    return joins.best_matches(items.select(F.col("l_orderkey").alias("sid"), F.col("l_partkey").alias("path")), known)


@query("jo18_manifest_mismatches", "SELECT a.doc_id AS path, CASE WHEN b.doc_id IS NULL THEN 'missing' ELSE 'differs' END AS state FROM documents a LEFT JOIN (SELECT * FROM documents WHERE doc_id % 10 <> 3) b ON a.doc_id = b.doc_id WHERE b.doc_id IS NULL OR a.doc_id % 7 = 0")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.sha2("text", 256).alias("sha"))
    actual = docs.where("path % 10 <> 3").withColumn("sha", F.when(F.col("path") % 7 == 0, F.lit("x")).otherwise(F.col("sha")))
    return joins.mismatches(docs, actual, "path", "sha")


@query("fi18_missing_files", "SELECT task, path FROM (SELECT o_orderkey AS task, unnest(['a', 'b', 'c']) AS path FROM orders) r WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = r.task AND chr(96 + l.l_linenumber) = r.path AND l.l_quantity > 10)")
def _(spark, sf):
    required = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task"), F.explode(F.array(*map(F.lit, "abc"))).alias("path"))
    present = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("task"), F.chr(96 + F.col("l_linenumber")).alias("path"), (F.col("l_quantity") - 10).alias("size"))
    return joins.missing_files(required, present)


@query("ag28_batch_fingerprint", f"WITH {cte('sessions')} SELECT sha256(string_agg(l, chr(10) ORDER BY l)) AS digest, count(*) AS n FROM (SELECT sid::VARCHAR || ':' || steps::VARCHAR AS l FROM sessions)")
def _(spark, sf):
    return joins.batch_fingerprint(adapted(spark, sf, "sessions"))


@query("ag29_release_digest", "SELECT sha256(string_agg(l, '' ORDER BY l)) AS digest, count(*) AS n FROM (SELECT 'docs/' || doc_id::VARCHAR || chr(0) || sha256(text) || chr(10) AS l FROM documents)")
def _(spark, sf):
    return joins.release_digest(table(spark, sf, "documents").select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha")))


@query("wi12_latest", "SELECT user_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("o"))
    return joins.latest(events, ["user_id"], "o").select("user_id", F.col("o.ts").alias("ts"), "event_type")


@query("io14_sync_verdict", """WITH c AS (SELECT doc_id AS sid, n_chars AS fingerprint, doc_id % 9 = 0 AS in_progress FROM documents), m AS (SELECT doc_id AS sid, CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN n_chars + 1 ELSE n_chars END AS was FROM documents WHERE doc_id % 5 <> 0)
SELECT sid, why, CASE WHEN why = 'equal' THEN 'skip' ELSE 'pull' END AS action FROM (SELECT c.sid, CASE WHEN m.sid IS NULL THEN 'no_marker' WHEN in_progress THEN 'in_progress' WHEN was IS NULL THEN 'broken_marker' WHEN was = fingerprint THEN 'equal' ELSE 'changed' END AS why FROM c LEFT JOIN m ON c.sid = m.sid)""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    catalog = docs.select(F.col("doc_id").alias("sid"), F.col("n_chars").alias("fingerprint"), (F.col("doc_id") % 9 == 0).alias("in_progress"))
    was = F.when(F.col("doc_id") % 13 == 0, None).when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return joins.sync_verdict(catalog, docs.where("doc_id % 5 <> 0").select(F.col("doc_id").alias("sid"), was.alias("fingerprint"))).select("sid", "why", "action")


@query("se04_stable_sets", "SELECT path, 'stable' AS state FROM (SELECT DISTINCT l_partkey AS path FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A') UNION ALL SELECT path, 'flaky' FROM ((SELECT l_partkey AS path FROM lineitem WHERE l_returnflag IN ('R', 'A') EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'))")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    green = lambda *f: items.where(F.col("l_returnflag").isin(*f)).select(F.col("l_partkey").alias("path"))
    stable = green("R").intersect(green("A")).withColumn("state", F.lit("stable"))
    return stable.unionByName(green("R", "A").subtract(green("A")).withColumn("state", F.lit("flaky")))


@query("qa19_closed_funnel", f"WITH {cte('trials')}, c AS (SELECT coalesce(subtype, 'none') AS channel, count(*) AS n FROM trials GROUP BY 1) SELECT channel, n, CAST(sum(n) OVER () AS BIGINT) AS channel_sum, (SELECT count(*) FROM trials) AS total, sum(n) OVER () = (SELECT count(*) FROM trials) AS closes FROM c")
def _(spark, sf):
    trials = adapted(spark, sf, "trials")
    channels = trials.groupBy(F.coalesce("subtype", F.lit("none")).alias("channel")).agg(F.count(F.lit(1)).alias("n"))
    return gates.closed_funnel(trials.agg(F.count(F.lit(1)).alias("n")), channels)


PATHS = [(1, "evals/x.ts"), (2, "evals-foo/x.ts"), (3, "/evals"), (4, "src/a.test.ts"), (5, "tests/unit/b.py"), (6, "docs/readme.MD"), (7, "/repo/src/skill/builtin/review/evals/x.json"), (8, "/repo/packages/eval-framework/package.json"), (9, "/eval-framework"), (10, "/usr/lib/x"), (11, "/repo/node_modules/eval-framework/a"), (12, "/home/u/Code/team/app/src/a.py"), (13, "/home/u/Code/team/app-two/b.py"), (14, "/home/u/Code/team/app/.claude/worktrees/w1/c.py"), (15, "/tmp/x"), (16, "/home/u/Code/other/z.py"), (17, "/repo/src/evals/private.ts"), (18, "a/spec/b.rb")]
PATH_SQL = values(PATHS, "id, path")


def path_rows(spark):
    return spark.createDataFrame(PATHS, "id long, path string")


@query("fi08_excluded_paths", f"SELECT id, regexp_replace(path, '^/+', '') = 'evals' OR starts_with(regexp_replace(path, '^/+', ''), 'evals/') AS excluded, regexp_matches(path, '(?i)(^|/)(tests?|__tests__|spec)/|\\.(test|spec)\\.[a-z]+$') AS is_test, regexp_matches(path, '(?i)\\.(md|mdx|rst|txt)$') AS is_doc FROM {PATH_SQL}")
def _(spark, sf):
    p = F.col("path")
    return path_rows(spark).select("id", P.under_any(p, ["evals/"]).alias("excluded"), P.is_test_path(p).alias("is_test"), P.is_doc_path(p).alias("is_doc"))


@query("fi17_leak_classes", f"""SELECT id, CASE WHEN regexp_matches(path, '^/repo/(src|packages)/[^/]*/?skill/builtin/[^/]+/evals(/|$)') THEN 'skill_baseline' WHEN regexp_matches(path, '^/repo/packages/eval-framework/package\\.json$') THEN 'workspace_anchor'
WHEN regexp_matches(path, '^/eval-framework(/|$)') THEN 'external_stub' WHEN regexp_matches(path, '^/repo/node_modules/eval-framework(/|$)') THEN 'linked_stub' WHEN regexp_matches(path, '^/(usr|lib|bin|sbin|etc|opt|var/lib/(apt|dpkg))/') THEN 'base_image' ELSE 'violation' END AS class FROM {PATH_SQL}""")
def _(spark, sf):
    return path_rows(spark).select("id", P.classify_leak(F.col("path")).alias("class"))


@query("st04_repo_of_path", f"""SELECT id, CASE WHEN rel = 'team/app-two' OR starts_with(rel, 'team/app-two/') THEN 'team/app-two' WHEN rel = 'team/app' OR starts_with(rel, 'team/app/') THEN 'team/app' END AS repo
FROM (SELECT id, CASE WHEN starts_with(split_part(path, '/.claude/worktrees/', 1), '/home/u/Code/') THEN substr(split_part(path, '/.claude/worktrees/', 1), 14) END AS rel FROM {PATH_SQL})""")
def _(spark, sf):
    return path_rows(spark).select("id", P.repo_of(F.col("path"), "/home/u/Code/", ["team/app", "team/app-two"]).alias("repo"))


@query("st05_relative_path", f"SELECT id, CASE WHEN starts_with(path, '/home/u/Code/team/app/') THEN substr(path, 23) END AS rel, CASE WHEN starts_with(path, '/home/u/Code/team/app/.claude/worktrees/') THEN 'same_repo_worktree' WHEN starts_with(path, '/home/u/Code/') THEN 'cross_repo' ELSE 'out_of_scope' END AS dropped FROM {PATH_SQL}")
def _(spark, sf):
    repo = F.lit("team/app")
    return path_rows(spark).select("id", P.relative_path(F.col("path"), "/home/u/Code/", repo).alias("rel"), P.classify_dropped(F.col("path"), "/home/u/Code/", repo).alias("dropped"))
