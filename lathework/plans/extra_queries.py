"""Queries on rebuilding, matching, assertions, sources and session windows."""

from pyspark.sql import functions as F

from lathework.operators import assertions, rebuild
from lathework.plans.registry import query, table, values
from lathework.sources import readers
from lathework.streaming import sessions as streams

OPS = [
    ("u1", "a.py", 0, "Edit", None, "x = 1", "x = 2", False), ("u1", "a.py", 1, "Edit", None, "y", "z", True), ("u1", "b.py", 0, "Write", "new\n", None, None, None), ("u1", "c.py", 0, "Edit", None, "missing", "q", False),
    ("u2", "d.py", 0, "Edit", None, "old", "q", False), ("u2", "e.py", 0, "Edit", None, "", "fresh", False), ("u2", "f.py", 0, "Write", None, None, None, None), ("u2", "g.py", 0, "MultiEdit", None, None, None, None),
]
BASES = [("u1", "a.py", "x = 1\ny y\nx = 1"), ("u1", "c.py", "text"), ("u2", "g.py", "g")]
REBUILT = [("u1", "a.py", "x = 2\nz z\nx = 1", None), ("u1", "b.py", "new\n", None), ("u1", "c.py", None, "old_string_not_found"), ("u2", "d.py", None, "phantom_file"), ("u2", "e.py", "fresh", None), ("u2", "f.py", None, "write_without_content"), ("u2", "g.py", None, "empty_multiedit")]


@query("ne04_apply_edits", f"SELECT unit_id, path, final, failure FROM {values(REBUILT, 'unit_id, path, final, failure')}")
def _(spark, sf):
    ops = spark.createDataFrame(OPS, "unit_id string, path string, idx int, tool string, content string, old string, new string, all boolean")
    return rebuild.rebuilt_files(spark.createDataFrame(BASES, "unit_id string, path string, text string"), ops)


INPUTS = [(1, '{"a": "x", "n": 1}'), (2, "{'a': 'x', 'ok': True}"), (3, "[1, 2]"), (4, None), (5, "garbage")]


@query("st38_tool_input", f"SELECT id, a, n FROM {values([(1, 'x', 2), (2, 'x', 2), (3, None, 0), (4, None, 0), (5, None, 0)], 'id, a, n')}")
def _(spark, sf):
    out = rebuild.with_tool_input(spark.createDataFrame(INPUTS, "id int, v string"), "v")
    return out.select("id", F.try_element_at("v", F.lit("a")).alias("a"), F.size("v").alias("n"))


@query("jo07_greedy_matches", "SELECT conv_id AS sid, count(*)::INTEGER AS tp, 0 AS fp, 0 AS fn FROM conversations WHERE role = 'user' GROUP BY conv_id")
def _(spark, sf):
    user = table(spark, sf, "conversations").where("role = 'user'").select(F.col("conv_id").alias("sid"), F.col("turn").alias("seq"), "text")
    return rebuild.judged_segmentation(user, user.withColumn("text", F.upper("text")))


@query("ma11_precision_recall", "WITH n AS (SELECT count(*)::BIGINT AS n FROM conversations WHERE role = 'user') SELECT n AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS precision, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS recall FROM n")
def _(spark, sf):
    user = table(spark, sf, "conversations").where("role = 'user'").select(F.col("conv_id").alias("sid"), F.col("turn").alias("seq"), "text")
    return rebuild.precision_recall(rebuild.judged_segmentation(user, user))


@query("st36_json_damage", "SELECT path, line_no FROM (VALUES ('p', 1)) v(path, line_no)")
def _(spark, sf):
    before = spark.createDataFrame([("p", 0, '{"a": 1}'), ("p", 1, '{"a": "b"}'), ("p", 2, "not json")], "path string, line_no int, line string")
    after = spark.createDataFrame([("p", 0, '{"a": 1}'), ("p", 1, '{"a": "b}'), ("p", 2, "still not")], "path string, line_no int, line string")
    return rebuild.json_damage(before, after)


RUNS = [(1, ["Read", "read", "Grep", "Edit"], "The parser uses JWT and TypeScript and the cache", "Explain why JWT fails", 12, "end_turn"), (2, ["Bash"] * 3, "", "p", 40, "error"), (3, ["grep"] * 3, "the cache, the parser, the lexer", "q", 30, None)]
WANTED = {"execution_must_call_tools_any_of": ["edit", "write"], "execution_must_not_call_tools": ["bash"], "final_response_must_include_any_of": ["JWT"], "final_response_must_include_some_keywords": ["cache", "parser"], "final_response_must_include_count_keywords_min_3": ["cache", "parser", "lexer"], "max_steps": None, "exit_status_must_be": ["end_turn"], "unique_tools_count_min_2": None, "read_call_count_le_5": None, "execution_must_not_call_tools_overuse_grep_3plus": None, "final_response_min_length": 5}
TRUTH = {1: (1, 1, 0, 1, 0, 1, 1, 1, 1, 1, 1), 2: (0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0), 3: (0, 1, 0, 1, 1, 1, 0, 0, 1, 0, 1)}


@query("as_process_assertions", f"SELECT sid, assertion, ok FROM {values([(s, k, bool(t)) for s, row in TRUTH.items() for k, t in zip(WANTED, row, strict=True)], 'sid, assertion, ok')}")
def _(spark, sf):
    runs = spark.createDataFrame(RUNS, "sid int, tools array<string>, response string, prompt string, steps int, exit_status string")
    return assertions.check(runs, WANTED)


XML = '<testsuites><testsuite name="n" file="a.test.ts" tests="2" failures="0"><testsuite name="inner" tests="1" failures="0"/></testsuite><testsuite name="n" file="b.test.ts" tests="1" failures="1"/><testsuite name="n" file="c.test.ts" tests="0" failures="0"/></testsuites>'


@query("io21_green_suites", "SELECT 1 AS id, 'a.test.ts' AS green UNION ALL SELECT 2, ''")
def _(spark, sf):
    return spark.createDataFrame([(1, XML), (2, "<testsuites/>")], "id int, xml string").select("id", F.array_join(readers.green_suites(F.col("xml")), ",").alias("green"))


JOBS = [("2026-09-10__01-02-03", "abc"), ("2026-09-11__01-02-03", ""), ("notes", "abc"), ("2026-09-10__01-02-03", "def")]


@query("io25_jobs_in_manifest", "SELECT '2026-09-10__01-02-03' AS job")
def _(spark, sf):
    return readers.jobs_in_manifest(spark.createDataFrame(JOBS, "job string, sha256 string"))


@query("fi22_topmost", "SELECT path FROM (VALUES ('a/b'), ('c'), ('d/e')) v(path)")
def _(spark, sf):
    return readers.topmost(spark.createDataFrame([("a/b",), ("a/b/c",), ("c",), ("c/d/e",), ("d/e",)], "path string"))


@query("wi04_session_windows", """WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE, TRUE)::INT AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def _(spark, sf):
    return streams.sessionized(table(spark, sf, "events").select("user_id", "ts"))


@query("hourly_event_counts", "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    return streams.hourly_errors(table(spark, sf, "events"))


STAMPS = [(1, "2026-06-01T10:00:00Z"), (2, "2026-06-01T12:00:00+02:00"), (3, "2026-06-01T10:00:00"), (4, "garbage"), (5, None), (6, "2026-05-31T23:59:59")]


@query("dt01_parse_ts", f"SELECT id, CAST(e AS BIGINT) AS epoch, CAST(recent AS BOOLEAN) AS recent FROM {values([(1, 1780308000, True), (2, 1780308000, True), (3, 1780308000, True), (4, None, True), (5, None, False), (6, 1780271999, False)], 'id, e, recent')}")
def _(spark, sf):
    rows = spark.createDataFrame(STAMPS, "id int, ts string")
    return rows.select("id", F.unix_seconds(F.try_to_timestamp("ts")).alias("epoch"), (F.coalesce("ts", F.lit("")) >= "2026-06").alias("recent"))
