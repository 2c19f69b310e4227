"""Queries on ordered operators: turns, boundaries, intervals, measures, as-of lookups."""

from pyspark.sql import functions as F

from lathework.operators import gates, sessions
from lathework.plans.registry import adapted, cte, query, table, values

SPANS = "spans AS (SELECT sid, seq, concat(CAST(sid AS VARCHAR), '#', CAST(seq AS VARCHAR)) AS unit_id, a AS start, CASE WHEN seq % 4 = 3 THEN NULL ELSE b END AS stop FROM (SELECT sid, idx // 9 AS seq, min(ts) AS a, max(ts) AS b FROM steps GROUP BY sid, idx // 9))"
INTERVALS = """marks AS (SELECT unit_id, spans.sid, seq, min(CASE WHEN ts >= start THEN idx END) AS lo0, min(CASE WHEN ts >= stop THEN idx END) AS cut, max(idx) AS last FROM spans JOIN steps ON spans.sid = steps.sid GROUP BY ALL),
hi AS (SELECT unit_id, max(idx) AS h FROM marks JOIN steps ON marks.sid = steps.sid WHERE cut IS NULL OR idx < cut GROUP BY unit_id),
iv AS (SELECT m.unit_id, m.sid, m.seq, coalesce(lo0, last) AS lo, greatest(coalesce(lo0, last), CASE WHEN cut IS NULL THEN last ELSE coalesce(h, coalesce(lo0, last)) END) AS hi FROM marks m LEFT JOIN hi ON m.unit_id = hi.unit_id)"""
BASE = f"{cte('steps')}, {SPANS}, {INTERVALS}"


def spans(spark, sf):
    steps = adapted(spark, sf, "steps")
    seq = F.floor(F.col("idx") / 9).cast("long")
    out = steps.groupBy("sid", seq.alias("seq")).agg(F.min("ts").alias("start"), F.max("ts").alias("b"))
    out = out.withColumn("unit_id", F.concat(F.col("sid").cast("string"), F.lit("#"), F.col("seq").cast("string")))
    return out.withColumn("end", F.when(F.col("seq") % 4 != 3, F.col("b"))).drop("b"), steps


def intervals(spark, sf):
    s, steps = spans(spark, sf)
    return sessions.step_intervals(s, steps).join(s.select("unit_id", "seq"), "unit_id"), steps


@query("jo03_step_intervals", f"WITH {BASE} SELECT unit_id, sid, lo, hi FROM iv")
def _(spark, sf):
    return intervals(spark, sf)[0].select("unit_id", "sid", "lo", "hi")


@query("ag02_interval_measures", f"WITH {BASE} SELECT iv.unit_id, count(idx) AS n_steps, count_if(is_edit) AS edit_ops, count_if(is_error) AS error_ops, count(DISTINCT tool) AS n_tools FROM iv LEFT JOIN steps ON iv.sid = steps.sid AND idx BETWEEN lo AND hi GROUP BY iv.unit_id")
def _(spark, sf):
    return sessions.measures_in_intervals(*intervals(spark, sf))


WIDE = "w AS (SELECT sid, seq, unit_id, CASE WHEN seq % 5 <> 4 THEN lo - seq % 3 END AS lo, CASE WHEN seq % 5 <> 4 THEN hi + seq % 7 END AS hi FROM iv)"
PART = "p AS (SELECT *, greatest(lo, coalesce(max(hi) OVER (PARTITION BY sid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, lo)) AS l2 FROM w)"


def widened(spark, sf):
    seen = F.col("seq") % 5 != 4
    return intervals(spark, sf)[0].select("sid", "seq", "unit_id", F.when(seen, F.col("lo") - F.col("seq") % 3).alias("lo"), F.when(seen, F.col("hi") + F.col("seq") % 7).alias("hi"))


@query("wi06_enforce_partition", f"WITH {BASE}, {WIDE}, {PART} SELECT unit_id, CASE WHEN l2 <= hi THEN l2 END AS lo, CASE WHEN l2 <= hi THEN hi END AS hi FROM p")
def _(spark, sf):
    return sessions.enforce_partition(widened(spark, sf)).select("unit_id", "lo", "hi")


@query('wi09_interval_faults', f'''WITH {BASE}, {WIDE}, f AS (SELECT unit_id, coalesce(lo <= lag(hi) OVER x, FALSE) AS "overlaps", coalesce(lo < lag(lo) OVER x, FALSE) AS backward FROM w WHERE lo IS NOT NULL WINDOW x AS (PARTITION BY sid ORDER BY seq)) SELECT * FROM f WHERE "overlaps" OR backward''')
def _(spark, sf):
    return sessions.interval_faults(widened(spark, sf)).select("unit_id", "overlaps", "backward")


@query("ag01_session_measures", f"WITH {cte('steps')} SELECT sid, count(*) AS n_steps, count(tool) AS n_tool_calls, array_to_string(list_sort(list(DISTINCT tool)), ',') AS unique_tools, count_if(is_error) AS error_ops, count_if(is_edit) AS edit_ops, count(DISTINCT path) AS n_paths, substr(sha256(array_to_string(list_sort(list(DISTINCT path)), chr(10))), 1, 16) AS path_hash FROM steps GROUP BY sid")
def _(spark, sf):
    return sessions.measures(adapted(spark, sf, "steps"), "sid").withColumn("unique_tools", F.array_join("unique_tools", ","))


@query("ag03_mode_first_seen", f"WITH {cte('steps')}, c AS (SELECT sid, tool, count(*) AS hits, min(idx) AS f FROM steps GROUP BY sid, tool) SELECT sid, tool, hits FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY hits DESC, f) AS r FROM c) WHERE r = 1")
def _(spark, sf):
    return sessions.mode(adapted(spark, sf, "steps"), "sid", "tool", "idx")


VOTES = "votes AS (SELECT c_custkey AS sid, CASE c_custkey % 4 WHEN 0 THEN NULL ELSE 'a' END AS wd, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a' ELSE 'b' END AS raw, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'c' ELSE 'a' END AS traj FROM customer)"


@query("ag05_repo_vote", f"""WITH {VOTES}, t AS (SELECT *, coalesce(traj, wd, raw) AS repo, (wd IS NOT NULL)::INT + (raw IS NOT NULL)::INT + (traj IS NOT NULL)::INT AS n FROM votes),
a AS (SELECT *, coalesce((wd = repo)::INT, 0) + coalesce((raw = repo)::INT, 0) + coalesce((traj = repo)::INT, 0) AS g FROM t)
SELECT sid, repo, CASE WHEN n = 0 THEN 'unresolved' WHEN n = 3 AND g = 3 THEN 'direct' WHEN g = n AND n = 1 THEN 'inferred' WHEN g >= 2 THEN 'voted' ELSE 'conflict' END AS resolution FROM a""")
def _(spark, sf):
    k = F.col("c_custkey")
    votes = table(spark, sf, "customer").select(k.alias("sid"), F.when(k % 4 != 0, "a").alias("wd"), F.when(k % 3 == 1, "a").when(k % 3 == 2, "b").alias("raw"), F.when(k % 5 == 1, "c").when(k % 5 != 0, "a").alias("traj"))
    repo, resolution = sessions.resolve_repo(F.col("wd"), F.col("raw"), F.col("traj"))
    return votes.select("sid", repo.alias("repo"), resolution.alias("resolution"))


@query("jo05_as_of", "SELECT c_custkey, l_shipdate, o.o_orderkey AS last_order FROM (SELECT l_shipdate, l_orderkey % 500 AS c_custkey FROM lineitem) e ASOF LEFT JOIN (SELECT o_custkey % 500 AS k, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) o ON e.c_custkey = o.k AND e.l_shipdate >= o.o_orderdate")
def _(spark, sf):
    events = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("c_custkey"), "l_shipdate")
    history = table(spark, sf, "orders").select((F.col("o_custkey") % 500).alias("c_custkey"), "o_orderdate", F.col("o_orderkey").alias("last_order"))
    return sessions.as_of(events, history, ["c_custkey"], "l_shipdate", "o_orderdate", "last_order")


@query("jo02_failed_actions", "WITH a AS (SELECT user_id AS sid, event_id AS tool_use_id FROM events WHERE event_type <> 'error'), o AS (SELECT user_id AS sid, event_id - 1 AS tool_use_id, event_id AS idx, event_type = 'error' AS e FROM events UNION ALL SELECT user_id, event_id, event_id - 100, TRUE FROM events WHERE event_id % 6 = 0), l AS (SELECT sid, tool_use_id, arg_max(e, idx) AS failed FROM o GROUP BY ALL) SELECT a.sid, a.tool_use_id, coalesce(failed, FALSE) AS failed FROM a LEFT JOIN l ON a.sid = l.sid AND a.tool_use_id = l.tool_use_id")
def _(spark, sf):
    e = table(spark, sf, "events")
    actions = e.where("event_type <> 'error'").select(F.col("user_id").alias("sid"), F.col("event_id").alias("tool_use_id"))
    first = e.select(F.col("user_id").alias("sid"), (F.col("event_id") - 1).alias("tool_use_id"), F.col("event_id").alias("idx"), (F.col("event_type") == "error").alias("is_error"))
    more = e.where("event_id % 6 = 0").select(F.col("user_id").alias("sid"), F.col("event_id").alias("tool_use_id"), (F.col("event_id") - 100).alias("idx"), F.lit(True).alias("is_error"))
    return sessions.failed_actions(actions, first.unionByName(more))


FEW = "followup AS (SELECT *, (length(p) < 20 AND (starts_with(lower(p), 'ok') OR starts_with(lower(p), 'next') OR starts_with(lower(p), 'why') OR starts_with(lower(p), 'again'))) OR starts_with(lower(p), 'continue') OR starts_with(lower(p), 'go on') AS fu, length(trim(t)) >= 40 AND regexp_matches(t, '(implement|add|create|fix|refactor|optimi[sz]e|remove|delete|analy[sz]e|investigate|review|design|write|generate|deploy|upgrade|migrate|test|verify|split|merge|rename|replace|support)') AS task FROM (SELECT *, trim(t) AS p FROM src))"
TURN_TEXT = [(0, "please fix the crash in the parser when the input has no header line"), (1, "ok"), (2, "continue with the second file and then with all of the others too"), (3, "add a new command that prints the version of every dependency"), (4, "what is this"), (5, "next"), (6, "look at it")]
TURNS = f"src AS (SELECT c.conv_id AS sid, c.turn AS seq, CAST(c.conv_id * 10 + c.turn * c.turn * 400 AS DOUBLE) AS ts, v.text AS t, CASE (c.conv_id + c.turn) % 4 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN ['b'] WHEN 2 THEN [] ELSE ['z'] END AS files FROM conversations c JOIN {values(TURN_TEXT, 'k, text')} v ON (c.conv_id * 3 + c.turn * 5) % 7 = v.k)"


def turns_with_files(spark, sf):
    texts = spark.createDataFrame(TURN_TEXT, "k long, text string")
    c = adapted(spark, sf, "turns").drop("text")
    k = (F.col("sid") + F.col("seq")) % 4
    files = F.when(k == 0, F.array(F.lit("a"), F.lit("b"))).when(k == 1, F.array(F.lit("b"))).when(k == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("z")))
    return c.join(F.broadcast(texts), (F.col("sid") * 3 + F.col("seq") * 5) % 7 == F.col("k")).select("sid", "seq", "text", "ts_epoch", files.alias("files"))


@query("wi05_boundaries", f"""WITH RECURSIVE {TURNS}, {FEW}, o AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq) AS n, coalesce(ts - lag(ts) OVER (PARTITION BY sid ORDER BY seq) > 1800, FALSE) AS gap FROM followup),
r AS (
  SELECT sid, seq, n, 'B_FIRST' AS reason, files AS seen FROM o WHERE n = 1
  UNION ALL
  SELECT sid, seq, n, reason, CASE WHEN reason IS NOT NULL THEN files ELSE list_distinct(list_concat(seen, files)) END FROM (
    SELECT o.sid, o.seq, o.n, o.files, r.seen, CASE WHEN fu THEN NULL WHEN gap THEN 'B_TIME_GAP' WHEN len(r.seen) > 0 AND len(o.files) > 0 AND NOT list_has_any(r.seen, o.files) THEN 'B_FILE_DISJOINT' WHEN task THEN 'B_TASK_PATTERN' END AS reason
    FROM o JOIN r ON o.sid = r.sid AND o.n = r.n + 1)
) SELECT sid, seq::INTEGER AS seq, reason, reason IS NOT NULL AS boundary, CASE WHEN reason = 'B_TASK_PATTERN' THEN 'medium' WHEN reason IS NOT NULL THEN 'high' END AS confidence FROM r""")
def _(spark, sf):
    return sessions.boundaries(turns_with_files(spark, sf))


@query("wi07_first_turns", "WITH t AS (SELECT conv_id AS sid, turn AS line_no, text, CASE WHEN turn % 3 = 0 THEN NULL ELSE CAST(10 - turn AS VARCHAR) END AS ts FROM conversations), k AS (SELECT *, row_number() OVER (PARTITION BY sid, substr(text, 1, 200) ORDER BY line_no) AS n FROM t) SELECT sid, line_no, row_number() OVER (PARTITION BY sid ORDER BY coalesce(ts, ''), line_no) AS seq FROM k WHERE n = 1")
def _(spark, sf):
    t = adapted(spark, sf, "turns")
    t = t.select("sid", "line_no", "text", F.when(F.col("line_no") % 3 != 0, (10 - F.col("line_no")).cast("string")).alias("ts"), F.lit(None).cast("long").alias("raw_idx"))
    return sessions.first_turns(t).select("sid", "line_no", "seq")


@query("wi03_unit_ids", f"WITH {cte('turns')} SELECT sid, row_number() OVER w - 1 AS seq, format('{{}}#{{:02d}}', sid, row_number() OVER w - 1) AS unit_id FROM turns WHERE role = 'user' WINDOW w AS (PARTITION BY sid ORDER BY line_no)")
def _(spark, sf):
    return sessions.with_unit_ids(adapted(spark, sf, "turns").where("role = 'user'"), F.col("line_no")).select("sid", "seq", "unit_id")


@query("wi02_ended_by", f"WITH {cte('turns')} SELECT sid, line_no, lead(ts_epoch) OVER w AS next_ts, CASE WHEN lead(1) OVER w IS NULL THEN 'session_end' ELSE 'next_unit' END AS ended_by FROM turns WINDOW w AS (PARTITION BY sid ORDER BY line_no)")
def _(spark, sf):
    return sessions.ended_by(adapted(spark, sf, "turns").withColumn("ts", F.col("ts_epoch")), F.col("line_no")).select("sid", "line_no", "next_ts", "ended_by")


@query("qa07_interval_gate", f"WITH {BASE} SELECT gate, ok, detail FROM (SELECT 'lo_before_hi' AS gate, count_if(lo > hi) = 0 AS ok, concat(count_if(lo > hi), ' of ', count(*)) AS detail FROM iv UNION ALL SELECT 'not_negative', count_if(lo < 0) = 0, concat(count_if(lo < 0), ' of ', count(*)) FROM iv)")
def _(spark, sf):
    return gates.assertions(intervals(spark, sf)[0], {"lo_before_hi": F.col("lo") <= F.col("hi"), "not_negative": F.col("lo") >= 0})
