"""Operators whose cases are fixtures elsewhere, here over whole tables, with expectations computed in SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions import paths as P
from lathework.functions import redaction as R
from lathework.functions import text as X
from lathework.operators import gates, rebuild, turns
from lathework.plans.registry import TABLES, literal, query
from lathework.plans.rule_queries import ENTROPY
from lathework.plans.text_queries import GOLD


def over(name: str, source: str, expected: str, apply: Callable[[DataFrame], DataFrame]) -> None:
    """Registers a query: rows of `source` (SQL that both engines read), to which `apply` and `expected` are applied."""

    @query(name, f"WITH src AS ({source.format(**{t: t for t in TABLES})}) {expected}")
    def _(spark, sf):
        used = [t for t in TABLES if "{" + t + "}" in source]
        return apply(spark.sql(source, **{t: spark.read.parquet(f"{sf}/{t}.parquet") for t in used}))


ORDER, DOC = "CAST(o_orderkey AS VARCHAR(20))", "CAST(doc_id AS VARCHAR(20))"
HEX = f"md5({ORDER})"
NL = "chr(10)"
UUID = f"concat(substr({HEX}, 1, 8), '-', substr({HEX}, 9, 4), '-', substr({HEX}, 13, 4), '-', substr({HEX}, 17, 4), '-', substr({HEX}, 21, 12))"

over(
    "st02_agent_sources_of_orders",
    f"SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN {UUID} WHEN 1 THEN concat('20260901-', substr({HEX}, 1, 6)) WHEN 2 THEN substr({HEX}, 1, 8) ELSE {ORDER} END AS sid, CASE o_orderkey % 7 WHEN 0 THEN 'Own-CLI' WHEN 1 THEN '' END AS tool FROM {{orders}}",
    "SELECT id, CASE WHEN lower(coalesce(tool, '')) = 'own-cli' THEN 'own_cli' WHEN length(sid) = 36 AND length(sid) - length(replace(sid, '-', '')) = 4 THEN 'claude_code' WHEN regexp_matches(sid, '^[0-9]{8}') THEN 'codex' ELSE 'short_id' END AS agent_source FROM src",
    lambda d: d.select("id", X.agent_source(F.col("sid"), F.col("tool")).alias("agent_source")),
)
over(
    "st03_provenance_of_orders",
    "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'clean' WHEN 1 THEN '' END AS s, CASE o_orderkey % 4 WHEN 0 THEN 'abc' WHEN 1 THEN '' END AS h FROM {orders}",
    "SELECT id, CASE WHEN coalesce(s, '') <> '' OR coalesce(h, '') <> '' THEN 'anchored' ELSE 'unanchored' END AS provenance FROM src",
    lambda d: d.select("id", X.provenance(F.col("s"), F.col("h")).alias("provenance")),
)

ROOT, REPOS, TREE = "/home/u/Code/", ["team", "team/app"], P.WORKTREE
PATHS = f"SELECT l_orderkey, l_linenumber, l_partkey, concat(CASE l_partkey % 6 WHEN 0 THEN '{ROOT}team/app/' WHEN 1 THEN '{ROOT}team/' WHEN 2 THEN '{ROOT}team/app{TREE}w1/' WHEN 3 THEN '{ROOT}teams/' WHEN 4 THEN '{ROOT}other/' ELSE '/opt/x/' END, 'src/f', CAST(l_suppkey % 30 AS VARCHAR(9)), '.py') AS path FROM {{lineitem}}"
REPO = f"CASE WHEN starts_with(bare, '{ROOT}team/app/') OR bare = '{ROOT}team/app' THEN 'team/app' WHEN starts_with(bare, '{ROOT}team/') OR bare = '{ROOT}team' THEN 'team' END"
over(
    "st04_repos_of_paths",
    PATHS,
    f"SELECT l_orderkey, l_linenumber, l_partkey, repo, CASE WHEN starts_with(path, concat('{ROOT}', repo, '/')) THEN substr(path, length(concat('{ROOT}', repo, '/')) + 1) END AS relative, CASE WHEN starts_with(bare, concat('{ROOT}', repo, '/')) THEN substr(bare, length(concat('{ROOT}', repo, '/')) + 1) END AS known, coalesce(starts_with(path, concat('{ROOT}', repo, '/')), FALSE) AS same, CASE WHEN starts_with(path, '{ROOT}team/app{TREE}') THEN 'same_repo_worktree' WHEN starts_with(path, '{ROOT}') THEN 'cross_repo' ELSE 'out_of_scope' END AS dropped FROM (SELECT *, {REPO} AS repo FROM (SELECT *, split_part(path, '{TREE}', 1) AS bare FROM src))",
    lambda d: d.withColumn("repo", P.repo_of(F.col("path"), ROOT, REPOS)).withColumn("relative", P.relative_path(F.col("path"), ROOT, F.col("repo"))).select("l_orderkey", "l_linenumber", "l_partkey", "repo", "relative", P.relative_in_known(F.col("path"), ROOT, REPOS).alias("known"), P.round_trips(F.col("path"), F.col("relative"), ROOT, F.col("repo")).alias("same"), P.classify_dropped(F.col("path"), ROOT, F.lit("team/app")).alias("dropped")),
)
over(
    "st06_first_prompts_of_conversations",
    "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN concat('  <system-reminder>', text) WHEN 1 THEN substr(text, 1, CAST(5 + conv_id % 9 AS INT)) ELSE text END AS t FROM {conversations}",
    f"SELECT conv_id, coalesce(arg_min(t, turn) FILTER (WHERE length(s) > 10 AND NOT ({' OR '.join(f'starts_with(s, {literal(m)})' for m in X.PROMPT_MARKS)})), arg_min(t, turn)) AS prompt FROM (SELECT *, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS s FROM src) GROUP BY conv_id",
    lambda d: d.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]).alias("b")).select("conv_id", X.first_prompt(F.col("b")).alias("prompt")),
)
over(
    "st07_directories_in_documents",
    f"SELECT doc_id, concat('Primary working directory: /home/u/d ', CAST(doc_id % 5 AS VARCHAR(3)), {NL}, coalesce(text, ''), {NL}, 'Working directory = /w/', CAST(doc_id % 3 AS VARCHAR(3)), ' ', {NL}, 'Working directory: /no-end') AS t FROM {{documents}}",
    f"SELECT doc_id, array_to_string(regexp_extract_all(t, {literal(X.WORKING_DIRECTORY)}, 1), '|') AS found FROM src",
    lambda d: d.select("doc_id", F.array_join(X.working_directories(F.col("t")), "|").alias("found")),
)
over(
    "st08_commands_of_orders",
    "SELECT o_orderkey AS id, concat('cd x', CASE o_orderkey % 3 WHEN 0 THEN ' && ' WHEN 1 THEN '; ' ELSE ' | ' END, CASE o_orderkey % 8 WHEN 0 THEN 'bun  test a && eslint .' WHEN 1 THEN 'npm run test' WHEN 2 THEN 'make build; make test' WHEN 3 THEN 'echo hi' WHEN 4 THEN 'pytest -q' WHEN 5 THEN 'mytsc' WHEN 6 THEN 'tsc -p' ELSE 'go test ./...' END) AS cmd FROM {orders}",
    f"SELECT id, array_to_string(m, '|') AS whole, array_to_string(list_transform(m, lambda x: regexp_extract(x, '^\\S+')), '|') AS first_word FROM (SELECT id, regexp_extract_all(cmd, {literal(X.TEST_COMMAND)}, 1) AS m FROM src)",
    lambda d: d.select("id", F.array_join(X.test_commands(F.col("cmd")), "|").alias("whole"), F.array_join(X.test_commands(F.col("cmd"), True), "|").alias("first_word")),
)
over(
    "st16_confidence_of_events",
    "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'B_FIRST' WHEN 1 THEN 'B_TIME_GAP' WHEN 2 THEN 'B_FILE_DISJOINT' WHEN 3 THEN 'B_TASK_PATTERN' WHEN 4 THEN event_type END AS reason FROM {events}",
    "SELECT event_id, CASE WHEN reason = 'B_TASK_PATTERN' THEN 'medium' WHEN reason IN ('B_FIRST', 'B_TIME_GAP', 'B_FILE_DISJOINT') THEN 'high' ELSE 'low' END AS confidence FROM src",
    lambda d: d.select("event_id", X.boundary_confidence(F.col("reason")).alias("confidence")),
)
over(
    "st19_keys_of_orders",
    f"SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN substr({HEX}, 1, CAST(18 + o_orderkey % 6 AS INT)) WHEN 1 THEN upper({HEX}) WHEN 2 THEN concat('a-lower-case-name-', {ORDER}) WHEN 3 THEN 'aaaaaaaaaaaaaaaaaaaaaaaaa1' ELSE concat('Some_Name_', {HEX}) END AS m FROM {{orders}}",
    f"SELECT id, length(m) >= 20 AND NOT regexp_matches(m, '^[a-z0-9]+(?:-[a-z0-9]+)+$') AND {ENTROPY} >= 3.5 AND regexp_matches(m, '[A-Z0-9]') AS real FROM src",
    lambda d: d.select("id", R.looks_like_real_key(F.col("m")).alias("real")),
)
over(
    "st21_severities_of_orders",
    "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS a, CASE o_orderkey % 5 WHEN 0 THEN 'medium' WHEN 1 THEN 'low' WHEN 2 THEN 'other' END AS b FROM {orders}",
    "SELECT id, CASE WHEN a = 'high' OR b = 'high' THEN 'high' WHEN a = 'medium' OR b = 'medium' THEN 'medium' WHEN a = 'low' OR b = 'low' THEN 'low' END AS worst FROM src",
    lambda d: d.select("id", R.worst_severity(F.filter(F.array("a", "b"), lambda x: x.isNotNull())).alias("worst")),
)
over(
    "st28_fences_in_documents",
    f"SELECT doc_id, replace(coalesce(text, ''), '. ', concat('.', {NL}, CASE WHEN doc_id % 2 = 0 THEN '  ' ELSE '' END, '```py', {NL})) AS t FROM {{documents}}",
    f"""SELECT doc_id, md5(coalesce(string_agg(CASE WHEN fence THEN {literal(X.FENCE_MARK)} ELSE line END, {NL} ORDER BY i) FILTER (WHERE CASE WHEN fence THEN k % 2 = 1 ELSE k % 2 = 0 END), '')) AS digest
    FROM (SELECT *, count_if(fence) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (SELECT doc_id, i, line, regexp_matches(line, '^[ \\t]*```') AS fence FROM (SELECT doc_id, unnest(string_split(t, {NL})) AS line, generate_subscripts(string_split(t, {NL}), 1) AS i FROM src))) GROUP BY doc_id""",
    lambda d: d.select("doc_id", F.md5(X.strip_fenced_blocks(F.col("t"))).alias("digest")),
)
over(
    "st29_controls_in_documents",
    f"SELECT doc_id, concat(coalesce(text, ''), chr(7), {DOC}, chr(27), '[0m', chr(9), chr(13), {NL}) AS t FROM {{documents}}",
    "SELECT doc_id, md5(replace(replace(t, chr(7), '\\x07'), chr(27), '\\x1b')) AS digest FROM src",
    lambda d: d.select("doc_id", F.md5(X.visible_controls(F.col("t"))).alias("digest")),
)
DIFF = f"SELECT doc_id AS task, concat('diff --git a/src/f', {DOC}, CASE doc_id % 3 WHEN 0 THEN '.test.ts' ELSE '.ts' END, ' b/f', {NL}, '+++ b/f', {NL}, '-', replace(coalesce(text, ''), {NL}, concat({NL}, CASE doc_id % 2 WHEN 0 THEN '+' ELSE '+// ' END)), CASE doc_id % 5 WHEN 0 THEN {NL} ELSE '' END) AS diff, text AS prompt FROM {{documents}}"
over(
    "st30_gold_lines_of_documents",
    DIFF,
    f"SELECT task, md5(array_to_string({GOLD}, '|')) AS lines, CASE WHEN len(list_filter(regexp_extract_all(diff, '(?m)^diff --git a/(\\S+)', 1), lambda f: contains(f, '.test.') OR contains(f, '/tests/'))) > 0 THEN 'test_change' ELSE 'source_change' END AS kind, CASE WHEN ends_with(replace(replace(diff, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) THEN 0 ELSE 1 END AS lacks_end FROM src",
    lambda d: d.select("task", F.md5(F.array_join(X.gold_candidates(F.col("diff")), "|")).alias("lines"), X.task_kind(F.col("diff")).alias("kind"), (F.length(X.normalize_patch(F.col("diff"))) - F.length(F.regexp_replace("diff", "\r\n|\r", "\n"))).alias("lacks_end")),
)
over(
    "jo13_leaks_of_documents",
    DIFF,
    f"SELECT task, count(*) AS n, md5(string_agg(line, '|' ORDER BY line)) AS lines FROM (SELECT task, prompt, unnest({GOLD}) AS line FROM src) WHERE contains(prompt, line) GROUP BY task",
    lambda d: gates.prompt_leaks(d.select("task", "diff"), d.select("task", "prompt")).groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("line")), "|")).alias("lines")),
)
over(
    "st32_numbered_documents",
    f"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat('  1→', replace(coalesce(text, ''), {NL}, concat({NL}, ' 22→'))) WHEN 1 THEN concat('1→', coalesce(text, '')) ELSE coalesce(text, '') END AS t FROM {{documents}}",
    f"SELECT doc_id, md5(CASE WHEN len(list_filter(l, lambda x: regexp_matches(x, '^\\s*[0-9]+(→|\\t)'))) >= 0.8 * len(l) THEN array_to_string(list_transform(l, lambda x: regexp_replace(x, '^\\s*[0-9]+(→|\\t)', '')), {NL}) ELSE t END) AS digest FROM (SELECT *, string_split(t, {NL}) AS l FROM src)",
    lambda d: d.select("doc_id", F.md5(X.strip_line_numbers(F.col("t"))).alias("digest")),
)
over(
    "st33_quoted_paths_of_documents",
    f"SELECT doc_id, concat(coalesce(text, ''), ' see `docs/f', CAST(doc_id % 9 AS VARCHAR(3)), '.md` and \"src/', {DOC}, '.ts\" or `docs/f', CAST(doc_id % 7 AS VARCHAR(3)), '.md` and x.y') AS t FROM {{documents}}",
    "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '[\"''`]([A-Za-z0-9_./-]+\\.[A-Za-z0-9]+)[\"''`]', 1))), ',') AS paths FROM src",
    lambda d: d.select("doc_id", F.array_join(X.quoted_paths(F.col("t")), ",").alias("paths")),
)
over(
    "st35_fixpoint_of_documents",
    "SELECT doc_id, concat('a<<x>x>', coalesce(text, ''), '<<<x>x>x>b') AS t FROM {documents}",
    "SELECT doc_id, md5(replace(replace(replace(t, '<x>', ''), '<x>', ''), '<x>', '')) AS digest FROM src",
    lambda d: d.select("doc_id", F.md5(X.redact_to_fixpoint(F.col("t"), "<x>", "")).alias("digest")),
)
over(
    "st38_tool_inputs_of_orders",
    f"SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN concat('{{{{\"a\": \"v', {ORDER}, '\", \"n\": 1}}}}') WHEN 1 THEN concat('{{{{''a'': ''w', {ORDER}, ''', ''ok'': True, ''x'': None}}}}') WHEN 2 THEN '[1, 2]' WHEN 3 THEN concat('garbage ', {ORDER}) END AS v FROM {{orders}}",
    "SELECT id, CASE id % 5 WHEN 0 THEN concat('v', id) WHEN 1 THEN concat('w', id) END AS a, CASE id % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 0 END AS n FROM src",
    lambda d: rebuild.with_tool_input(d, "v").select("id", F.try_element_at("v", F.lit("a")).alias("a"), F.size("v").alias("n")),
)
over(
    "ne04_edits_of_orders",
    "SELECT CAST(l_orderkey AS VARCHAR(20)) AS unit_id, CAST(l_linenumber AS INT) AS idx, min(l_partkey) AS part FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    """SELECT unit_id, 'f' AS path, CASE WHEN bool_or(part % 11 = 0) THEN NULL ELSE concat('top ', (SELECT string_agg(coalesce('N' || m.part, concat('l', i)), ' ' ORDER BY i) FROM range(1, 8) r(i) LEFT JOIN src m ON m.unit_id = s.unit_id AND m.idx = i), ' end') END AS final, CASE WHEN bool_or(part % 11 = 0) THEN 'old_string_not_found' END AS failure FROM src s GROUP BY unit_id""",
    lambda d: rebuild.rebuilt_files(
        d.select("unit_id", F.lit("f").alias("path"), F.lit("top l1 l2 l3 l4 l5 l6 l7 end").alias("text")).distinct(),
        d.select("unit_id", F.lit("f").alias("path"), "idx", F.lit("Edit").alias("tool"), F.lit(None).cast("string").alias("content"), F.when(F.col("part") % 11 == 0, "not there").otherwise(F.concat(F.lit("l"), F.col("idx").cast("string"))).alias("old"), F.concat(F.lit("N"), F.col("part").cast("string")).alias("new"), F.lit(False).alias("all")),
    ),
)
over(
    "ne08_write_calls_of_orders",
    "SELECT o_orderkey AS id, concat('[', CASE WHEN o_orderkey % 2 = 0 THEN '\"name\": \"Edit\", ' ELSE '' END, CASE WHEN o_orderkey % 3 = 0 THEN '\"name\" : \"write\", ' ELSE '' END, CASE WHEN o_orderkey % 5 = 0 THEN '\"name\":\"MultiEdit\", ' ELSE '' END, '\"name\": \"Edits\", \"names\": \"Edit\"]') AS j FROM {orders}",
    "SELECT id, CAST((id % 2 = 0)::INT + (id % 3 = 0)::INT + (id % 5 = 0)::INT AS INTEGER) AS n_writes FROM src",
    lambda d: turns.write_calls(d, "j", ["edit", "write", "multiedit"]).select("id", "n_writes"),
)
over(
    "wi14_first_edits_of_orders",
    "SELECT CAST(l_orderkey AS VARCHAR(20)) AS unit_id, concat('f', CAST(l_suppkey % 3 AS VARCHAR(3))) AS path, l_partkey * 1000 + l_suppkey AS idx, CASE WHEN l_linenumber % 3 = 0 THEN 'Write' ELSE 'Edit' END AS tool, concat('old', CAST(l_linenumber AS VARCHAR(3))) AS old FROM {lineitem}",
    "SELECT unit_id, path, min(idx) AS idx, arg_min(old, (idx, old)) AS old FROM src WHERE tool = 'Edit' GROUP BY unit_id, path",
    lambda d: turns.first_edits(d),
)
over(
    "fi12_test_files_of_lineitems",
    "SELECT l_orderkey, l_linenumber, l_partkey, concat(CASE l_partkey % 3 WHEN 0 THEN 'a.test.d/' WHEN 1 THEN 'docs/' ELSE '' END, 'x', CASE l_suppkey % 5 WHEN 0 THEN '.test.ts' WHEN 1 THEN '_spec_.ts' WHEN 2 THEN '.md' WHEN 3 THEN '_test_.js' ELSE '.ts' END) AS path FROM {lineitem}",
    "SELECT l_orderkey, l_linenumber, l_partkey, contains(n, '.test.') OR contains(n, '.spec.') OR contains(n, '_test_') OR contains(n, '_spec_') AS is_test, starts_with(path, 'docs/') OR ends_with(path, '.md') AS is_doc, path = 'docs' OR starts_with(path, 'docs/') OR path = 'x.md' OR starts_with(path, 'x.md/') AS excluded FROM (SELECT *, string_split(path, '/')[-1] AS n FROM src)",
    lambda d: d.select("l_orderkey", "l_linenumber", "l_partkey", P.is_test_file(F.col("path")).alias("is_test"), P.is_doc_file(F.col("path")).alias("is_doc"), P.under_any(F.col("path"), ["docs/", "x.md"]).alias("excluded")),
)
