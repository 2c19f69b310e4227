"""Operators on literal rows: rules, partitions, boundaries, votes, redaction, statistics, gates and their mutations."""

import hashlib
import random
import re
from fractions import Fraction

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lathework import schema
from lathework.functions import redaction, stats
from lathework.functions import text as X
from lathework.operators import batches, gates, joins, labels, rebuild, selection, sessions, trials
from lathework.plans import ORACLES, QUERIES

SESSION = {"sid": "s", "steps": 20, "tool_call_count": 10, "total_tokens": 50_000, "exit_status": "success", "excluded_hit": False}
SESSION_DDL = "sid string, steps long, tool_call_count long, total_tokens long, exit_status string, excluded_hit boolean"


@pytest.mark.parametrize(("change", "reason"), [({"steps": 0}, "R1_EMPTY"), ({"steps": None}, "R1_EMPTY"), ({"steps": 2}, "R2_TOO_SHORT"), ({"steps": 5, "tool_call_count": 0}, "R3_NO_ACTION"), ({"total_tokens": 999}, "R4_TOO_FEW_TOKENS"), ({"excluded_hit": True}, "E_SELF_REFERENTIAL"), ({}, None)])
def test_session_rules(spark, change, reason):
    row = selection.filter_sessions(spark.createDataFrame([SESSION | change], SESSION_DDL)).first()
    assert row.drop_reason == reason and row.keep == (reason is None)


def test_interrupted_sessions_are_kept_and_split(spark):
    row = selection.filter_sessions(spark.createDataFrame([SESSION | {"exit_status": "Interrupted"}], SESSION_DDL)).first()
    assert row.keep and row.forced_split


@pytest.mark.parametrize(("before", "after"), [([(0, 5), (6, 10)], [(0, 5), (6, 10)]), ([(0, 8), (3, 12)], [(0, 8), (9, 12)]), ([(0, 20), (5, 10)], [(0, 20), None]), ([(8, 8), (8, 8), (8, 12)], [(8, 8), None, (9, 12)]), ([None, (3, 7)], [None, (3, 7)])])
def test_partition(spark, before, after):
    rows = [("s", i, *(x or (None, None))) for i, x in enumerate(before)]
    out = sessions.enforce_partition(spark.createDataFrame(rows, "sid string, seq int, lo int, hi int")).orderBy("seq").collect()
    assert [None if r.lo is None else (r.lo, r.hi) for r in out] == after


@pytest.mark.parametrize(("start", "end", "want"), [("T1", "T3", (0, 4)), ("T3", None, (8, 12)), ("T9", None, (12, 12)), ("T1", "T1", (0, 0))])
def test_step_intervals(spark, start, end, want):
    steps = spark.createDataFrame([("s", i, t) for t, i in (("T1", 0), ("T2", 4), ("T3", 8), ("T4", 12))], "sid string, idx int, ts string")
    spans = spark.createDataFrame([("u", "s", start, end)], "unit_id string, sid string, start string, end string")
    r = sessions.step_intervals(spans, steps).first()
    assert (r.lo, r.hi) == want


def test_step_intervals_follow_the_loop_for_any_timeline(spark):
    import random

    r, rows, spans, want = random.Random(4), [], [], {}
    for s in range(60):
        line = [r.randint(0, 9) for _ in range(r.randint(1, 8))]
        rows += [(f"s{s}", i, t) for i, t in enumerate(line)]
        a, b = r.randint(0, 9), r.choice([None, r.randint(0, 9)])
        spans.append((f"u{s}", f"s{s}", a, b))
        lo = hi = None
        for i, t in enumerate(line):
            if b is not None and t >= b:
                if lo is None and t >= a:
                    lo = i
                break
            if lo is None and t >= a:
                lo = i
            hi = i
        lo = next((i for i, t in enumerate(line) if t >= a), len(line) - 1)
        stop = next((i for i, t in enumerate(line) if b is not None and t >= b), None)
        hi = len(line) - 1 if stop is None else (stop - 1 if stop else lo)
        want[f"u{s}"] = (lo, max(lo, hi))
    out = sessions.step_intervals(spark.createDataFrame(spans, "unit_id string, sid string, start int, end int"), spark.createDataFrame(rows, "sid string, idx int, ts int"))
    assert {x.unit_id: (x.lo, x.hi) for x in out.collect()} == want


def test_step_intervals_without_start_or_steps(spark):
    steps = spark.createDataFrame([("s", 0, 5)], "sid string, idx int, ts int")
    spans = spark.createDataFrame([("a", "s", None, 9), ("b", "other", 1, None), ("c", "s", 7, None)], "unit_id string, sid string, start int, end int")
    assert {r.unit_id: (r.lo, r.hi) for r in sessions.step_intervals(spans, steps).collect()} == {"a": (None, None), "b": (None, None), "c": (0, 0)}


def test_numbering_in_ranges(spark):
    rows = spark.createDataFrame([(i * 7 % 1000,) for i in range(1000)], "k int")
    assert all(r.k == r["__n"] for r in joins.numbered(rows, "k", 90).collect())
    assert joins.numbered(rows.limit(0), "k").count() == 0
    assert [r.k for r in joins.even_stride(rows, "k", 4).collect()] == [0, 250, 500, 750]


def reasons(spark, turns):
    rows = [("s", i, *t) for i, t in enumerate(turns)]
    out = sessions.boundaries(spark.createDataFrame(rows, "sid string, seq int, text string, ts_epoch double, files array<string>"))
    return [r.reason for r in out.orderBy("seq").collect()]


def test_boundaries(spark):
    task = "please implement a new exporter for the weekly report of the team"
    assert reasons(spark, [("a", 0.0, []), ("b", 1800.0, []), ("c", 3601.0, [])]) == ["B_FIRST", None, "B_TIME_GAP"]
    assert reasons(spark, [("a", 0.0, ["x"]), ("b", 1.0, []), ("c", 2.0, ["y"]), ("d", 3.0, ["x"])]) == ["B_FIRST", None, "B_FILE_DISJOINT", "B_FILE_DISJOINT"]
    assert reasons(spark, [("a", 0.0, None), ("ok", 9e9, ["z"]), (task, 9e9, [])]) == ["B_FIRST", None, "B_TASK_PATTERN"]


@pytest.mark.parametrize(("wd", "raw", "traj", "want"), [("a", "a", "a", ("a", "direct")), ("b", "b", "a", ("a", "conflict")), (None, None, "a", ("a", "inferred")), ("a", "a", None, ("a", "voted")), ("a", "b", None, ("a", "conflict")), (None, None, None, (None, "unresolved")), ("b", "a", "a", ("a", "voted"))])
def test_repo_vote(spark, wd, raw, traj, want):
    repo, resolution = sessions.resolve_repo(F.col("wd"), F.col("raw"), F.col("traj"))
    assert tuple(spark.createDataFrame([(wd, raw, traj)], "wd string, raw string, traj string").select(repo, resolution).first()) == want


UNIT = {"unit_id": "s#1", "sid": "s", "seq": 1, "boundary_confidence": "high", "repo": "r", "repo_resolution": "direct", "edit_ops": 1, "n_test_cmds": 1, "secret_severity": None, "started_at": "2026-06-01", "category": "bug_fix", "instruction_len": 60}
UNIT_DDL = "unit_id string, sid string, seq int, boundary_confidence string, repo string, repo_resolution string, edit_ops long, n_test_cmds long, secret_severity string, started_at string, category string, instruction_len long"


@pytest.mark.parametrize(("change", "kept"), [({}, True), ({"secret_severity": "medium"}, True), ({"instruction_len": 1200}, True), ({"boundary_confidence": "low"}, False), ({"repo": "other"}, False), ({"repo_resolution": "conflict"}, False), ({"edit_ops": 0}, False), ({"n_test_cmds": None}, False), ({"secret_severity": "high"}, False), ({"started_at": "2026-05-31T23:59:59"}, False), ({"category": "doc_authoring"}, False), ({"instruction_len": 59}, False), ({"instruction_len": 1201}, False)])
def test_candidate_chain(spark, change, kept):
    units = spark.createDataFrame([UNIT | change], UNIT_DDL)
    assert (selection.candidates(units, ["r"], "2026-06").count() == 1) == kept
    assert selection.funnel(units, ["r"], "2026-06").where("step = 8").first().remaining == int(kept)


def test_next_unit_skips_gaps(spark):
    units = spark.createDataFrame([UNIT, UNIT | {"seq": 5, "boundary_confidence": "low", "unit_id": "b"}, UNIT | {"seq": 9, "unit_id": "c"}], UNIT_DDL)
    assert {r.unit_id: r.endpoint_high for r in selection.next_unit_is_high(units).collect()} == {"s#1": False, "b": True, "c": True}


def test_unknown_group_dimension_is_refused(spark):
    with pytest.raises(ValueError, match="not groupable"):
        selection.top_groups(spark.createDataFrame([UNIT], UNIT_DDL), ["unit_id"])


def test_redaction_beside_combining_marks(spark):
    """Python's \\b takes no combining mark for part of a word, as the reference does; both of two neighbours go."""
    letters = ["e\u0301", "\u0915\u094d", "\U0001e900\U0001e944", "\U0001d7d8", "x", "\u4e2d", "\u0301", ". "]
    texts = [f"{x}{ip}{y} z" for ip in ("10.0.0.1", "AKIA" + "A1" * 8, "10.1.2.3 10.4.5.6") for x in letters for y in ("", "\u0301", "\U0001d7d8", "x", ",")]
    want = [re.sub(redaction.AWS_KEY, "<AWS_KEY_REDACTED>", t) for t in texts]
    want = [re.sub(redaction.PRIVATE_IP, "<INTERNAL_IP>", t) for t in want]
    got = redaction.redact(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).orderBy("id")
    assert [r.text for r in got.collect()] == want


def test_redaction_is_a_fixed_point(spark):
    texts = ["sk-a1B2c3D4e5F6g7H8i9J0k and sk-specific-scorer-registry", "/Users/someone/x /home/runner/x /Users/notes.txt", "curl -u user:pass12 http://x and --password=hunter2222", "127.0.0.1 10.0.0.1 a.local", "13812345678 213812345678", "A@Corp.example b@GMAIL.com", None, ""]
    once = redaction.redact(spark.createDataFrame([(t,) for t in texts], "text string"))
    again = redaction.redact(once.select(F.col("text")))
    assert once.agg(F.sum("hit_count")).first()[0] == 7 and again.agg(F.sum("hit_count")).first()[0] == 0
    assert [r.text for r in once.collect()][:2] == ["sk-<REDACTED> and sk-specific-scorer-registry", "/Users/<USER>/x /home/runner/x /Users/notes.txt"]


def test_noise_and_followups(spark):
    rows = [("<session>x</session>", False), ("<SYSTEM-REMINDER> x", True), ("  Caveat: x", True), ("<!-- pasted -->", False), (None, True)]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(X.is_noise(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [w for _, w in rows]


TRIAL = {"task": "t", "run": "r", "reward": 1.0, "f2p": 1.0, "p2p": 1.0, "error_code": 0, "exception": None, "reward_txt": 1.0, "cost_usd": 0.5, "model": "m", "subtype": "success", "errors": [], "p2p_error": None}


@pytest.mark.parametrize(("change", "infra", "solved"), [({"reward": None}, True, False), ({"exception": "AgentTimeoutError"}, False, True), ({"reward": 0.0, "subtype": "error_during_execution", "errors": ["Socket connection lost"]}, True, False), ({"reward": 0.0, "subtype": "error_during_execution", "errors": ["TypeError"]}, False, False), ({"exception": "BuildError"}, True, True), ({"errors": None}, False, True)])
def test_trial_flags(spark, change, infra, solved):
    r = trials.with_flags(spark.createDataFrame([TRIAL | change], schema.TRIALS)).first()
    assert (r.infra_failure, r.solved) == (infra, solved)


def test_pass_at_1_is_a_mean_of_rates(spark):
    rows = [TRIAL | {"task": "a"}, TRIAL | {"task": "a", "reward": 0.0}, TRIAL | {"task": "b"}, TRIAL | {"task": "c", "reward": None}]
    r = trials.pass_at_1(spark.createDataFrame(rows, schema.TRIALS)).first()
    assert (r.n, r.passed, r.excluded, r.p) == (2, 1.5, 1, 1.0)


def test_not_run_is_not_failed(spark):
    members = spark.createDataFrame([("g", t) for t in "abcd"], "label string, task string")
    rows = [TRIAL | {"task": "a"}, TRIAL | {"task": "b", "reward": 0.0}, TRIAL | {"task": "c", "reward": None}]
    r = trials.cells(members, spark.createDataFrame(rows, schema.TRIALS)).first()
    assert (r.tasks, r.solved, r.excluded, r.missing, r.scored, r.pct) == (4, 1, 1, 1, 2, None)


def test_epsilon_needs_all_stable_tasks(spark):
    stable = spark.createDataFrame([("a",), ("b",)], "task string")
    holdout = spark.createDataFrame([TRIAL | {"task": "a", "reward": 0.0}, TRIAL | {"task": "b"}], schema.TRIALS)
    assert trials.epsilon(stable, holdout) == Fraction(1, 2)
    with pytest.raises(ValueError, match="did not run"):
        trials.epsilon(stable, holdout.where("task = 'a'"))


def test_statistics_goldens():
    assert [round(stats.delta_at(n, 14 / 37), 1) for n in (32, 37, 100, 300, 500)] == [34.1, 31.9, 19.7, 11.3, 8.7]
    assert [stats.mcnemar_min_split(k) for k in (6, 10, 3)] == [6, 9, None]
    table = [[stats.block_threshold(n, Fraction(e, 20)) for e in (1, 2, 3)] for n in (6, 8, 10, 12, 14)]
    assert table == [[2, 3, 3], [3, 3, 4], [3, 4, 4], [3, 4, 5], [3, 4, 5]]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.fractions(0, 1, max_denominator=20), st.integers(0, 40))
def test_binomial_tails_fall(n, p, m):
    m = min(m, n)
    assert 0 <= stats.binomial_tail(n, p, m + 1) <= stats.binomial_tail(n, p, m) <= 1 and stats.binomial_tail(n, p, 0) == 1


def test_fingerprint_ignores_order(spark):
    rows = [("a", 3), ("b", 4), ("c", 5)]
    digest = lambda r: joins.batch_fingerprint(spark.createDataFrame(r, "sid string, steps int")).first().digest
    assert digest(rows) == digest(rows[::-1]) != digest(rows[:2])


HEALTHY = [(1, "bug_fix", "easy", 1), (2, "refactor", "hard", 9), (3, "doc_authoring", "unrated", 0), (4, "env_ops", "medium", 4)]


@pytest.mark.parametrize(("mutate", "gate"), [(None, None), (lambda r: (*r[:2], "unrated", 5), "unrated_iff_no_edits"), (lambda r: (r[0], "bug_fix", *r[2:]), "category_share")])
def test_label_gate_goes_red_for_its_reason(spark, mutate, gate):
    rows = HEALTHY if mutate is None else [mutate(r) for r in HEALTHY]
    bad = {r.gate for r in gates.label_gate(spark.createDataFrame(rows, "id int, category string, difficulty string, edit_ops int")).collect() if not r.ok}
    assert (gate in bad) if gate else not bad


@pytest.mark.parametrize(("change", "bad"), [({}, set()), ({"drop_reason": "X"}, {"reason_legal", "keep_iff_no_reason"}), ({"keep": False}, {"keep_iff_no_reason"}), ({"drop_reason": "U_INTERRUPTED", "keep": False}, {"reason_legal", "interrupted_not_dropped_for_it"})])
def test_session_gate_mutations(spark, change, bad):
    rows = [{"drop_reason": None, "keep": True}, {"drop_reason": None, "keep": True} | change]
    out = gates.session_gate(spark.createDataFrame(rows, "drop_reason string, keep boolean"))
    assert {r.gate for r in out.collect() if not r.ok} == bad


def test_empty_scope_is_a_failure(spark):
    empty = spark.createDataFrame([], "drop_reason string, keep boolean")
    assert not any(r.ok for r in gates.session_gate(empty).collect())
    assert not gates.share_gate(empty, "g", F.col("keep"), 0.0).first().ok


GATE_CASES = [({}, "", "green_without_change"), ({"f2p": 0.0, "reward": 0.0, "reward_txt": 0.0}, "not_solved", ""), ({"reward_txt": 0.0}, "sources_disagree", "sources_disagree"), ({"exception": "E"}, "exception", "exception"), ({"p2p": 0.0, "reward": 0.0, "reward_txt": 0.0}, "breaks_others", "green_without_change"), ({"f2p": 0.0, "p2p": 0.0, "reward": 0.0, "reward_txt": 0.0}, "not_solved", "broken_environment"), ({"f2p": None, "reward": 0.0, "reward_txt": 0.0}, "not_solved", "unexpected_values")]


@pytest.mark.parametrize(("change", "oracle", "nop"), GATE_CASES)
def test_gates(spark, change, oracle, nop):
    df = spark.createDataFrame([TRIAL | change], schema.TRIALS)
    r = df.select(gates.gate_oracle().alias("o"), gates.gate_nop().alias("n")).first()
    assert (r.o.reason, r.n.reason) == (oracle, nop)


def test_reclassify_twice_changes_nothing(spark):
    d = gates.reclassify(F.col("d"), F.col("s"))
    rows = [("true_zero_wrong_fix", "success"), ("true_zero_wrong_fix", None), ("solved", None), ("grader_incomplete", "error_max_turns")]
    once = spark.createDataFrame(rows, "d string, s string").withColumn("d", d)
    assert [r.d for r in once.collect()] == [r.d for r in once.withColumn("d", d).collect()] == ["true_zero_wrong_fix", "true_zero_unfinished", "solved", "grader_incomplete"]


def test_margin_levels(spark):
    maps = [{"a": 10.0, "b": 4.0}, {"a": 10.0, "b": 7.0}, {"a": 10.0, "b": 8.0}, {"b": 1.0, "a": 1.0}, {}]
    got = spark.createDataFrame([(m,) for m in maps], "m map<string,double>").select(labels.pick_category(F.col("m")).alias("p")).collect()
    assert [(r.p.category, r.p.confidence, r.p.margin) for r in got] == [("a", "high", 0.6), ("a", "medium", 0.3), ("a", "low", 0.2), ("a", "low", 0.0), ("unclassified", "low", 0.0)]


def test_edits_in_order():
    edit = lambda old, new, every=False: {"tool": "Edit", "old": old, "new": new, "all": every}
    assert rebuild.apply_edits("a a", [edit("a", "b"), edit("a", "c")]) == ("b c", None)
    assert rebuild.apply_edits("a a", [edit("a", "b", True)]) == ("b b", None)
    assert rebuild.apply_edits(None, [edit("x", "y")]) == (None, "phantom_file")
    assert rebuild.apply_edits("q", [{"tool": "MultiEdit", "edits": [edit("q", "r"), edit("r", "s")]}]) == ("s", None)
    assert rebuild.parse_literal("{'a': True}") == {"a": "true"}


def test_completeness_is_checked(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError, match="no partner"):
        joins.complete_join(a, b, ["k"])
    assert joins.complete_join(b.select("k"), b, ["k"]).count() == 1
    assert joins.same_sets(a, a.union(a), ["k"]) and not joins.same_sets(a, b, ["k"])


def test_schema_checks(spark):
    df = spark.createDataFrame([("t", None)], "task string, run string")
    with pytest.raises(ValueError, match="missing columns"):
        schema.assert_schema(df, schema.TRIALS)
    assert [r.column_name for r in schema.all_null_columns(df).collect()] == ["run"]


def test_values_at_ranks_without_sorting_the_table(spark):
    r = random.Random(2)
    for values in ([], [3.0], [1.5] * 9, [r.choice([1.0, 2.5, 1e9, -7.0]) for _ in range(200)], [r.random() ** 4 for _ in range(3000)]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        got = joins.at_ranks(df, "v", {"least": lambda n: F.lit(0), "middle": lambda n: F.floor(n / 2), "last": lambda n: n - 1}, cells=16).first()
        want = sorted(values)
        assert tuple(got) == ((want[0], want[len(want) // 2], want[-1]) if want else (None, None, None))


def test_digest_of_sorted_lines(spark):
    lines = [f"line {i * 7919 % 101}" for i in range(300)] + ["", "é"]
    df = spark.createDataFrame([(x,) for x in lines], "x string").repartition(5)
    want = hashlib.sha256("\n".join(sorted(lines, key=str.encode)).encode()).hexdigest()
    assert tuple(joins.set_digest(df, F.col("x")).first()) == (want, len(lines))
    assert tuple(joins.set_digest(df.limit(0), F.col("x")).first()) == (hashlib.sha256(b"").hexdigest(), 0)


def test_regression_candidates_against_all_pairs(spark):
    r = random.Random(7)
    name = lambda: "/".join(r.choice("abcd") for _ in range(r.randint(0, 2))) + ("/" if r.random() < 0.7 else "") + f"f{r.randint(0, 30)}"
    green = sorted({name().lstrip("/") for _ in range(120)})
    tests = {g: r.randint(1, 5) for g in green}
    touched = sorted({(f"T{r.randint(0, 9)}", r.choice(green) if r.random() < 0.5 else name().lstrip("/")) for _ in range(30)})
    folder = lambda p: p.rsplit("/", 1)[0] if "/" in p else ""
    want = []
    for task in {t for t, _ in touched}:
        own = {p for t, p in touched if t == task}
        dirs, tops = {folder(p) for p in own if "/" in p}, {p.split("/")[0] for p in own}
        tier = lambda p: 0 if folder(p) in dirs else 1 if p.split("/")[0] in tops else 2  # noqa: E731, B023
        best = sorted((tier(p), -tests[p], p) for p in green if p not in own)[:6]
        want += [(task, p, t, -n, i + 1) for i, (t, n, p) in enumerate(best)]
    got = batches.regression_candidates(spark.createDataFrame(list(tests.items()), "path string, tests int"), spark.createDataFrame(touched, "task string, path string"), 6)
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", ["ag08_redaction_types", "re09_private_ip"])
def test_redaction_queries_beside_combining_marks(spark, tmp_path, name):
    texts = ["e\u0301" + "10.0.0.1 x", "10.0.0.1\u0301 x", "\u0915\u094d172.16.0.1", "a10.0.0.1", "192.168.1.1, then 10.0.0.2", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("en")).toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    want = con.execute(ORACLES[name])
    got = QUERIES[name](spark, str(tmp_path)).select(*(d[0] for d in want.description))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
