"""Process assertions over a finished session. Each is a condition; null facts count as empty.

Columns: tools (calls in order), response, prompt, steps, plan_steps, plan_items, plan_text, plan_updates, plan_after,
exit_status, new_memory and all_memory (arrays of scope, key, value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def low(words: Sequence[str]) -> Column:
    return F.array(*(F.lit(w.lower()) for w in words))


def called() -> Column:
    return F.transform(F.coalesce("tools", F.array().cast("array<string>")), lambda t: F.lower(t))


def calls_of(tool: str) -> Column:
    return F.size(F.filter(called(), lambda t: t == tool))


def text(name: str) -> Column:
    return F.lower(F.coalesce(name, F.lit("")))


def looks_like_code(word: str) -> bool:
    bare = word.strip("`")
    return word != bare or any(m in word for m in ("_", ".", "/", "::", "->")) or (len(bare) > 1 and bare.isupper()) or (bare.lower() != bare and bare.upper() != bare)


def keyword_hits(words: Sequence[str]) -> tuple[Column, Column]:
    """(safe hits, echoed code hits): a keyword that the prompt already holds proves nothing; if it looks like code it is
    counted apart, else not at all."""
    inside = lambda name, w: text(name).contains(w.strip("`").lower())
    one = lambda c: F.when(c, 1).otherwise(0)
    safe = sum((one(inside("response", w) & ~inside("prompt", w)) for w in words), F.lit(0))
    echoed = sum((one(inside("response", w) & inside("prompt", w)) for w in words if looks_like_code(w)), F.lit(0))
    return safe, echoed


def assertion(name: str, value=None) -> Column:
    """The condition of one key of the vocabulary."""
    any_in = lambda column, words: F.exists(low(words), lambda w: F.contains(text(column), w))
    size = lambda c: F.coalesce(F.col(c), F.lit(0))
    length = F.length(F.coalesce("response", F.lit("")))
    ratio = F.try_divide(size("steps").cast("double"), size("plan_items").cast("double"))
    memory = lambda c, f: F.exists(F.coalesce(F.col(c), F.array().cast("array<struct<scope:string,key:string,value:string>>")), f)
    v = value
    conditions = {
        "execution_must_call_tools_any_of": lambda: F.arrays_overlap(called(), low(v)),
        "execution_must_not_call_tools": lambda: ~F.arrays_overlap(called(), low(v)),
        "final_response_must_include_any_of": lambda: keyword_hits(v)[0] >= 1,
        "final_response_must_not_include": lambda: ~any_in("response", v),
        "max_steps": lambda: size("steps") <= (30 if v is None else v),
        "plan_min_steps": lambda: size("plan_steps") >= (1 if v is None else v),
        "plan_max_steps": lambda: size("plan_steps") <= (999 if v is None else v),
        "fidelity_step_ratio": lambda: F.coalesce(ratio.between(*(v or (0, 999))), F.lit(False)),
        "plan_must_cover_any_of": lambda: F.size(F.filter(low(v[1]), lambda w: F.contains(text("plan_text"), w))) >= v[0],
        "plan_must_not_have": lambda: ~any_in("plan_text", v),
        "premature_exit_max_plan_steps": lambda: size("plan_steps") <= (3 if v is None else v),
        "recovery_plan_update_count_min": lambda: size("plan_updates") >= (2 if v is None else v),
        "recovery_must_include_after_failure": lambda: any_in("plan_after", v),
        "exit_status_must_be": lambda: F.coalesce(F.col("exit_status").isin(*v), F.lit(False)),
        "final_response_min_length": lambda: length >= (v or 0),
        "final_response_max_length": lambda: F.lit(True) if v is None else length <= v,
        "final_response_must_include_count_keywords_min_3": lambda: keyword_hits(v)[0] >= 3,
        "final_response_must_include_some_keywords": lambda: keyword_hits(v)[0] >= 2,
        "memory_write_scope_must_be": lambda: memory("new_memory", lambda m: m["scope"] == v),
        "memory_write_keys_any_of": lambda: memory("new_memory", lambda m: F.exists(low(v), lambda w: F.contains(F.lower(m["key"]), w))),
        "memory_write_values_any_of": lambda: memory("new_memory", lambda m: F.exists(low(v), lambda w: F.contains(F.lower(m["value"]), w))),
        "memory_update_must_contain_value": lambda: memory("all_memory", lambda m: m["value"].contains(v)),
        "memory_update_must_not_keep_old_value": lambda: ~memory("all_memory", lambda m: m["value"].contains(v)),
        "unique_tools_count_min_2": lambda: F.size(F.array_distinct(called())) >= 2,
        "read_call_count_le_5": lambda: calls_of("read") <= 5,
        "execution_must_not_call_tools_overuse_grep_3plus": lambda: calls_of("grep") < 3,
    }
    if name not in conditions:
        raise ValueError(f"unknown assertion {name}")
    return F.coalesce(conditions[name](), F.lit(False))


def check(sessions, wanted: dict[str, object]):
    """(sid, assertion, ok) for each session and key."""
    rows = F.array(*(F.struct(F.lit(k).alias("assertion"), assertion(k, v).alias("ok")) for k, v in wanted.items()))
    return sessions.select("sid", F.explode(rows).alias("r")).select("sid", "r.*")
